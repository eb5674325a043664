"""Sinks, staging, retention and layout. Writing queries use a fresh folder each time."""

from dataclasses import replace
from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import roles
from checks.registry import DAILY, RUN, Tables, query
from dayledger.operators import by_column, narrow, persisted, rebalance, to_n
from dayledger.plans import monthly_apply_count, order_core, order_material_detail
from dayledger.plans.schemas import APPLY_COUNT
from dayledger.sinks import (
    AuditFailed,
    TableSpec,
    append_partition,
    drop_expired_path,
    ensure_table,
    expired_partitions,
    figure_rows,
    observed_sources,
    publish_partition,
    stage,
    write_audited,
    write_partition,
    write_partitions,
)
from dayledger.sinks.staging import fresh_path
from dayledger.sinks.tables import column, read_path

LINES = TableSpec("lines", T.StructType([
    column("l_orderkey", T.LongType()),
    column("l_partkey", T.LongType()),
    column("l_quantity", T.DoubleType()),
]))
ORDERS = TableSpec("orders_copy", T.StructType([
    column("o_orderkey", T.LongType()),
    column("o_orderstatus", T.StringType()),
    column("o_totalprice", T.DoubleType()),
    column("o_orderdate", T.TimestampNTZType()),
]))


@query(roles.APPLY_COUNT_SQL + """
    SELECT *, '19980630' AS ds FROM apply_count""")
def table_spec(t: Tables):
    """The flagship job through its declared table."""
    spec = APPLY_COUNT.named(f"apply_count_{uuid4().hex}")
    ensure_table(t.spark, spec, fresh_path(t.spark, "table"))
    write_partition(monthly_apply_count(roles.apply_count(t), RUN), spec, RUN.ds)
    return t.spark.table(spec.name)


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, '19980630' AS ds FROM orders""")
def sink_orc_roundtrip(t: Tables):
    path = fresh_path(t.spark, "orc")
    write_partition(t.orders, ORDERS, RUN.ds, path)
    return read_path(t.spark, ORDERS, path)


@query("""SELECT l_orderkey, l_partkey, l_quantity, '19980629' AS ds FROM lineitem
          UNION ALL
          SELECT l_orderkey, l_partkey, l_quantity, '19980630' FROM lineitem WHERE l_returnflag = 'R'""")
def sink_overwrite_partition(t: Tables):
    path = fresh_path(t.spark, "overwrite")
    write_partition(t.lineitem, LINES, RUN.prev_day, path)
    write_partition(t.lineitem, LINES, RUN.ds, path)
    write_partition(t.lineitem.where("l_returnflag = 'R'"), LINES, RUN.ds, path)
    return read_path(t.spark, LINES, path)


@query("""SELECT l_orderkey, l_partkey,
                 CASE WHEN year(l_shipdate) >= 2000 THEN -l_quantity ELSE l_quantity END AS l_quantity,
                 strftime(l_shipdate, '%Y') || '0101' AS ds
          FROM lineitem""")
def sink_dynamic_overwrite(t: Tables):
    path = fresh_path(t.spark, "dynamic")
    yearly = t.lineitem.withColumn("ds", F.date_format("l_shipdate", "yyyy'0101'"))
    write_partitions(yearly, LINES, path)
    late = yearly.where(F.col("ds") >= "20000101").withColumn("l_quantity", -F.col("l_quantity"))
    write_partitions(late, LINES, path)
    return read_path(t.spark, LINES, path)


@query("""SELECT l_orderkey, l_partkey, l_quantity, '19980630' AS ds FROM lineitem
          UNION ALL
          SELECT l_orderkey, l_partkey, l_quantity, '19980630' FROM lineitem WHERE l_returnflag = 'R'""")
def sink_append_partition(t: Tables):
    path = fresh_path(t.spark, "append")
    append_partition(t.lineitem, LINES, RUN.ds, path)
    append_partition(t.lineitem.where("l_returnflag = 'R'"), LINES, RUN.ds, path)
    return read_path(t.spark, LINES, path)


@query("""SELECT l_orderkey, l_partkey, l_quantity, '19980630' AS ds, 'returned' AS run FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL
          SELECT l_orderkey, l_partkey, l_quantity, '19980630', 'others' FROM lineitem WHERE l_returnflag <> 'R'""")
def sink_append_runs(t: Tables):
    """Two runs add to a day; the first is tried twice, the first time with half its rows."""
    path, spec = fresh_path(t.spark, "runs"), replace(LINES, by_run=True)
    returned = t.lineitem.where("l_returnflag = 'R'")
    append_partition(returned.where("l_orderkey % 2 = 0"), spec, RUN.ds, path, token="returned")
    append_partition(t.lineitem.where("l_returnflag <> 'R'"), spec, RUN.ds, path, token="others")
    append_partition(returned, spec, RUN.ds, path, token="returned")
    return read_path(t.spark, spec, path)


@query("""SELECT l_orderkey, l_partkey, l_quantity, '19980629' AS ds FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL
          SELECT l_orderkey, l_partkey, l_quantity, '19980630' FROM lineitem WHERE l_returnflag = 'A'""")
def sink_publish_partition(t: Tables):
    """Days are shown when their figures pass; a day that fails leaves the one before in its place."""
    spec = LINES.named(f"lines_{uuid4().hex}")
    ensure_table(t.spark, spec, fresh_path(t.spark, "table"))
    some = {"some rows": lambda f: f["record_count"] > 0, "keys": lambda f: f["null_l_orderkey_count"] == 0}
    for ds, flag in ((RUN.prev_day, "R"), (RUN.ds, "N"), (RUN.ds, "A"), (RUN.ds, "none")):
        rows = t.lineitem.where(F.col("l_returnflag") == flag)
        try:
            publish_partition(rows, spec, ds, some, nulls=["l_orderkey"])
        except AuditFailed:
            if flag != "none":
                raise
    return t.spark.table(spec.name)


@query("""SELECT 'record_count' AS metric, count(*) AS value FROM lineitem
          UNION ALL SELECT 'null_l_partkey_count', count(*) FILTER (l_partkey IS NULL) FROM lineitem
          UNION ALL SELECT 'null_flag_count', count(*) FILTER (l_returnflag = 'N') FROM lineitem
          UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lines', count(*) FROM lineitem""")
def audit_in_write(t: Tables):
    """Source counts, result count and NULL counts, all gathered while the day is written."""
    own = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    spec = TableSpec("flags", T.StructType([*LINES.schema.fields[:2], column("flag", T.StringType())]))
    sources, counted = observed_sources({"lines": t.lineitem, "orders": t.orders})
    rows = sources["lines"].select("l_orderkey", "l_partkey", own).join(
        sources["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey", "full_outer")
    rows = rows.where("l_partkey IS NOT NULL")
    figures = write_audited(rows, spec, RUN.ds, fresh_path(t.spark, "audited"), nulls=["l_partkey", "flag"])
    return figure_rows(t.spark, spec, RUN.ds, figures | counted()).select("metric", "value")


@query("""SELECT l_orderkey, l_partkey, l_quantity, ds
          FROM lineitem, (VALUES ('19980623'), ('19980630')) AS days(ds) WHERE l_returnflag = 'R'""")
def retention_path(t: Tables):
    path = fresh_path(t.spark, "expiring")
    for ds in ("19980101", "19980622", "19980623", RUN.ds):
        write_partition(t.lineitem.where("l_returnflag = 'R'"), LINES, ds, path)
    drop_expired_path(t.spark, path, RUN, 7)
    return read_path(t.spark, LINES, path)


@query(roles.ORDER_MATERIAL_SQL + " SELECT * FROM order_material_detail")
def staged_result(t: Tables):
    catalog = roles.order_material(t)
    core = stage(order_core(catalog, RUN, ties=True, distinct=True), "core")
    return order_material_detail(catalog, RUN, core=core)


@query(f"WITH {DAILY} SELECT DISTINCT ds FROM daily WHERE ds < '19980623'", name="expired_partitions")
def expired(t: Tables):
    return expired_partitions(t.daily, RUN, 7)


KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]
ALL_KEYS = "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem"


@query(ALL_KEYS)
def layout_repartition(t: Tables):
    return to_n(t.lineitem.select(KEYS), 16)


@query(ALL_KEYS)
def layout_repartition_by(t: Tables):
    return by_column(t.lineitem.select(KEYS), 16, "l_orderkey")


@query(ALL_KEYS)
def layout_rebalance(t: Tables):
    return rebalance(t.lineitem.select(KEYS), "l_orderkey")


@query(ALL_KEYS)
def layout_coalesce(t: Tables):
    return narrow(t.lineitem.select(KEYS), 2)


@query("""SELECT l_returnflag AS value, count(*) AS cnt FROM lineitem GROUP BY 1
          UNION ALL
          SELECT l_linestatus, count(*) FROM lineitem GROUP BY 1""")
def layout_persist(t: Tables):
    """A relation kept and read twice; the result is staged before it is let go."""
    flags = t.lineitem.select("l_returnflag", "l_linestatus")
    with persisted(flags) as kept:
        counts = [
            kept.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("cnt"))
            for c in kept.columns
        ]
        return stage(counts[0].unionByName(counts[1]), "counts")
