"""Sources."""

from pyspark.sql import functions as F

from checks.registry import DAILY, RUN, Tables, query
from dayledger.sources import (
    Catalog,
    constant_row,
    first_non_empty,
    increment,
    month_to_date,
    snapshot,
    trailing_days,
)

COLS = ["l_orderkey", "l_partkey", "l_linenumber", "ds"]
SELECT = f"WITH {DAILY} SELECT l_orderkey, l_partkey, l_linenumber, ds FROM daily WHERE "


@query(SELECT + "ds = '19980630'")
def scan_snapshot(t: Tables):
    return snapshot(t.daily, RUN.ds).select(COLS)


@query(SELECT + "ds BETWEEN '19980601' AND '19980630'")
def scan_month_to_date(t: Tables):
    return month_to_date(t.daily, RUN).select(COLS)


@query(SELECT + "ds = '19980629'")
def scan_previous_day(t: Tables):
    return snapshot(t.daily, RUN.prev_day).select(COLS)


@query(SELECT + "ds = '19980531'")
def scan_previous_month_end(t: Tables):
    return snapshot(t.daily, RUN.prev_month_end).select(COLS)


@query(SELECT + "ds >= '19980623' AND ds < '19980630'")
def scan_trailing_days(t: Tables):
    return trailing_days(t.daily, RUN, 7).select(COLS)


@query(SELECT + "ds = '19980630' AND l_returnflag = 'A'")
def scan_increment(t: Tables):
    return increment(t.daily, RUN.ds, "A", action_col="l_returnflag").select(COLS)


@query("""SELECT p_partkey, CASE WHEN p_partkey = 0 THEN 'unknown' END AS default_name FROM part""")
def constant_dimension(t: Tables):
    unknown = constant_row(t.spark, p_partkey=0, default_name="unknown")
    return t.part.select("p_partkey").join(unknown, "p_partkey", "left")


@query(SELECT + "ds >= '19980601' AND ds <= '19980630'")
def source_fallback(t: Tables):
    preferred = snapshot(t.daily.where(F.col("l_quantity") < 0), RUN.ds)
    return first_non_empty(preferred, month_to_date(t.daily, RUN)).select(COLS)


@query("""SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def scan_by_name(t: Tables):
    """One role by its path, one by a table's name."""
    t.nation.createOrReplaceTempView("named_nation")
    catalog = Catalog(t.spark, {"customer": f"{t.sf_dir}/customer.parquet", "nation": "named_nation"}, "parquet")
    joined = catalog.table("customer").join(catalog.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("*").alias("customers"))
