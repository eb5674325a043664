import os

import pytest
from pyspark.sql import types as T

from conftest import got
from dayledger import RunDate
from dayledger.operators import by_column, narrow, persisted, rebalance, to_n
from dayledger.plans import schemas
from dayledger.sinks import (
    TableSpec,
    append_partition,
    drop_expired,
    ensure_table,
    shared_dir,
    stage,
    staged,
    write_partition,
    write_partitions,
)
from dayledger.sinks.tables import column, read_path

SCHEMA = T.StructType([column("id", T.LongType(), "the key's id"), column("1st", T.StringType())])


@pytest.fixture(params=["table", "path"])
def target(request, spark, tmp_path):
    """A spec, the path or None, and how to read what was written."""
    spec = TableSpec(f"t_{abs(hash(str(tmp_path)))}", SCHEMA, "a 'test' table")
    if request.param == "path":
        path = str(tmp_path / "out")
        yield spec, path, lambda: read_path(spark, spec, path)
    else:
        ensure_table(spark, spec)
        yield spec, None, lambda: spark.table(spec.name)
        spark.sql(f"DROP TABLE {spec.name}")


def test_overwrite_replaces_one_day(frame, target):
    spec, path, read = target
    df = frame("`1st` string, id int, extra int", ("a", 1, 0), ("b", 2, 0))
    write_partition(df, spec, "20240101", path)
    write_partition(df, spec, "20240102", path)
    write_partition(df.where("id = 1"), spec, "20240102", path)
    expected = [(1, "a", "20240101"), (1, "a", "20240102"), (2, "b", "20240101")]
    assert got(read(), "id", "1st", "ds") == expected
    write_partition(df.where("id = 1"), spec, "20240102", path)  # again
    assert got(read(), "id", "1st", "ds") == expected
    assert read().schema["ds"].dataType == T.StringType()


def test_overwrite_with_nothing_empties_the_day(frame, target):
    spec, path, read = target
    df = frame("id int, `1st` string", (1, "a"))
    write_partition(df, spec, "20240101", path)
    write_partition(df, spec, "20240102", path)
    write_partition(df.where("id > 5"), spec, "20240101", path)
    assert got(read(), "ds") == [("20240102",)]


def test_dynamic_overwrite_replaces_the_days_in_the_data(frame, target):
    spec, path, read = target
    df = frame("id int, `1st` string, ds string", (1, "a", "20240101"), (2, "b", "20240102"))
    write_partitions(df, spec, path)
    write_partitions(frame("id int, `1st` string, ds string", (3, "c", "20240102"), (4, "d", "20240103")), spec, path)
    assert got(read(), "id", "ds") == [(1, "20240101"), (3, "20240102"), (4, "20240103")]


def test_append_adds_again(frame, target):
    spec, path, read = target
    df = frame("id int, `1st` string", (1, "a"))
    append_partition(df, spec, "20240101", path)
    append_partition(df, spec, "20240101", path)
    assert got(read(), "id", "ds") == [(1, "20240101")] * 2


def test_bad_day_is_refused(frame, target):
    spec, path, _ = target
    with pytest.raises(ValueError):
        write_partition(frame("id int, `1st` string", (1, "a")), spec, "2024'--", path)


def test_files_are_snappy_orc(frame, tmp_path):
    spec, path = TableSpec("t", SCHEMA), str(tmp_path / "orc")
    write_partition(frame("id int, `1st` string", (1, "a")), spec, "20240101", path)
    files = [f for f in os.listdir(f"{path}/ds=20240101") if f.startswith("part-")]
    assert files and all(f.endswith(".snappy.orc") for f in files)


@pytest.mark.parametrize("spec", [
    schemas.APPLY_COUNT, schemas.APPLY_DETAIL, schemas.RENDER_FLAGS, schemas.ORDER_MATERIAL,
    schemas.REWARD_LOG, schemas.RELATION_TAGS], ids=lambda s: s.name)
def test_target_tables(spark, spec):
    spec = spec.named(f"made_{spec.name}")
    for _ in range(2):  # the second time it is there already
        ensure_table(spark, spec)
    made = spark.table(spec.name).schema
    assert made.names == [*spec.schema.names, "ds"]
    assert [f.dataType for f in made][:-1] == [f.dataType for f in spec.schema]
    described = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE {spec.name}").collect()}
    for f in spec.schema:
        assert (described[f.name] or "") == f.metadata.get("comment", "")
    spark.sql(f"DROP TABLE {spec.name}")


def test_drop_expired(spark, frame):
    spec = TableSpec("aging", SCHEMA)
    ensure_table(spark, spec)
    days = ["20240101", "20240308", "20240309", "20240316"]
    write_partitions(frame("id int, `1st` string, ds string", *[(1, "a", d) for d in days]), spec)
    run = RunDate.parse("20240316")
    assert drop_expired(spark, spec.name, run, 7) == days[:2]
    assert drop_expired(spark, spec.name, run, 7) == []
    assert got(spark.table(spec.name), "ds") == [(d,) for d in days[2:]]
    spark.sql("DROP TABLE aging")


class _Session:
    """Just what `shared_dir` looks at."""

    def __init__(self, master, named=None):
        self.conf = {"spark.master": master, "spark.app.id": f"app-{master}"}
        if named:
            self.conf["spark.checkpoint.dir"] = named


def test_shared_folder():
    assert shared_dir(_Session("spark://host", "hdfs:///shared/")) == "hdfs:///shared"
    local = shared_dir(_Session("local[4]"))
    assert os.path.isdir(local) and shared_dir(_Session("local[4]")) == local
    with pytest.raises(RuntimeError):
        shared_dir(_Session("spark://host"))
    with pytest.raises(RuntimeError):
        shared_dir(_Session("local-cluster[2,1,1024]"))


def test_staged_result_is_removed_at_the_end(spark, frame):
    df = frame("id int", (1,), (2,))
    with staged(df, "half") as half:
        folder = half.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert folder.startswith(shared_dir(spark)) and os.path.isdir(folder)
        assert got(half) == [(1,), (2,)]
    assert spark.read.schema("id int").parquet(folder).count() == 0
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 1


def test_stage_cuts_the_plan(frame):
    out = stage(frame("id int", (1,)).distinct(), "cut")
    assert got(out) == [(1,)] and "Aggregate" not in out._jdf.queryExecution().toString()


def test_layout_keeps_rows(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS k")
    assert to_n(df, 7).rdd.getNumPartitions() == 7
    assert by_column(df, 5, "k").rdd.getNumPartitions() == 5
    assert narrow(df, 2).rdd.getNumPartitions() == 2
    for out in (to_n(df, 7), by_column(df, 5, "k"), rebalance(df), rebalance(df, "k"), narrow(df, 2)):
        assert got(out) == got(df)


def test_persisted_result_has_a_name_for_a_while(spark):
    with persisted(spark.range(3), "three") as df:
        assert df.storageLevel.useMemory and spark.table("three").count() == 3
    assert not spark.catalog.tableExists("three") and not df.storageLevel.useMemory


def test_rows_go_to_a_table_by_name(spark, frame):
    spec = TableSpec("other_order", T.StructType([column("a", T.IntegerType()), column("b", T.StringType())]))
    spark.sql("CREATE TABLE other_order (b STRING, a INT, ds STRING) USING orc PARTITIONED BY (ds)")
    try:
        ensure_table(spark, spec)
        rows = frame("a int, b string", (1, "x"))
        write_partition(rows, spec, "20240101")
        append_partition(rows, spec, "20240101")
        assert got(spark.table("other_order"), "a", "b", "ds") == [(1, "x", "20240101")] * 2
        write_partitions(frame("a int, b string, ds string", (2, "y", "20240102")), spec)
        assert got(spark.table("other_order"), "a", "b", "ds") == [(1, "x", "20240101")] * 2 + [(2, "y", "20240102")]
        odd = TableSpec("other_order", T.StructType([column("a", T.LongType()), column("b", T.StringType())]))
        with pytest.raises(ValueError, match="columns a"):
            ensure_table(spark, odd)
    finally:
        spark.sql("DROP TABLE other_order")
