import pytest
from pyspark.sql import functions as F

from conftest import got, plan
from dayledger import RunDate
from dayledger.sources import (
    Catalog,
    constant_row,
    first_non_empty,
    increment,
    month_to_date,
    snapshot,
    trailing_days,
)

RUN = RunDate.parse("20240301")


@pytest.fixture
def days(frame):
    return frame("id int, ds string, action_type int", (1, "20240222", 1), (2, "20240223", 1), (3, "20240229", 1),
                 (4, "20240301", 1), (5, "20240301", 2), (6, "20240302", 1))


def test_scans(days):
    assert got(snapshot(days, RUN.ds), "id") == [(4,), (5,)]
    assert got(snapshot(days, RUN.prev_month_end), "id") == [(3,)]
    assert got(month_to_date(days, RUN), "id") == [(4,), (5,)]
    assert got(trailing_days(days, RUN, 7), "id") == [(2,), (3,)]
    assert got(increment(days, RUN.ds, 1), "id") == [(4,)]
    assert got(increment(days, RUN.ds), "id") == [(4,), (5,)]


def test_first_non_empty(days):
    none = days.where("id < 0")
    assert got(first_non_empty(none, days.where("id = 1"), days), "id") == [(1,)]
    assert got(first_non_empty(days.where("id = 2"), days), "id") == [(2,)]
    assert got(first_non_empty(none, none), "id") == []


def test_catalog_reads_a_path_a_table_and_a_frame(spark, days, tmp_path):
    path = str(tmp_path / "days")
    days.write.format("orc").partitionBy("ds").save(path)
    days.createOrReplaceTempView("some_days")
    catalog = Catalog(spark, {"path": path, "table": "some_days", "frame": days})
    for role in ("path", "table", "frame"):
        df = catalog.table(role)
        assert df.schema["ds"].dataType.simpleString() == "string"
        assert got(snapshot(df, RUN.ds), "id") == [(4,), (5,)]
    assert catalog.has("path") and not catalog.has("other")
    with pytest.raises(KeyError):
        catalog.table("other")


def test_path_scan_reads_only_its_partitions(spark, days, tmp_path):
    path = str(tmp_path / "pruned")
    days.write.format("orc").partitionBy("ds").save(path)
    df = trailing_days(Catalog(spark, {"d": path}).table("d"), RUN, 7)
    assert "PartitionFilters: [isnotnull(ds" in plan(df)
    read = df.withColumn("file", F.input_file_name())
    assert {f.split("ds=")[1][:8] for (f,) in got(read, "file")} == {"20240223", "20240229"}


def test_constant_row(spark, frame):
    row = constant_row(spark, id=0, name="it's unknown", known=False)
    assert got(row) == [(0, "it's unknown", False)] and row.schema["id"].dataType.simpleString() == "bigint"
    joined = frame("id bigint", (0,), (1,), (None,)).join(row, "id", "left")
    assert got(joined, "id", "name") == [(None, None), (0, "it's unknown"), (1, None)]
    assert "NestedLoop" not in plan(joined)
