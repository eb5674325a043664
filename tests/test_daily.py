"""What is carried from day to day: key ledgers, bitmaps of distinct values, tables in buckets."""

import random

import pytest
from conftest import got, plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger import RunDate
from dayledger.operators import (
    advance_ledger,
    count_bitmaps,
    count_distinct_by,
    distinct_bitmaps,
    ledger_diff,
    merge_bitmaps,
    merge_increment,
    month_to_date_bitmaps,
    snapshot_diff,
    start_ledger,
)
from dayledger.operators import merge
from dayledger.plans import run_job
from dayledger.plans.schemas import REWARD_LOG
from dayledger.sinks import TableSpec, ensure_table, stage, write_partition
from dayledger.sinks.tables import column
from dayledger.sources import Catalog


def june_days(n=12):
    return ["20240530", "20240531", *[f"202406{d:02d}" for d in range(1, n + 1)]]


def test_a_ledger_gives_the_snapshot_difference_every_day(spark):
    rng = random.Random(4)
    days = june_days()
    rows = []
    for key in range(40):  # keys that come, go, return; some days are not written at all
        here = rng.random() < 0.5
        for ds in days:
            if rng.random() < 0.25:
                here = not here
            if here and ds not in ("20240604", "20240605"):
                rows += [(key % 7 if key % 11 else None, f"k{key}", ds)] * rng.choice([1, 1, 2])
    snapshots = spark.createDataFrame(rows, "a long, b string, ds string")
    keys = ["a", "b"]
    first = RunDate.parse(days[0])
    ledger = stage(start_ledger(snapshots.where(F.col("ds") == first.ds), keys, first), "ledger")
    for ds in days[1:]:
        run = RunDate.parse(ds)
        today = snapshots.where(F.col("ds") == ds)
        before = ledger
        if ds not in ("20240604", "20240605"):
            ledger = stage(advance_ledger(ledger, today, keys, run), "ledger")
            again = advance_ledger(before, today, keys, run)
            assert got(again) == got(ledger)
        want = got(snapshot_diff(snapshots, keys, run))
        columns = ["a", "b", "ds", "1d_is_created", "1m_is_created"]
        assert got(ledger_diff(today, ledger, keys, run).select(columns)) == want  # as of the day
        assert got(ledger_diff(today, before, keys, run).select(columns)) == want  # as of the day before
    assert ledger.where("a IS NULL").count() == 0
    overlaps = ledger.alias("x").join(ledger.alias("y"), keys).where("x.first_day < y.first_day AND x.last_day >= y.first_day")
    assert overlaps.count() == 0


def test_ended_intervals_go_when_nobody_asks(frame):
    run = RunDate.parse("20240602")
    ledger = frame("k long, first_day string, last_day string", (1, "20240401", "20240430"), (2, "20240501", "20240531"), (3, "20240501", "20240601"), (4, "20240601", "20240601"))
    out = advance_ledger(ledger, frame("k long", (3,), (3,), (5,), (None,)), ["k"], run, keep_from=run.prev_month_end)
    assert got(out, "k", "first_day", "last_day") == [
        (2, "20240501", "20240531"), (3, "20240501", "20240602"), (4, "20240601", "20240601"), (5, "20240602", "20240602"),
    ]
    empty = advance_ledger(ledger.where("k < 0"), frame("k long"), ["k"], run)
    assert got(empty) == []


def test_ended_intervals_are_not_shuffled(frame):
    ledger = frame("k long, first_day string, last_day string", (1, "20240401", "20240430"), (2, "20240501", "20240601"))
    text = plan(advance_ledger(ledger, frame("k long", (2,)), ["k"], RunDate.parse("20240602")))
    union = text[text.index("== Physical Plan =="):]
    assert union.count("FullOuter") == 1 and "Exchange" not in union[union.rindex("\n   +- "):]


def test_bitmaps_count_what_count_distinct_does(spark):
    rng = random.Random(5)
    values = [0, 1, -1, 32768, 32769, -32768, -32769, 2**40, -(2**40), 2**62, None, *range(100, 130)]
    rows = [(rng.choice(["x", "y", None]), rng.choice(values), ds) for ds in june_days(30)[2:] for _ in range(25) if ds != "20240607"]
    df = spark.createDataFrame(rows, "g string, v long, ds string")
    so_far = None
    for ds in june_days(30)[2:]:
        so_far = stage(month_to_date_bitmaps(so_far, distinct_bitmaps(df.where(F.col("ds") == ds), ["g"], "v"), ["g"]), "mtd")
        want = count_distinct_by(df.where(F.col("ds") <= ds), ["g"], "v", "n").where("n > 0")
        assert got(count_bitmaps(so_far, ["g"], "n")) == got(want)
    again = merge_bitmaps([so_far, so_far, distinct_bitmaps(df, ["g"], "v")], ["g"])
    assert got(count_bitmaps(again, ["g"], "n")) == got(count_bitmaps(so_far, ["g"], "n"))
    assert got(count_bitmaps(distinct_bitmaps(df.where("v IS NULL"), ["g"], "v"), ["g"], "n")) == []


def test_values_are_set_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    text = plan(distinct_bitmaps(df, ["g"], "v"))
    physical = text[text.index("== Physical Plan =="):]
    assert physical.index("Exchange") < physical.index("partial_bitmap_construct_agg")


LOG = TableSpec("", T.StructType([column("id", T.LongType()), column("at", T.LongType()), column("v", T.StringType())]))


@pytest.fixture
def table(spark):
    spec = LOG.named(f"log_{random.randrange(10**9)}").bucketed(["id"], 3)
    ensure_table(spark, spec)
    yield spec
    spark.sql(f"DROP TABLE IF EXISTS {spec.name}")


def merged(spark, spec, increment, ds, **kwargs):
    old = spark.table(spec.name).where(F.col("ds") == ds).drop("ds")
    return merge_increment(old, increment, ["id"], ["at"], ["v"], buckets=spec.buckets, **kwargs)


@pytest.mark.parametrize("kwargs", [{"max_bytes": 0}, {}])
def test_days_of_a_bucketed_table_follow_each_other(spark, frame, table, kwargs):
    schema = "id long, at long, v string"
    old = frame(schema, *[(i, 0, f"old{i}") for i in range(50)], (7, 0, "copy"), (None, 0, "no id"))
    increment = frame(schema, (3, 1, "a"), (3, 2, "b"), (7, 1, "c"), (90, 1, "new"), (None, 5, "none"))
    write_partition(old, table, "20240601")
    for _ in range(2):  # a second run changes nothing
        write_partition(merged(spark, table, increment, "20240601", **kwargs), table, "20240602", in_buckets=True)
    now = spark.table(table.name).where("ds = '20240602'").drop("ds")
    assert got(now) == got(merge_increment(old, increment, ["id"], ["at"], ["v"]))
    assert got(spark.table(table.name).where("ds = '20240601'").drop("ds")) == got(old)
    # what was merged still lies in its buckets: joined with itself, nothing is shuffled
    joined = plan(now.hint("merge").join(spark.table(table.name).where("ds = '20240601'"), "id"))
    assert "Exchange" not in joined[joined.index("== Physical Plan =="):]
    assert now.select(F.input_file_name().alias("f")).distinct().count() <= 2 * table.buckets


def test_a_large_increment_does_not_move_the_snapshot(spark, frame, table, monkeypatch):
    write_partition(frame("id long, at long, v string", *[(i, 0, "x") for i in range(50)]), table, "20240601")
    increment = frame("id long, at long, v string", *[(i, 1, "y") for i in range(0, 90, 2)])
    for limit in (1 << 30, -1):  # as a hash table, and sorted
        monkeypatch.setattr(merge, "HASHED_LIMIT", limit)
        out = merged(spark, table, increment, "20240601", max_bytes=0)
        text = plan(out)
        physical = text[text.index("== Physical Plan =="):]
        lines = physical.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
        assert "Bucketed: true" in lines[scan]
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        above, least = [], depth(lines[scan])
        for line in reversed(lines[:scan]):
            if depth(line) < least:
                above.append(line.strip(" :+-"))
                least = depth(line)
        assert any("LeftAnti" in line for line in above) and not any("Exchange" in line for line in above)
        assert any(line.startswith("Sort ") for line in above) == (limit < 0)
        assert out.count() == 70


def test_a_day_of_nothing(spark, frame, table):
    empty = frame("id long, at long, v string")
    write_partition(frame("id long, at long, v string", (1, 0, "x")), table, "20240601")
    write_partition(empty, table, "20240601")
    assert spark.table(table.name).count() == 0
    write_partition(merged(spark, table, empty, "20240601"), table, "20240602", in_buckets=True)
    assert spark.table(table.name).count() == 0


def test_other_buckets_are_refused(spark, table, tmp_path):
    with pytest.raises(ValueError, match="does not lie in 4 buckets"):
        ensure_table(spark, table.bucketed(["id"], 4))
    with pytest.raises(ValueError, match="does not lie in"):
        ensure_table(spark, table.bucketed(["at"], 3))
    ensure_table(spark, table)
    with pytest.raises(ValueError, match="only a table"):
        write_partition(spark.table(table.name).drop("ds"), table, "20240601", path=str(tmp_path))


def test_the_job_merges_within_its_own_table(spark):
    spec = REWARD_LOG.named(f"rewards_{random.randrange(10**9)}").bucketed(["id"], 4)
    ensure_table(spark, spec)
    row = "{0}L AS id, 1L AS task_id, 1L AS user_id, 0L AS received, 1L AS user_task_id, 0L AS turn, '' AS attach, false AS deleted, timestamp_ntz'2024-01-01' AS created, timestamp_ntz'{1}' AS lastmodified, '{2}' AS reward_snapshot, '' AS receive_detail"
    old = spark.sql("SELECT " + row.format(1, "2024-06-01", "a") + " UNION ALL SELECT " + row.format(2, "2024-06-01", "b"))
    new = spark.sql("SELECT " + row.format(2, "2024-06-02", "c") + " UNION ALL SELECT " + row.format(3, "2024-06-02", "d")).withColumn("ds", F.lit("20240602"))
    write_partition(old, spec, "20240601")
    run_job("reward_merge_bucketed", Catalog(spark, {"reward_snapshot": spec.name, "reward_increment": new}), RunDate.parse("20240602"), spec)
    assert got(spark.table(spec.name).where("ds = '20240602'"), "id", "reward_snapshot") == [(1, "a"), (2, "c"), (3, "d")]
    spark.sql(f"DROP TABLE {spec.name}")
