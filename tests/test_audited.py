"""Audits in the pass that writes, publishing by one step, runs that replace themselves, retention of paths."""

import random
from dataclasses import replace

import pytest
from conftest import got, plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger import RunDate
from dayledger.operators import audit_nulls, audit_result, audit_trend
from dayledger.plans import JOBS, run_job
from dayledger.sinks import (
    AuditFailed,
    TableSpec,
    append_partition,
    day_folders,
    drop_expired_path,
    ensure_table,
    figure_rows,
    observed_sources,
    publish_partition,
    trend_of,
    write_audited,
    write_partition,
)
from dayledger.sinks.tables import column, read_path
from dayledger.sources import Catalog

SPEC = TableSpec("", T.StructType([column("k", T.LongType()), column("v", T.StringType())]))
ROWS = [(1, "a"), (2, None), (3, None), (None, "d")]


def tasks_read(spark, action):
    """Rows that the tasks of an action read from its accumulating source."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    result = action(count)
    return seen.value, result


def test_figures_are_those_of_the_audits_and_cost_no_scan(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    source = frame("k long, v string", *ROWS)
    read, figures = tasks_read(spark, lambda count: write_audited(source.mapInArrow(count, source.schema), SPEC, "20240601", path, nulls=["k", "v"]))
    assert read == len(ROWS)  # the rows were made once
    written = read_path(spark, SPEC, path)
    assert figures["record_count"] == audit_result(written, "20240601").first()["final_count"]
    nulls = audit_nulls(written, ["k", "v"]).first().asDict()
    assert {k: figures[k] for k in nulls} == nulls == {"null_k_count": 1, "null_v_count": 2}
    none = write_audited(source.where("k > 9"), SPEC, "20240602", path, nulls=["k"])
    assert none == {"record_count": 0, "null_k_count": 0}


def test_sources_are_counted_on_their_way(spark, frame, tmp_path):
    left, right = frame("k long, v string", *ROWS), frame("k long, w string", *[(i, "x") for i in range(50)])
    sources, counted = observed_sources({"left": left, "right": right})
    write_partition(sources["left"].join(sources["right"].hint("merge"), "k", "left").select("k", "v"), SPEC, "20240601", str(tmp_path / "t"))
    assert counted() == {"left": 4, "right": 50}


def test_a_trend_from_kept_figures(spark, frame, tmp_path):
    path, kept = str(tmp_path / "t"), None
    for day in range(1, 13):
        ds = f"202406{day:02d}"
        figures = write_audited(frame("k long, v string", *ROWS * day), SPEC.named("t"), ds, path)
        rows = figure_rows(spark, SPEC.named("t"), ds, figures)
        kept = rows if kept is None else kept.unionByName(rows)
    assert got(trend_of(kept, "t")) == got(audit_trend(read_path(spark, SPEC, path)))
    assert trend_of(kept, "another").count() == 0


@pytest.fixture
def table(spark):
    spec = SPEC.named(f"shown_{random.randrange(10**9)}")
    ensure_table(spark, spec)
    yield spec
    spark.sql(f"DROP TABLE {spec.name}")


RULES = {"rows": lambda f: f["record_count"] >= 2, "keys": lambda f: f["null_k_count"] == 0}


def test_a_failing_day_is_not_shown(spark, frame, table):
    good, worse = frame("k long, v string", (1, "a"), (2, "b")), frame("k long, v string", (None, "c"))
    with pytest.raises(AuditFailed, match="rows, keys") as failed:
        publish_partition(worse, table, "20240601", RULES, nulls=["k"])
    assert failed.value.figures == {"record_count": 1, "null_k_count": 1}
    assert spark.table(table.name).count() == 0
    publish_partition(good, table, "20240601", RULES, nulls=["k"])
    write_partition(good, table, "20240602")
    before = got(spark.table(table.name))
    with pytest.raises(AuditFailed):
        publish_partition(worse, table, "20240601", RULES, nulls=["k"])
    with pytest.raises(AuditFailed):
        publish_partition(worse, table, "20240602", RULES, nulls=["k"])
    assert got(spark.table(table.name)) == before and len(before) == 4


def test_a_day_is_replaced_in_one_step(spark, frame, table):
    first, second = frame("k long, v string", (1, "a"), (2, "b")), frame("k long, v string", (3, "c"), (4, "d"), (5, "e"))
    write_partition(first, table, "20240601")
    reader = spark.table(table.name).where("ds = '20240601'")  # planned before, with the old files
    assert reader.count() == 2
    figures = publish_partition(second, table, "20240601", RULES, nulls=["k"])
    assert figures["record_count"] == 3
    assert got(spark.table(table.name), "k", "ds") == [(k, "20240601") for k in (3, 4, 5)]
    publish_partition(first, table, "20240601", RULES, nulls=["k"])  # and again, over a published day
    assert got(spark.table(table.name), "k") == [(1,), (2,)]
    assert "published" in spark.table(table.name).select(F.input_file_name()).first()[0]


def test_a_broken_write_shows_nothing(spark, frame, table):
    publish_partition(frame("k long, v string", (1, "a"), (2, "b")), table, "20240601", RULES, nulls=["k"])
    broken = frame("k long, v string", (1, "a")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        publish_partition(broken, table, "20240601", RULES, nulls=["k"])
    assert spark.table(table.name).count() == 2
    with pytest.raises(ValueError, match="plain"):
        publish_partition(broken, table.bucketed(["k"], 2), "20240601", RULES)


@pytest.mark.parametrize("kind", ["path", "table"])
def test_a_run_tried_again_replaces_itself(spark, frame, tmp_path, kind):
    spec = replace(SPEC, by_run=True).named(f"runs_{random.randrange(10**9)}")
    path = str(tmp_path / "t") if kind == "path" else None
    if path is None:
        ensure_table(spark, spec)
    one, two = frame("k long, v string", (1, "a"), (2, "b")), frame("k long, v string", (1, "a"), (9, "z"))
    for _ in range(2):
        append_partition(one, spec, "20240601", path, token="first")
        append_partition(two, spec, "20240601", path, token="second-1")
    append_partition(one, spec, "20240602", path, token="first")
    read = lambda: read_path(spark, spec, path) if path else spark.table(spec.name)
    assert got(read(), "ds", "run", "k") == [
        ("20240601", "first", 1), ("20240601", "first", 2), ("20240601", "second-1", 1), ("20240601", "second-1", 9),
        ("20240602", "first", 1), ("20240602", "first", 2),
    ]
    append_partition(one.where("k > 5"), spec, "20240601", path, token="first")  # nothing, the second time
    assert got(read().where("ds = '20240601'"), "run", "k") == [("second-1", 1), ("second-1", 9)]
    assert "PartitionFilters: [isnotnull(ds" in plan(read().where("ds = '20240601'"))
    for token in (None, "", "a/b", "a'b"):
        with pytest.raises(ValueError, match="token"):
            append_partition(one, spec, "20240601", path, token=token)
    with pytest.raises(ValueError, match="run by run"):
        write_partition(one, spec, "20240601", path)
    if path is None:
        spark.sql(f"DROP TABLE {spec.name}")


def test_days_under_a_path_expire(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for ds in ("20240101", "20240523", "20240524", "20240601"):
        write_partition(frame("k long, v string", (1, ds)), SPEC, ds, path)
    (tmp_path / "t" / "ds=notaday").mkdir()
    (tmp_path / "t" / "other").mkdir()
    run = RunDate.parse("20240531")
    assert day_folders(spark, path) == ["20240101", "20240523", "20240524", "20240601"]
    assert drop_expired_path(spark, path, run, 7) == ["20240101", "20240523"]
    assert drop_expired_path(spark, path, run, 7) == []
    assert got(read_path(spark, SPEC, path).where("k = 1"), "ds") == [("20240524",), ("20240601",)]
    assert (tmp_path / "t" / "other").exists() and (tmp_path / "t" / "ds=notaday").exists()
    assert drop_expired_path(spark, str(tmp_path / "absent"), run, 7) == []


def test_a_job_expires_days_under_its_path(spark, tmp_path):
    row = "SELECT {0}L AS id, 1L AS task_id, 1L AS user_id, 0L AS received, 1L AS user_task_id, 0L AS turn, '' AS attach, false AS deleted, timestamp_ntz'2024-01-01' AS created, timestamp_ntz'2024-01-01' AS lastmodified, '' AS reward_snapshot, '' AS receive_detail, '{1}' AS ds"
    catalog = Catalog(spark, {"reward_snapshot": spark.sql(row.format(1, "20240530")), "reward_increment": spark.sql(row.format(2, "20240531"))})
    spec = replace(JOBS["reward_merge"].spec, retention_days=3)
    path = str(tmp_path / "t")
    for ds in ("20240527", "20240529"):
        write_partition(spark.sql(row.format(1, ds)), spec, ds, path)
    run_job("reward_merge", catalog, RunDate.parse("20240531"), spec, path, expire=True)
    assert day_folders(spark, path) == ["20240529", "20240531"]
    assert got(read_path(spark, spec, path).where("ds = '20240531'"), "id") == [(1,), (2,)]
