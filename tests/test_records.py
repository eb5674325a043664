import datetime as dt

import pytest

from conftest import got, plan
from dayledger import RunDate
from dayledger.operators import (
    dedup,
    duplicate_keys,
    first_per_key,
    hot_keys,
    latest_per_key,
    mark,
    merge_increment,
    seen_on,
    snapshot_diff,
)
from dayledger.operators.skew import hot_keys_each

RUN = RunDate.parse("20240315")


def day(n):
    return dt.datetime(2024, 1, n)


@pytest.fixture
def submissions(frame):
    return frame("design int, ord int, at timestamp",
                 (1, 10, day(1)), (1, 11, day(1)), (1, 12, day(2)),  # a tie at the first moment
                 (2, 20, day(3)), (2, 21, None),  # NULL sorts first
                 (3, 30, None), (3, 31, None),
                 (None, 40, day(5)), (None, 41, day(4)))


FIRST_TIED = [(None, 41), (1, 10), (1, 11), (2, 21), (3, 30), (3, 31)]


def test_first_with_ties(submissions):
    assert got(first_per_key(submissions, ["design"], ["at"], ties=True), "design", "ord") == FIRST_TIED


@pytest.mark.parametrize("hot", [[(1,)], [(2,), (3,)], [(1,), (2,), (3,)], [(99,)]])
def test_first_with_ties_and_hot_keys(submissions, hot):
    out = first_per_key(submissions, ["design"], ["at"], ties=True, hot=hot)
    assert out.columns == submissions.columns
    assert got(out, "design", "ord") == FIRST_TIED


def test_first_single(submissions):
    out = first_per_key(submissions, ["design"], ["at"], tiebreak=["ord"])
    assert got(out, "design", "ord") == [(None, 41), (1, 10), (2, 21), (3, 30)]
    with pytest.raises(ValueError):
        first_per_key(submissions, ["design"], ["at"])


def test_latest(submissions):
    out = latest_per_key(submissions, ["design"], ["at"], ["ord"])
    assert got(out, "design", "ord") == [(None, 40), (1, 12), (2, 20), (3, 31)]
    with pytest.raises(ValueError):
        latest_per_key(submissions, ["design"], ["at"], [])


def test_rows_are_cut_before_the_shuffle(submissions):
    single = plan(first_per_key(submissions, ["design"], ["at"], tiebreak=["ord"]))
    assert single.count("WindowGroupLimit") >= 2  # before and after the exchange


def test_dedup_counts_nulls_as_equal(frame):
    df = frame("a int, b int", (1, None), (1, None), (1, 2))
    assert got(dedup(df)) == [(1, None), (1, 2)]
    assert got(dedup(df, ["a"])) == [(1,)]


def test_duplicate_keys(frame):
    df = frame("a int", (1,), (1,), (2,), (None,), (None,))
    assert got(duplicate_keys(df, ["a"])) == [(1, 2)]


def test_mark(frame):
    left = frame("a int, b string", (1, "x"), (1, None), (2, "x"), (3, "y"))
    right = frame("a int, b string", (1, "x"), (1, "x"), (1, None), (9, "z"))
    assert got(mark(left, right, ["a", "b"], "seen")) == [
        (1, None, False), (1, "x", True), (2, "x", False), (3, "y", False)]
    repeated = mark(left, right, ["a", "b"], "seen", dedup=False)
    assert got(repeated).count((1, "x", True)) == 2


def test_seen_on_reads_the_days_once(frame):
    df = frame("k int, ds string", (1, "20240314"), (1, "20240229"), (1, "20240314"), (2, "20240229"),
               (3, "20240101"), (None, "20240314"))
    out = seen_on(df, ["k"], {"yesterday": RUN.prev_day, "last_month": RUN.prev_month_end})
    assert got(out) == [(1, True, True), (2, False, True)]


def test_snapshot_diff(frame):
    rows = [("a", 1, RUN.ds), ("a", 1, RUN.ds), ("b", 1, RUN.ds), ("c", 1, RUN.ds), ("d", None, RUN.ds),
            ("a", 1, RUN.prev_day), ("a", 1, RUN.prev_day), ("b", 1, RUN.prev_day), ("d", None, RUN.prev_day),
            ("gone", 1, RUN.prev_day), ("a", 1, RUN.prev_month_end), ("d", None, RUN.prev_month_end)]
    df = frame("k string, n int, ds string", *rows)
    out = snapshot_diff(df, ["k", "n"], RUN, "today", "month").drop("ds")
    assert got(out) == [
        ("a", 1, False, False), ("a", 1, False, False), ("b", 1, False, True), ("c", 1, True, True),
        ("d", None, True, True)]  # a key with a NULL part always counts as new
    literal = snapshot_diff(df, ["k", "n"], RUN, "today", "month", dedup=False)
    assert literal.where("k = 'a'").count() == 4  # two rows, two copies yesterday


def test_snapshot_diff_on_the_first_of_a_month(frame):
    run = RunDate.parse("20240301")
    df = frame("k string, ds string", ("a", "20240301"), ("b", "20240301"), ("a", "20240229"))
    assert got(snapshot_diff(df, ["k"], run, "today", "month").drop("ds")) == [
        ("a", False, False), ("b", True, True)]


@pytest.fixture
def log(frame):
    snapshot = frame("id int, v string, at timestamp, deleted boolean",
                     (1, "old", day(1), False), (2, "old", day(1), False), (None, "old", day(1), False))
    increment = frame("id int, v string, at timestamp, deleted boolean",
                      (1, "a", day(2), False), (1, "b", day(2), False), (1, "c", None, False),
                      (3, "new", day(3), True))
    return snapshot, increment


@pytest.mark.parametrize("max_bytes", [0, 10**6])
def test_merge(log, max_bytes):
    snapshot, increment = log
    out = merge_increment(snapshot, increment, ["id"], ["at"], ["v"], max_bytes=max_bytes)
    assert got(out, "id", "v", "deleted") == [
        (None, "old", False), (1, "b", False), (2, "old", False), (3, "new", True)]


def test_merge_invariants(spark):
    snapshot = spark.range(500).selectExpr("id", "0 AS v")
    increment = spark.range(3000).selectExpr("pmod(hash(id), 700) AS id", "id AS v")
    out = merge_increment(snapshot, increment, ["id"], ["v"], ["v"])
    ids = {i for (i,) in got(increment.distinct(), "id")}
    assert out.count() == out.select("id").distinct().count() == len(ids | set(range(500)))
    assert out.where("v = 0").count() >= 500 - len(ids & set(range(500)))
    assert got(out.where("v > 0")) == got(increment.groupBy("id").agg({"v": "max"}).where("`max(v)` > 0"))


def test_merge_with_an_empty_increment(log):
    snapshot, increment = log
    out = merge_increment(snapshot, increment.where("id < 0"), ["id"], ["at"], ["v"])
    assert got(out) == got(snapshot)


def test_merge_neither_shuffles_nor_sorts_the_snapshot(log):
    snapshot, increment = log
    text = plan(merge_increment(snapshot, increment, ["id"], ["at"], ["v"]))
    physical = text[text.index("== Physical Plan =="):]
    assert "BroadcastHashJoin" in physical and "LeftAnti" in physical
    assert physical.count("Exchange hashpartitioning") == 2  # the increment's, in both branches


def test_hot_keys(spark, frame):
    df = spark.range(1000).selectExpr("CASE WHEN id < 400 THEN 7 WHEN id < 410 THEN NULL ELSE id END AS k", "id % 2 AS m")
    assert hot_keys(df, ["k"], share=0.1, min_rows=1) == [(7,)]
    assert hot_keys(df, ["k", "m"], share=0.1, min_rows=1) == [(7, 0), (7, 1)]
    assert hot_keys(df, ["k"], share=0.1) == []  # too few rows to matter
    assert hot_keys(df.where("k < 0"), ["k"], share=0.1, min_rows=1) == []
    each = hot_keys_each([(df, ["k"]), (df.where("k < 0"), ["k"]), (df, ["m"])], share=0.3, min_rows=1)
    assert each == [[(7,)], [], [(0,), (1,)]]
