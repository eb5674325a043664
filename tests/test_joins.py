from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import got, plan
from dayledger.operators import (
    anti,
    checked_broadcast,
    fallback_join,
    fits,
    join_when,
    lookup,
    measured_bytes,
    salted_join,
    semi,
    spread_join,
)


def test_semi_and_anti(frame):
    left = frame("k int, v string", (1, "a"), (2, "b"), (None, "c"))
    right = frame("k int", (1,), (1,), (None,))
    assert got(semi(left, right, ["k"])) == [(1, "a")]
    assert got(anti(left, right, ["k"])) == [(None, "c"), (2, "b")]
    assert "LeftSemi" in plan(semi(left, right, ["k"])) and "LeftAnti" in plan(anti(left, right, ["k"]))


def test_join_when_keeps_rows_that_may_not_match(frame):
    left = frame("k int, t string", (1, "deco"), (1, "other"), (1, None), (2, "deco"))
    right = frame("k int, name string", (1, "x"), (1, "y"))
    out = join_when(left, right, ["k"], when=F.col("t") == "deco")
    assert got(out) == [(1, None, None), (1, "deco", "x"), (1, "deco", "y"), (1, "other", None), (2, "deco", None)]


@pytest.mark.parametrize("max_bytes", [0, 10**6])
def test_lookup_twice(frame, max_bytes):
    df = frame("id int, city int, prov int", (1, 5, 6), (2, 5, 5), (3, 99, None))
    area = frame("area int, name string", (5, "five"), (6, "six"))
    out = lookup(df, area, "area", "name", {"city": "city_name", "prov": "prov_name"}, max_bytes)
    assert got(out, "id", "city_name", "prov_name") == [
        (1, "five", "six"), (2, "five", "five"), (3, None, None)]


@pytest.fixture
def levels(frame):
    base = frame("k int, b string", *[(k, "b") for k in (1, 2, 3, 4)], (None, "b"), (1, "again"))
    one = frame("k int, v string, ds string", (1, "one", "d9"), (None, "never", "d9"))
    two = frame("k int, v string, ds string", (1, "two", "d1"), (2, "two", "d1"), (2, "two", "d2"), (5, "x", "d1"))
    three = frame("k int, v string, ds string", (1, "three", "d1"), (2, "three", "d1"), (3, "three", "d1"))
    return base, [one, two, three]


@pytest.mark.parametrize("prefilter, max_bytes", [(False, 0), (True, 0), (True, 10**6)])
def test_fallback(levels, prefilter, max_bytes):
    base, sources = levels
    out = fallback_join(base, sources, ["k"], ["v"], level="level", prefilter=prefilter, max_bytes=max_bytes)
    assert got(out, "k", "b", "v", "level") == [
        (None, "b", None, None), (1, "again", "one", 1), (1, "b", "one", 1), (2, "b", "two", 2), (2, "b", "two", 2),
        (3, "b", "three", 3), (4, "b", None, None)]


def test_fallback_keeps_every_base_row(levels):
    base, sources = levels
    for n in range(1, len(sources) + 1):
        out = fallback_join(base, sources[:n], ["k"], ["v"])
        assert got(out.select("k", "b").distinct()) == got(base.distinct())


def test_fallback_latest_only(levels):
    base, sources = levels
    out = fallback_join(base, sources, ["k"], ["v"], latest_only=True, spread_nulls=True)
    assert out.columns == ["k", "b", "v"]
    assert got(out.where("k = 2"), "v") == [("two",)] and out.count() == 6


def test_measured_bytes(frame):
    df = frame("a bigint, s string", (1, "12345"), (2, None))
    assert measured_bytes(df) == 2 * (8 + 8 + 16) + 5
    assert measured_bytes(df.where("a > 5")) == 0
    assert fits(df, 69) and not fits(df, 68)


def test_broadcast_only_when_measured_to_fit(spark, frame):
    left = frame("a bigint, x int", (1, 1))
    right = frame("a bigint, s string", (1, "12345"))
    assert "BroadcastHashJoin" in plan(left.join(checked_broadcast(right, 1000), "a"))
    assert "strategy=broadcast" not in plan(left.join(checked_broadcast(right, 1), "a"))


KEYS = st.sampled_from([None, 1, 2, 3])
ROWS = st.lists(st.tuples(KEYS, KEYS), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=ROWS, right=ROWS)
def test_spread_join_gives_the_plain_joins_rows(frame, left, right):
    l = frame("k int, j int, x int", *[(k, j, i) for i, (k, j) in enumerate(left)])
    r = frame("k int, j int, y int", *[(k, j, i) for i, (k, j) in enumerate(right)])
    for keys, how in product((["k"], ["k", "j"]), ("inner", "left", "left_semi", "left_anti")):
        other = r if len(keys) == 2 else r.drop("j")
        present = sorted({tuple(row[i] for i in range(len(keys))) for row in right if None not in row[:len(keys)]})
        out = spread_join(l, other, keys, how, hot_left=[(1,) * len(keys)], hot_right=present[:2],
                          spread_nulls=True, ways=3)
        plain = l.join(other, keys, how)
        assert got(out, *plain.columns) == got(plain)
    present = sorted({(k,) for k, _ in right if k is not None})
    when = F.col("x") % 2 == 0
    out = spread_join(l, r.drop("j"), ["k"], "left", when=when, hot_left=[(1,)], hot_right=present[:2], ways=3)
    kept = l.where(when).join(r.drop("j"), "k", "left").unionByName(
        l.where(~when).withColumn("y", F.lit(None).cast("int")))
    assert got(out, "k", "j", "x", "y") == got(kept, "k", "j", "x", "y")


def test_spread_left_join_with_a_condition(frame):
    left = frame("k int, t string", (1, "y"), (1, "n"), (2, "y"), (None, "y"))
    right = frame("k int, v int", *[(1, i) for i in range(5)])
    out = spread_join(left, right, ["k"], "left", when=F.col("t") == "y", hot_right=[(1,)], ways=4)
    assert got(out) == [(None, "y", None), (1, "n", None), *[(1, "y", i) for i in range(5)], (2, "y", None)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_key_with_a_third_of_all_rows_is_spread(spark, how):
    big = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k", "id AS x")
    small = spark.range(0, 9000, 2).selectExpr("id AS k", "id AS y").unionAll(
        spark.sql("SELECT 1L AS k, -1L AS y"))
    out = salted_join(big, small, ["k"], how, ways=8, min_rows=100)
    plain = big.join(small, "k", how)
    assert got(out, *plain.columns) == got(plain)
    assert "_left_slot" in plan(out)


@pytest.fixture
def shuffled(spark):
    """Without broadcasts and adaptive execution: only what the join does itself."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def tasks(df):
    return len(df.select(F.spark_partition_id().alias("t")).distinct().collect())


def test_hot_rows_reach_many_tasks(spark, shuffled):
    """Equal rows of one key on the right of a left join, which adaptive execution cannot split."""
    left = spark.range(10).selectExpr("id AS k")
    right = spark.range(0, 4000, 1, 4).selectExpr("3L AS k", "'same' AS v")
    out = salted_join(left, right, ["k"], "left", ways=16, min_rows=100)
    assert out.where("k = 3").count() == 4000 and out.count() == 4009
    assert tasks(out.where("k = 3")) > 1


def test_rows_without_a_key_reach_many_tasks(spark, shuffled):
    left = spark.range(0, 1000, 1, 4).selectExpr("IF(id < 990, NULL, id) AS k", "id AS x")
    right = spark.range(980, 995).selectExpr("id AS k", "id AS v").dropna()
    out = spread_join(left, right, ["k"], "left", spread_nulls=True, ways=16)
    assert out.count() == 1000 and out.where("v IS NOT NULL").count() == 5
    assert tasks(out.where("k IS NULL")) > 1
    assert tasks(left.join(right, "k", "left").where("k IS NULL")) == 1


def test_fallback_spreads_its_base_once(spark, shuffled):
    key = "CASE WHEN id < 400 THEN NULL WHEN id < 800 THEN 7 ELSE id END AS k"
    base = spark.range(0, 1000, 1, 4).selectExpr(key, "id AS x")
    one = spark.range(900, 950).selectExpr("id AS k", "'one' AS v")
    two = spark.range(0, 920).selectExpr("id AS k", "'two' AS v")
    out = fallback_join(base, [one, two], ["k"], ["v"], hot=[(7,)], spread_nulls=True)
    assert got(out.groupBy("v").count()) == [(None, 450), ("one", 50), ("two", 500)]
    assert tasks(out.where("k = 7")) > 1 and tasks(out.where("k IS NULL")) > 1
    assert plan(out).split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 3


def test_a_hot_key_that_is_gone_loses_no_row(frame):
    left = frame("k int, a string", (1, "x"), (2, "y"), (None, "z"))
    right = frame("k int, b string", (2, "p"), (2, "q"))
    out = spread_join(left, right, ["k"], "left", hot_right=[(1,), (2,)], ways=5)
    assert got(out, "k", "a", "b") == [(None, "z", None), (1, "x", None), (2, "y", "p"), (2, "y", "q")]


def test_a_thousand_composite_hot_keys(frame):
    left = frame("k int, l string, a int", *[(i, f"s{i}", i) for i in range(0, 1200, 100)])
    right = frame("k int, l string, b int", *[(i, f"s{i}", -i) for i in range(0, 1200, 200)])
    hot = [(i, f"s{i}") for i in range(1000)]
    plain = got(left.join(right, ["k", "l"], "left"), "k", "l", "a", "b")
    assert got(spread_join(left, right, ["k", "l"], "left", hot_left=hot, hot_right=hot, ways=3), "k", "l", "a", "b") == plain


def test_slots_follow_a_keys_share(spark):
    from dayledger.operators.skew import HotKey, slot_count

    hot = [HotKey.of((1,), 0.3), HotKey.of((2,), 0.001), (3,)]
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "k int")
    slots = {r["k"]: r["n"] for r in df.select("k", slot_count(["k"], hot, 200).alias("n")).collect()}
    assert slots == {1: 128, 2: 2, 3: 200, 4: 1, None: 1}


def test_names_come_last_whichever_way_they_are_joined(frame):
    df = frame("id int, a int, b int", (1, 7, 8), (2, None, 9))
    dim = frame("k int, v string", (7, "seven"), (9, "nine"))
    outs = [lookup(df, dim, "k", "v", {"a": "an", "b": "bn"}, max_bytes=n) for n in (0, 10**6)]
    assert outs[0].columns == outs[1].columns == ["id", "a", "b", "an", "bn"]
    assert got(outs[0]) == got(outs[1]) == [(1, 7, 8, "seven", None), (2, None, 9, None, "nine")]


@pytest.mark.parametrize("hot", [[], [(7,), (8,)]])
def test_sources_that_no_broadcast_cuts_meet_the_base_once(spark, frame, hot):
    base = frame("k long", (1,), (2,), (7,), (8,), (None,))
    one = frame("k long, v string", (7, "a"), (7, "a"), (None, "x"), (9, "far"), (1, None))
    two = frame("k long, v string", (7, "b"), (2, "c"), (2, "d"), (8, "e"), (8, "e"), (10, "far"), (1, "late"))
    three = frame("k long, v string", (2, "f"), (8, "g"), (None, "y"))
    sources = [one, two, three]
    out = fallback_join(base, sources, ["k"], ["v"], level="level", prefilter=True, max_bytes=0, hot_sources=hot)
    physical = plan(out).split("== Physical Plan ==")[1]
    # a task holds neither the keys beside each source nor a scan's rows in order
    assert "LeftSemi" not in physical and "WindowGroupLimit" not in physical
    cut = fallback_join(base, sources, ["k"], ["v"], level="level", prefilter=True, max_bytes=10**6, hot_sources=hot)
    assert plan(cut).split("== Physical Plan ==")[1].count("LeftSemi") >= 3
    want = [(None, None, None), (1, None, 1), (2, "c", 2), (2, "d", 2), (7, "a", 1), (7, "a", 1), (8, "e", 2), (8, "e", 2)]
    assert got(out) == got(cut) == want


@pytest.mark.parametrize("hot", [[], [(7,)]])
def test_fallback_tasks_stay_small_however_few_parts_the_session_has(spark, shuffled, monkeypatch, hot):
    base = spark.range(0, 4000).selectExpr("IF(id % 50 = 0, 7, id) AS k", "id AS x")
    one = spark.range(0, 3000, 1, 4).selectExpr("id AS k", "concat('one', id) AS v")
    two = spark.range(1000, 3500, 1, 4).selectExpr("id AS k", "concat('two', id) AS v")

    def join():
        return fallback_join(base, [one, two], ["k"], ["v"], prefilter=True, max_bytes=0, hot_sources=hot)

    plain = join()
    want, before = got(plain), tasks(plain)
    monkeypatch.setattr("dayledger.operators.sizing.TASK_BYTES", 16 * 1024)
    dealt = join()
    assert got(dealt) == want and len(want) == 4000
    assert before <= 4 < 10 < tasks(dealt)
