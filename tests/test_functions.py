import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import got
from dayledger import RunDate
from dayledger.functions import (
    category_filter,
    child_or_parent,
    conform,
    eq,
    fill_defaults,
    fill_missing,
    first_rule,
    flag,
    format_ds,
    in_list,
    label,
    month_key,
    month_start,
    not_in_list,
    parse_ds,
    period_flags,
    prev_month_end,
    remap,
    same_month,
    to_bigint,
)
from dayledger.plans.apply_count import COUNTED_CATEGORIES
from dayledger.plans.order_material import REVIEW_STATUS
from dayledger.plans.relation_tags import OTHER_USAGE, USAGE
from dayledger.plans.render_flags import CAMERA, OTHER_CAMERA


def one(df, expr):
    return [row[0] for row in df.select(expr).collect()]


def test_label_without_default_leaves_other_codes_null(frame):
    df = frame("c int", *[(c,) for c in (27, 28, 29, 30, 31, 32, 33, None)])
    assert one(df, label("c", REVIEW_STATUS)) == [
        "待审核", "审核中", "已通过", "已撤回", "已驳回", "已退回", None, None]


def test_label_with_default_covers_null(frame):
    df = frame("c int", (1,), (2,), (3,), (4,), (None,))
    assert one(df, label("c", CAMERA, OTHER_CAMERA)) == ["普通图", "全景图", "俯视图", "其它", "其它"]


def test_label_of_code_sets(frame):
    df = frame("c int", *[(c,) for c in (0, 1, 2, 3, 4, None)])
    assert one(df, label("c", USAGE, OTHER_USAGE)) == ["自建", "授权", "授权", "授权", "公库", "公库"]


def test_flag_and_three_valued_logic(frame):
    df = frame("a boolean, b boolean", (True, None), (False, None), (None, None), (None, True))
    assert one(df, flag(F.col("a") | F.col("b"))) == [True, False, False, True]
    assert one(df, flag(F.col("a") & F.col("b"))) == [False, False, False, False]


def test_first_rule_takes_the_first_true_condition(frame):
    df = frame("a int", (1,), (2,), (3,), (None,))
    rules = [(F.col("a") < 2, "low"), (F.col("a") < 3, "mid")]
    assert one(df, first_rule(rules, "rest")) == ["low", "mid", "rest", "rest"]
    assert one(df, first_rule(rules)) == ["low", "mid", None, None]


def test_remap_and_parent(frame):
    df = frame("u int, a int", (1, 9), (2, 9), (None, 9))
    assert one(df, remap("u", 1, F.col("a"))) == [9, 2, None]
    assert one(df, child_or_parent("u", "a")) == [1, 2, 9]


def test_to_bigint(frame):
    df = frame("s string", ("12",), (None,))
    assert one(df, to_bigint("s")) == [12, None]
    dirty = frame("s string", ("x1",))
    assert one(dirty, to_bigint("s", strict=False)) == [None]
    with pytest.raises(Exception):
        one(dirty, to_bigint("s"))


def test_filters_drop_null(frame):
    df = frame("f boolean, c int", (True, 1), (False, 2), (None, None))
    assert got(df.where(eq("f", False))) == [(False, 2)]
    assert got(df.where(in_list("c", [1, 5]))) == [(True, 1)]
    assert got(df.where(not_in_list("c", [1, 5]))) == [(False, 2)]


def test_category_rules_hit_and_just_missed(frame):
    cols = ["a", "b", "c"]
    df = frame(
        "a string, b string, c string",
        ("家具", None, None), ("硬装", "门", None), ("硬装", "墙面", "壁炉"), ("吊顶", "电气模块", "x"),
        ("软装", "门", "壁炉"), ("硬装", "窗", None), ("硬装", "墙面", "漆"), ("硬装", "墙面", None),
        ("吊顶", "灯", "壁炉"), (None, "门", None))
    assert len(got(df.where(category_filter(cols, COUNTED_CATEGORIES)))) == 4


@pytest.mark.parametrize("ds", ["20240101", "20240301", "20230301", "20250331", "20241231"])
def test_date_expressions_agree_with_the_run_date(frame, ds):
    run = RunDate.parse(ds)
    df = frame("ds string", (ds,))
    day = parse_ds("ds")
    assert one(df, day) == [run.day]
    assert one(df, F.date_format(month_start(day), "yyyyMMdd")) == [run.month_start]
    assert one(df, F.date_format(prev_month_end(day), "yyyyMMdd")) == [run.prev_month_end]
    assert one(df, F.date_format(F.date_sub(day, 1), "yyyyMMdd")) == [run.prev_day]


def test_month_is_not_minutes(frame):
    df = frame("t timestamp", (dt.datetime(2025, 9, 30, 12, 34),))
    assert one(df, month_key("t")) == ["202509"]
    assert one(df, format_ds("t")) == ["20250930"]


def test_period_bounds(frame):
    run = RunDate.parse("20240229")
    times = [dt.datetime(2024, 1, 31, 23, 59, 59), dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 28, 23, 59),
             dt.datetime(2024, 2, 29), dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(2024, 3, 1), None]
    df = frame("t timestamp", *[(t,) for t in times])
    today, this_month = period_flags("t", run)
    assert one(df, today) == [False, False, False, True, True, False, False]
    assert one(df, this_month) == [False, True, True, True, True, False, False]
    assert one(df, same_month("t", run))[-1] is None


def test_schema_alignment(frame):
    schema = T.StructType([
        T.StructField("1d", T.BooleanType()), T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])
    df = frame("id int, extra string, `1d` boolean", (1, "x", True))
    filled = conform(fill_missing(df, schema), schema)
    assert filled.columns == ["1d", "id", "n"] and got(filled) == [(True, 1, None)]
    assert [f.dataType for f in filled.schema] == [f.dataType for f in schema]
    defaults = conform(fill_defaults(df, {"n": 1}, schema), schema)
    assert defaults.schema["n"].dataType == T.LongType() and got(defaults) == [(True, 1, 1)]
