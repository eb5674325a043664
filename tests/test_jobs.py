"""The jobs on handmade rows: ties, repeated keys, NULLs, empty sources."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import got, plan
from dayledger import RunDate
from dayledger.operators import BROADCAST_LIMIT, merge_increment
from dayledger.plans import (
    JOBS,
    account_apply_detail,
    account_apply_detail_plain,
    daily_apply_count,
    monthly_apply_count,
    order_core,
    order_material_defaults,
    order_material_detail,
    order_material_detail_source,
    order_material_fallback,
    order_material_nulls,
    order_material_onepass,
    order_material_staged,
    order_material_three_level,
    relation_tags,
    render_flags,
    reward_merge,
    run_job,
)
from dayledger.plans import order_material as om
from dayledger.plans.apply_detail import MATERIAL
from dayledger.plans.schemas import APPLY_DETAIL, ORDER_MATERIAL, REWARD_LOG
from dayledger.sinks import ensure_table, stage
from dayledger.sinks.tables import read_path
from dayledger.sources import Catalog

RUN = RunDate.parse("20240315")
DS, YDAY, MONTH_END = RUN.ds, RUN.prev_day, RUN.prev_month_end


def ts(month, day, hour=0):
    return dt.datetime(2024, month, day, hour)


# Apply counts


@pytest.fixture
def apply_tables(spark, frame):
    designs = frame(
        "design_id bigint, org_id bigint, level1_node_name string, level2_node_name string, "
        "design_type string, design_created timestamp, ds string",
        (1, 10, "a", "b", "normal", ts(3, 1), DS), (2, 10, "a", "b", "normal", ts(3, 31, 23), DS),
        (3, 10, "a", None, "normal", ts(3, 5), DS),
        (4, 10, "a", "b", "copy", ts(3, 5), DS), (5, 10, "a", "b", "blank", ts(3, 5), DS),
        (6, 10, "a", "b", None, ts(3, 5), DS), (None, 10, "a", "b", "normal", ts(3, 5), DS),
        (7, 10, "a", "b", "normal", ts(2, 29), DS), (8, 10, "a", "b", "normal", ts(4, 1), DS),
        (9, 10, "a", "b", "normal", ts(3, 5), YDAY), (11, 20, "a", "b", "normal", ts(3, 5), DS))
    accounts = frame(
        "join_user_id bigint, org_id bigint, deleted boolean, ds string",
        (100, 10, False, DS), (100, 10, False, DS), (101, 20, True, DS), (102, 10, None, DS), (103, 30, False, DS))
    models = frame(
        "brandgood_id bigint, brandgood_name string, user_id bigint, public_type string, "
        "prodcat1_name string, prodcat2_name string, prodcat3_name string, ds string",
        (50, "chair", 100, "private", "家具", None, None, DS), (51, "chair", 100, "private", "硬装", "门", None, DS),
        (52, "lamp", 100, "public", "照明", None, None, DS), (53, "sofa", 101, "private", "家具", None, None, DS),
        (54, "rug", 102, "private", "家具", None, None, DS), (55, "bed", 103, "private", "家具", None, None, DS),
        (56, "tile", 100, "private", "硬装", "墙面", "砖", DS))
    relation = [(d, b, 1, day) for d in range(1, 12) for b in range(50, 57) for day in (DS,)]
    relation += [(1, 50, 2, "20240301"), (2, 50, 1, "20240229"), (3, 51, 2, "20240316")]
    relation = [r for r in relation if r[:2] not in {(2, 51), (3, 50)}]
    increments = frame("design_id bigint, brandgood_id bigint, action_type int, ds string", *relation)
    return Catalog(spark, {"design_basic": designs, "business_account": accounts, "material": models,
                           "bridge_increment": increments})


@pytest.mark.parametrize("prefilter", [True, False])
@pytest.mark.parametrize("max_bytes", [0, BROADCAST_LIMIT])
def test_monthly_apply_count(apply_tables, prefilter, max_bytes):
    assert got(monthly_apply_count(apply_tables, RUN, prefilter=prefilter, max_bytes=max_bytes)) == [
        (10, "a", None, "chair", 1), (10, "a", "b", "chair", 2)]


def test_apply_count_with_a_hot_design(apply_tables, monkeypatch):
    monkeypatch.setattr("dayledger.plans.apply_count.hot_keys", lambda df, keys: [(1,)])
    out = monthly_apply_count(apply_tables, RUN, max_bytes=0)
    assert "_left_slot" in plan(out)
    assert got(out) == [(10, "a", None, "chair", 1), (10, "a", "b", "chair", 2)]


def test_daily_apply_count_takes_added_relations_of_the_day(apply_tables):
    bridge = apply_tables.table("bridge_increment")
    kept = bridge.withColumn("action_type", F.when(F.col("design_id") == 2, 2).otherwise(F.col("action_type")))
    catalog = Catalog(apply_tables.spark, {**apply_tables.tables, "bridge_increment": kept})
    assert got(daily_apply_count(catalog, RUN)) == [(10, "a", None, "chair", 1), (10, "a", "b", "chair", 1)]


# Account details


def detail_tables(spark, frame, extra_designs=()):
    material = [F.lit(None).cast(APPLY_DETAIL.schema[c].dataType).alias(c)
                for c in MATERIAL if c not in ("brandgood_id", "root_account_id")]
    materials = frame("brandgood_id bigint, root_account_id bigint, ds string",
                      (1, 106940, DS), (2, 1126425, DS), (3, 5, DS), (4, None, DS), (1, 106940, YDAY))
    designs = frame(
        "design_id bigint, root_account_id bigint, deleted boolean, comm_logic_area_id bigint, "
        "comm_logic_province_id bigint, ds string",
        (10, 106940, False, 7, 8, DS), (11, 1126425, False, 7, 7, DS), (12, 106940, True, 7, 8, DS),
        (13, 5, False, 7, 8, DS), (14, 106940, None, 7, 8, DS), (15, 106940, False, 99, None, DS), *extra_designs)
    others = ["user_id bigint", "created timestamp", "lastmodified timestamp", *[
        f"{c} string" for c in ("community_name", "user_name", "province_name", "city_name",
                                "fpspec_devide_1", "area_devide_1")]]
    for col in others:
        name, kind = col.split()
        designs = designs.withColumn(name, F.lit(None).cast(kind))
    pairs = [(d, m, DS) for d in range(10, 16) for m in range(1, 5)]
    return Catalog(spark, {
        "account_material": materials.select("*", *material),
        "design": designs,
        "bridge": frame("design_id bigint, brandgood_id bigint, ds string", *pairs, *pairs, (None, 1, DS), (10, 2, YDAY)),
        "area": frame("area_id bigint, name string, ds string", (7, "seven", DS), (8, "eight", DS), (8, "old", YDAY)),
    })


@pytest.mark.parametrize("job", [account_apply_detail, account_apply_detail_plain])
@pytest.mark.parametrize("max_bytes", [0, BROADCAST_LIMIT])
def test_account_apply_detail(spark, frame, job, max_bytes):
    out = job(detail_tables(spark, frame), RUN, max_bytes=max_bytes)
    assert out.columns == APPLY_DETAIL.schema.names
    assert got(out, "brandgood_id", "design_id", "relation_design_id", "design_community_city_name",
               "design_community_province_name") == [
        (1, 10, 10, "seven", "eight"), (1, 15, 15, None, None), (2, 11, 11, "seven", "seven")]


def test_a_repeated_design_tells_the_variants_apart(spark, frame, monkeypatch):
    twice = detail_tables(spark, frame, [(10, 106940, False, 7, 8, DS)])
    assert account_apply_detail(twice, RUN).where("design_id = 10").count() == 4
    monkeypatch.setattr("dayledger.plans.apply_detail.hot_keys_each", lambda relations: [[(1,)], [(10,), (11,)]])
    spread = account_apply_detail(twice, RUN, max_bytes=0)
    assert "_left_slot" in plan(spread) and spread.where("design_id = 10").count() == 4
    assert spread.count() == 4 + 2
    assert account_apply_detail_plain(twice, RUN).where("design_id = 10").count() == 2


# Render flags


def test_render_flags(spark, frame):
    schema = ("pic_id bigint, design_id bigint, camera_type_id bigint, user_id bigint, author_id bigint, "
              "from_pid bigint, deleted boolean, created timestamp, ds string")
    rows = [
        (1, 1, 1, 5, 6, None, False, ts(3, 15, 9), DS),  # made today
        (2, 1, None, 1, 6, None, False, ts(3, 1), DS),  # owner 1: deleted, author counts; new since yesterday
        (3, 1, 9, 5, 6, None, True, ts(2, 1), DS),  # deleted before month end
        (4, 1, 2, 5, 6, None, True, None, DS),  # deleted this month, not today
        (5, 1, 3, 5, 6, None, None, ts(2, 29), DS),  # unknown counts as not deleted
        (6, 1, 1, 5, 6, 3, True, ts(3, 15), DS),  # a copy
        (7, 1, 1, 77, 6, None, True, ts(3, 15), DS),  # no such user
        (2, 1, 1, 5, 6, None, False, ts(3, 1), YDAY), (3, 1, 1, 5, 6, None, True, ts(2, 1), YDAY),
        (3, 1, 1, 5, 6, None, True, ts(2, 1), YDAY), (4, 1, 1, 1, 6, None, False, None, YDAY),
        (3, 1, 1, 5, 6, None, True, ts(2, 1), MONTH_END), (4, 1, 1, 5, 6, None, None, None, MONTH_END)]
    users = frame("account_id bigint, org_id bigint, user_id bigint, org_user_type bigint, ds string",
                  (50, 500, 5, 1, DS), (60, 600, 6, 2, DS), (70, 700, 77, 1, YDAY))
    catalog = Catalog(spark, {"render": frame(schema, *rows), "org_user": users})
    cols = ["pic_id", "camera_type_id", "camera_type_name", "account_id", "`1d_is_created`", "`1d_is_deleted`",
            "`1m_is_created`", "`1m_is_deleted`", "deleted"]
    expected = [
        (1, 1, "普通图", 50, True, False, True, False, False),
        (2, -1, "其它", 60, False, True, True, True, True),
        (3, 9, "其它", 50, False, False, False, False, True),
        (4, 2, "全景图", 50, False, False, False, True, True),
        (5, 3, "俯视图", 50, False, False, False, False, False)]
    assert got(render_flags(catalog, RUN), *cols) == expected
    assert got(render_flags(catalog, RUN, max_bytes=0), *cols) == expected
    literal = render_flags(catalog, RUN, dedup=False)
    assert got(literal, *cols) == sorted([*expected, expected[2]])  # two copies yesterday


# Order materials


@pytest.fixture
def order_tables(spark, frame):
    """Design 1 has two submissions at the first moment; order 10 repeats an audit number."""
    cnt = "b4110_1_design_brandgood_relation_cnt bigint"
    week = RUN.days_before(7)
    return Catalog(spark, {
        "order_design": frame(
            "design_id bigint, order_id bigint, created timestamp, deleted boolean, ds string",
            (1, 10, ts(1, 2), False, DS), (1, 11, ts(1, 2), False, DS), (1, 12, ts(1, 3), False, DS),
            (1, 13, ts(1, 1), True, DS), (1, 13, ts(1, 1), None, DS),
            (2, 20, ts(1, 5), False, DS), (3, 30, None, False, DS), (3, 31, ts(1, 1), False, DS),
            (4, 40, ts(1, 1), False, DS), (5, 50, ts(1, 1), False, DS), (6, 60, ts(1, 1), False, DS),
            (7, 70, ts(1, 1), False, DS)),
        "order_info": frame(
            "order_id bigint, org_id bigint, status int, state int, template_id int, last_modified timestamp, "
            "order_readable_id string, ds string",
            *[(o, 1, 0, state, 2, ts(2, 1), f"o{o}", DS) for o, state in [
                (10, 27), (11, 28), (12, 29), (20, 33), (30, 31), (31, 32), (40, 32), (50, 30), (60, None), (70, 29)]]),
        "order_item": frame(
            "order_id bigint, item_key string, value string, ds string",
            (10, "auditRelationId", "A", DS), (10, "auditRelationId", "A", DS), (10, "auditRelationId", "B", DS),
            (11, "other", "X", DS), (20, "auditRelationId", None, DS), (None, "auditRelationId", "N", DS)),
        "bridge": frame(
            f"design_id bigint, brandgood_id bigint, dhd_type string, {cnt}, ds string",
            (1, 100, "furniture", 3, DS), (1, 101, None, None, DS), (2, None, "material", 1, DS),
            (2, 102, "molding", 5, YDAY), (2, 102, "molding", 6, week), (1, 103, "furniture", 9, YDAY),
            (3, 0, "furniture", 2, week), (4, 104, "furniture", 2, RUN.days_before(8)), (None, 105, "furniture", 1, DS)),
        "order_design_detail": frame(
            "design_id bigint, brandgood_id bigint, dhd_type string, ds string",
            (1, 106, "detail", DS), (4, 107, "detail", DS), (4, None, "detail", DS), (7, 108, "detail", YDAY)),
        "material": frame(
            "brandgood_id bigint, brandgood_name string, ds string",
            (100, "hundred", DS), (100, "old hundred", YDAY), (102, "one", YDAY), (102, "two", week),
            (107, "seven", RUN.days_before(8)), (None, "none", DS)),
    })


SHORT = ["design_id", "order_readable_id", "value"]
ITEM = ["design_id", "brandgood_id", "dhd_type", "b4110_1_design_brandgood_relation_cnt", "brandgood_name"]


def test_core_with_ties_is_distinct(order_tables):
    assert got(order_core(order_tables, RUN, ties=True, distinct=True), *SHORT) == [
        (1, "o10", "A"), (1, "o10", "B"), (1, "o11", None), (2, "o20", None), (3, "o30", None), (4, "o40", None),
        (7, "o70", None)]


def test_core_of_single_rows_keeps_copies(order_tables):
    core = order_core(order_tables, RUN)
    assert got(core, *SHORT) == [
        (1, "o10", "A"), (1, "o10", "A"), (1, "o10", "B"), (2, "o20", None), (3, "o30", None), (4, "o40", None),
        (7, "o70", None)]
    assert dict(got(core, "design_id", "review_status")) == {
        1: "待审核", 2: None, 3: "已驳回", 4: "已退回", 7: "已通过"}


def test_order_material_detail(order_tables):
    out = order_material_detail(order_tables, RUN)
    assert out.columns == ORDER_MATERIAL.schema.names
    assert got(out.where("design_id > 1"), *ITEM) == [
        (2, None, "material", 1, None), (3, None, None, None, None), (4, None, None, None, None),
        (7, None, None, None, None)]
    assert got(out.where("design_id = 1 AND value = 'B'"), *ITEM) == [
        (1, 100, "furniture", 3, "hundred"), (1, 101, None, None, None)]
    assert out.where("design_id = 1").count() == 6


def test_hot_keys_do_not_change_the_order_jobs(order_tables, monkeypatch):
    jobs = [order_material_detail, order_material_onepass, order_material_fallback, order_material_three_level]
    plain = [got(job(order_tables, RUN)) for job in jobs]

    def every_key(relations):
        return [sorted({tuple(r) for r in df.select(*keys).dropna().collect()}) for df, keys in relations]

    monkeypatch.setattr("dayledger.plans.order_material.hot_keys_each", every_key)
    monkeypatch.setattr("dayledger.operators.joins.hot_keys_each", every_key)
    monkeypatch.setattr(om, "stage", lambda df, name: df)  # the whole plan in one
    spread = [job(order_tables, RUN) for job in jobs]
    assert all("_left_slot" in plan(df) and "_right_slot" in plan(df) for df in spread)
    assert [got(df) for df in spread] == plain


def test_order_material_onepass(order_tables):
    out = order_material_onepass(order_tables, RUN)
    assert out.columns == ORDER_MATERIAL.schema.names
    assert got(out.where("design_id > 1"), *ITEM) == [
        (d, None, None, None, None) for d in (2, 3, 4, 7)]  # a relation without a material counts as none
    assert out.where("design_id = 1").count() == 6


@pytest.mark.parametrize("max_bytes", [0, 10**6])
def test_order_material_fallback(order_tables, max_bytes):
    out = order_material_fallback(order_tables, RUN, max_bytes=max_bytes)
    assert out.columns == ORDER_MATERIAL.schema.names
    assert got(out.where("design_id > 1"), *ITEM) == [
        # two days of history, two names in history each
        (2, 102, "molding", 5, "one"), (2, 102, "molding", 5, "two"), (2, 102, "molding", 6, "one"),
        (2, 102, "molding", 6, "two"), (3, 0, "furniture", 2, None), (4, None, None, None, None),
        (7, None, None, None, None)]
    assert {r[1:] for r in got(out.where("design_id = 1"), *ITEM)} == {
        (100, "furniture", 3, "hundred"), (101, None, None, None)}


def test_order_material_fallback_to_the_latest_day(order_tables):
    out = order_material_fallback(order_tables, RUN, latest_only=True)
    assert got(out.where("design_id = 2"), *ITEM) == [(2, 102, "molding", 5, "one")]


def test_order_material_three_level(order_tables):
    out = order_material_three_level(order_tables, RUN)
    assert got(out.where("design_id > 1"), *ITEM) == [
        # the count is the day's own or 1, even where history has one
        *[(2, 102, "molding", 1, name) for name in ("one", "one", "two", "two")],
        (3, 0, "furniture", 1, "未知商品"), (4, 107, "detail", 1, None), (7, None, None, 1, None)]
    assert {r[1:] for r in got(out.where("design_id = 1"), *ITEM)} == {
        (100, "furniture", 3, "hundred"), (101, None, 1, None)}


def test_order_material_without_a_source(order_tables):
    assert {r[1:] for r in got(order_material_defaults(order_tables, RUN), *ITEM)} == {(0, "unknown", 1, "默认商品")}
    nulls = order_material_nulls(order_tables, RUN)
    assert {r[1:] for r in got(nulls, *ITEM)} == {(None, None, None, None)}
    assert [f.dataType for f in nulls.schema] == [f.dataType for f in ORDER_MATERIAL.schema]


def test_order_material_detail_source(order_tables):
    out = order_material_detail_source(order_tables, RUN)
    assert out.columns == ORDER_MATERIAL.schema.names
    assert got(out.where("design_id > 1"), *ITEM) == [
        (2, None, None, 1, None), (3, None, None, 1, None), (4, 107, "detail", 1, None), (7, None, None, 1, None)]


def test_order_material_staged(order_tables):
    core = stage(order_core(order_tables, RUN), "core")
    out = order_material_staged(order_tables, RUN, core)
    assert got(out.where("design_id <> 2")) == got(order_material_onepass(order_tables, RUN).where("design_id <> 2"))
    assert got(out.where("design_id = 2"), *ITEM) == [(2, None, "material", 1, None)]
    without = order_material_staged(order_tables, RUN, core, materials=False)
    assert got(without) == got(order_material_nulls(order_tables, RUN))


def test_detail_and_onepass_agree_on_unique_rows(order_tables):
    only = lambda role, cond: (role, order_tables.table(role).where(cond))
    unique = Catalog(order_tables.spark, {**order_tables.tables, **dict([
        only("order_design", "order_id NOT IN (11, 12)"),
        only("bridge", "brandgood_id IS NOT NULL"),
    ]), "order_item": order_tables.table("order_item").distinct()})
    assert got(order_material_detail(unique, RUN)) == got(order_material_onepass(unique, RUN))


# Reward log


def test_reward_merge(spark, frame):
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REWARD_LOG.schema)

    def row(id, turn, at, deleted=False, ds=DS):
        return (id, 1, 1, 0, 1, turn, None, deleted, ts(1, 1), at, "snap", None, ds)

    catalog = Catalog(spark, {
        "reward_snapshot": frame(f"{cols}, ds string", row(1, 0, ts(1, 1), ds=YDAY), row(2, 0, ts(1, 1), ds=YDAY),
                                 row(9, 0, ts(1, 1), ds=MONTH_END)),
        "reward_increment": frame(f"{cols}, ds string", row(1, 1, ts(3, 1)), row(1, 2, ts(3, 1)), row(1, 3, None),
                                  row(3, 1, ts(3, 1), deleted=True), row(2, 5, ts(3, 1), ds=YDAY)),
    })
    out = reward_merge(catalog, RUN)
    assert out.columns == REWARD_LOG.schema.names
    assert got(out, "id", "turn", "deleted") == [(1, 2, False), (2, 0, False), (3, 1, True)]


# Relation tags


@pytest.fixture
def tag_tables(spark, frame):
    bridge = [(1, 100, "furniture"), (1, 101, "customized"), (1, 102, "customized"), (1, 103, "decoration"),
              (1, 104, "decoration"), (1, 100, None), (2, 100, "furniture"), (8, 100, "furniture"), (1, 199, "furniture")]
    return Catalog(spark, {
        "bridge": frame("design_id bigint, brandgood_id bigint, dhd_type string, ds string",
                        *[(*b, DS) for b in bridge], (*bridge[0], YDAY), (*bridge[1], YDAY), (*bridge[1], YDAY),
                        (*bridge[1], MONTH_END), (1, 100, None, YDAY)),
        "material": frame(
            "brandgood_id bigint, item_type bigint, transprod_cat_id bigint, prodcat1_id bigint, prodcat1_name string, "
            "prodcat2_id bigint, prodcat2_name string, prodcat3_id bigint, prodcat3_name string, ds string",
            (100, 3, 7, None, None, 2, "two", None, "three", DS), (101, 8, 7, 1, "one", None, None, None, None, DS),
            (102, 1, 7, 1, "one", None, None, None, None, DS), (103, 3, 7, 1, "one", None, None, None, None, DS),
            (104, 3, 99, 1, "one", None, None, None, None, DS), (199, 3, 7, 1, "x", None, None, None, None, YDAY)),
        "design": frame(
            "design_id bigint, user_id bigint, deleted boolean, fpspec_devide_1 string, area_devide_1 string, ds string",
            (1, 5, False, "f", "a", DS), (2, 6, True, "f", "a", DS)),
        "org_user": frame("account_id bigint, org_id bigint, user_id bigint, org_user_type bigint, ds string",
                          (50, 500, 5, 1, DS), (60, 600, 6, 2, DS)),
        "user": frame("user_id bigint, province bigint, province_name string, city bigint, city_name string, ds string",
                      (5, None, None, 3, "c", DS), (6, 2, "p", None, None, DS)),
        "deco_category": frame("cat1_id string, cat1_name string, cat2_id string, cat2_name string, ds string",
                               ("1", "walls", "7", "paint", DS), ("8", "floors", None, None, DS)),
        "usable_material": frame(
            "org_id bigint, brandgood_id bigint, authorization_method int, src_org_id bigint, ds string",
            (500, 100, 0, 500, DS), (500, 101, 2, 900, DS), (500, 102, None, 901, DS)),
    })


def test_relation_tags(tag_tables):
    out = relation_tags(tag_tables, RUN)
    assert got(out, "design_id", "brandgood_id", "itemset_type", "`1d_is_created`", "`1m_is_created`",
               "usable_bg_source", "deco_cat1_name", "deco_cat2_id") == [
        (1, 100, 0, True, True, "自建", None, None),  # a NULL type is never found in a snapshot
        (1, 100, 1, False, True, "自建", None, None),
        (1, 101, 2, False, False, "授权", None, None),
        (1, 102, 0, True, True, "公库", None, None),
        (1, 103, 3, True, True, None, "walls", 7),
        (1, 104, 0, True, True, None, None, None),
        (2, 100, 1, True, True, None, None, None)]
    assert got(out.where("brandgood_id = 100 AND itemset_type = 1"), "province", "province_name", "city", "city_name",
               "prodcat1_id", "prodcat1_name", "prodcat3_id", "prodcat3_name", "org_id", "item_type") == [
        (-1, "", 3, "c", -1, "", -1, "three", 500, 3), (2, "p", -1, "", -1, "", -1, "three", 600, 3)]
    assert got(relation_tags(tag_tables, RUN, max_bytes=0)) == got(out)
    literal = relation_tags(tag_tables, RUN, dedup=False)
    assert literal.count() == out.count() + 1  # one relation was there twice yesterday


def test_repeated_dimension_rows_multiply(tag_tables):
    def twice(role):
        table = tag_tables.table(role)
        return Catalog(tag_tables.spark, {**tag_tables.tables, role: table.unionAll(table)})

    paint = "brandgood_id = 103"
    assert relation_tags(twice("material"), RUN).where(paint).count() == 4  # once for each part it plays
    assert relation_tags(twice("deco_category"), RUN).where(paint).count() == 4
    assert relation_tags(twice("usable_material"), RUN).where("brandgood_id = 101").count() == 2


# Running jobs


@pytest.mark.parametrize("name", [n for n in JOBS if n.startswith("order_material")])
def test_run_job_writes_a_day_and_can_be_run_again(order_tables, tmp_path, name):
    spec = JOBS[name].spec
    path = str(tmp_path / name)
    for _ in range(2):
        run_job(name, order_tables, RUN, path=path)
    out = read_path(order_tables.spark, spec, path)
    assert out.columns == [*spec.schema.names, "ds"] and out.count() > 0
    assert got(out, "ds")[0] == (DS,)
    run_job(name, order_tables, RUN, path=path, append=True)
    assert read_path(order_tables.spark, spec, path).count() == 2 * len(got(out))


@pytest.mark.parametrize("name", ["relation_tags", "account_apply_detail", "account_apply_detail_plain"])
def test_run_wide_jobs_into_tables(spark, frame, tag_tables, name):
    tables = tag_tables if name == "relation_tags" else detail_tables(spark, frame)
    job = JOBS[name]
    spec = job.spec.named(f"wide_{name}")
    for _ in range(2):
        run_job(name, tables, RUN, spec=spec)
    made = spark.table(spec.name)
    assert made.columns == [*spec.schema.names, "ds"]
    assert got(made.drop("ds")) == got(job.build(tables, RUN))
    spark.sql(f"DROP TABLE {spec.name}")


def test_run_job_into_a_table(apply_tables, spark):
    spec = JOBS["monthly_apply_count"].spec.named("monthly_made")
    run_job("monthly_apply_count", apply_tables, RUN, spec=spec)
    assert got(spark.table("monthly_made")) == [(10, "a", None, "chair", 1, DS), (10, "a", "b", "chair", 2, DS)]
    spark.sql("DROP TABLE monthly_made")


def test_days_past_the_retention_go_if_wished(apply_tables, spark):
    spec = replace(JOBS["monthly_apply_count"].spec.named("monthly_kept"), retention_days=30)
    ensure_table(spark, spec)
    old = "20200101"
    spark.sql(f"INSERT INTO monthly_kept PARTITION (ds = '{old}') SELECT {', '.join(['NULL'] * len(spec.schema))}")
    run_job("monthly_apply_count", apply_tables, RUN, spec=spec)
    assert old in {r["ds"] for r in spark.table("monthly_kept").collect()}
    run_job("monthly_apply_count", apply_tables, RUN, spec=spec, expire=True)
    assert {r["ds"] for r in spark.table("monthly_kept").collect()} == {DS}
    spark.sql("DROP TABLE monthly_kept")


# Plans


@pytest.mark.parametrize("max_bytes", [0, 10**6])
def test_relations_and_names_are_cut_to_the_designs_and_materials(order_tables, max_bytes, monkeypatch):
    """What is staged after the core is the core's own relations; the names meet the ids found. Names that
    fit are broadcast whole, and nothing is staged for them."""
    plans = []
    monkeypatch.setattr(om, "stage", lambda df, name: plans.append(plan(df)) or df)
    out = plan(om.order_material_detail(order_tables, RUN, max_bytes=max_bytes))
    lines = out.split("== Physical Plan ==")[1].splitlines()
    if max_bytes:
        assert len(plans) == 1
        assert any("BroadcastHashJoin [design_id" in line and "LeftSemi" in line for line in lines)
        assert any("BroadcastHashJoin [brandgood_id" in line and "LeftOuter" in line for line in lines)
    else:
        assert any("SortMergeJoin [design_id" in line and "LeftSemi" in line for line in plans[1].split("== Physical Plan ==")[1].splitlines())
        assert any("SortMergeJoin [brandgood_id" in line and "LeftSemi" in line for line in lines)


def test_the_increment_is_windowed_once(spark, frame):
    snapshot = frame("id int, v string, t int", (1, "a", 1), (2, "b", 1))
    increment = frame("id int, v string, t int", (2, "c", 2), (2, "d", 3), (3, "e", 1))
    out = merge_increment(snapshot, increment, ["id"], ["t"], ["v"], max_bytes=0)
    assert plan(out).split("== Physical Plan ==")[1].count("Window [row_number") == 1
    assert got(out) == [(1, "a", 1), (2, "d", 3), (3, "e", 1)]


def test_relations_of_listed_accounts_are_cut_before_they_are_shuffled(spark, frame):
    physical = plan(account_apply_detail(detail_tables(spark, frame), RUN)).split("== Physical Plan ==")[1]
    assert physical.count("BroadcastHashJoin [brandgood_id") + physical.count("BroadcastHashJoin [design_id") >= 2
    assert "LeftSemi" in physical and "CartesianProduct" not in physical and "NestedLoop" not in physical


def test_no_job_has_a_cross_join(order_tables, tag_tables, apply_tables):
    for job, tables in [(order_material_three_level, order_tables), (order_material_detail, order_tables),
                        (relation_tags, tag_tables), (monthly_apply_count, apply_tables)]:
        text = plan(job(tables, RUN))
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
