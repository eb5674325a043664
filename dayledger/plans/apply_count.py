"""Designs per organisation, store and model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import category_filter, eq, not_in_list, same_month
from dayledger.operators import (
    BROADCAST_LIMIT,
    count_distinct_by,
    dedup,
    fits,
    hot_keys,
    semi,
    spread_join,
)
from dayledger.rundate import RunDate
from dayledger.sources import Catalog, increment, month_to_date, snapshot

# Design types left out, and the model categories counted, level by level.
LEFT_OUT_DESIGN_TYPES = ("copy", "blank")
COUNTED_CATEGORIES = (
    (("家具", "照明", "厨卫", "家电"),),
    (("硬装",), ("门",)),
    (("硬装",), ("墙面",), ("背景墙", "壁炉", "护墙板")),
    (("吊顶",), ("电气模块",)),
)
ADDED = 1


def monthly_apply_count(catalog: Catalog, run: RunDate, **options) -> DataFrame:
    """Relations from the increments of the month to date. Options are those of `apply_count`."""
    return apply_count(catalog, run, month_to_date(catalog.table("bridge_increment"), run), **options)


def daily_apply_count(catalog: Catalog, run: RunDate, **options) -> DataFrame:
    """Relations added on the run day alone. Options are those of `apply_count`."""
    relation = increment(catalog.table("bridge_increment"), run.ds, ADDED)
    return apply_count(catalog, run, relation, **options)


def apply_count(
    catalog: Catalog,
    run: RunDate,
    relation: DataFrame,
    *,
    prefilter: bool = True,
    max_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Distinct designs of the run month per organisation, store levels and name of a private,
    listed model whose owner has a live account in the same organisation.

    The month's designs are few beside the relations: measured and, if small, broadcast, so the
    relations are cut to them and freed of copies before their first shuffle. Otherwise a design
    with very many relations is spread by hand: removing copies would rely on the join's
    partitioning, so adaptive execution would not split it. `prefilter` drops
    designs and models without a live account early; the later joins would drop them anyway.
    """
    accounts = (
        snapshot(catalog.table("business_account"), run.ds)
        .where(eq("deleted", False))
        .select(F.col("join_user_id").alias("user_id"), "org_id")
    )
    designs = (
        snapshot(catalog.table("design_basic"), run.ds)
        .where(not_in_list("design_type", LEFT_OUT_DESIGN_TYPES))
        .where(F.col("design_id").isNotNull())
        .where(same_month("design_created", run))
        .select("design_id", "org_id", "level1_node_name", "level2_node_name")
    )
    models = (
        snapshot(catalog.table("material"), run.ds)
        .where(eq("public_type", "private"))
        .where(category_filter(
            ["prodcat1_name", "prodcat2_name", "prodcat3_name"], COUNTED_CATEGORIES))
        .select("brandgood_id", "brandgood_name", "user_id")
    )
    small = fits(designs, max_bytes)
    if prefilter:
        designs = semi(designs, accounts, ["org_id"])
        models = semi(models, accounts, ["user_id"])
    pairs = relation.select("design_id", "brandgood_id")
    if small:
        used = dedup(pairs.join(F.broadcast(designs), "design_id"))
    else:
        hot = hot_keys(pairs, ["design_id"])
        used = dedup(spread_join(pairs, designs, ["design_id"], hot_left=hot))
    counted = used.join(models, "brandgood_id").join(accounts, ["user_id", "org_id"])
    return count_distinct_by(
        counted, ["org_id", "level1_node_name", "level2_node_name", "brandgood_name"],
        "design_id", "bg_apply_dcnt")
