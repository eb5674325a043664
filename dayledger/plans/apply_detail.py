"""Materials of listed root accounts, with every design of the same account that uses them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import eq, in_list
from dayledger.operators import (
    BROADCAST_LIMIT,
    dedup,
    fits,
    hot_keys_each,
    lookup,
    spread_join,
)
from dayledger.plans.schemas import ACCOUNT_MATERIAL_COLUMNS, APPLY_DETAIL
from dayledger.rundate import RunDate
from dayledger.sources import Catalog, snapshot

# The root accounts reported.
ROOT_ACCOUNTS = (106940, 1126425)

MATERIAL = [name for name, *_ in ACCOUNT_MATERIAL_COLUMNS]


def account_apply_detail(
    catalog: Catalog,
    run: RunDate,
    accounts: Sequence[int] = ROOT_ACCOUNTS,
    max_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Cuts the relations to listed materials and designs before anything else.

    Ids that are measured to fit are broadcast, so the relations are cut where they are read and
    only the rest is shuffled. A design row repeated k times gives k * k result rows, since the
    designs are joined once to cut the relations and once for their columns.
    """
    materials = _materials(catalog, run).where(in_list("root_account_id", accounts))
    designs = _designs(catalog, run, accounts)
    material_ids, design_ids = materials.select("brandgood_id"), designs.select("design_id")
    relation = _relation(catalog, run)
    # each side cuts the relations by itself: where they are read if its ids fit, else by a shuffle
    small_materials, small_designs = fits(material_ids, max_bytes), fits(design_ids, max_bytes)
    hot_materials, hot_designs = [], []
    if not (small_materials and small_designs):
        # the joins by design follow each other, so hot keys are spread by hand
        hot_materials, hot_designs = hot_keys_each([
            (relation, ["brandgood_id"]), (relation, ["design_id"])])
    cut = relation
    if small_materials:
        cut = cut.join(F.broadcast(material_ids), "brandgood_id", "left_semi")
    if small_designs:
        design_ids = F.broadcast(design_ids)
        cut = cut.join(design_ids, "design_id", "left_semi")
    if not small_materials:
        cut = spread_join(cut, material_ids, ["brandgood_id"], "left_semi", hot_left=hot_materials)
    if small_designs:
        kept = dedup(cut).join(design_ids, "design_id")
    else:
        cut = spread_join(cut, design_ids, ["design_id"], "left_semi", hot_left=hot_designs)
        kept = spread_join(dedup(cut), design_ids, ["design_id"], hot_left=hot_designs)
    return _detail(catalog, run, kept, materials, designs, max_bytes)


def account_apply_detail_plain(
    catalog: Catalog,
    run: RunDate,
    accounts: Sequence[int] = ROOT_ACCOUNTS,
    max_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """The same rows, given unique design ids, from all relations and materials: the design's
    account alone decides. Relations of other designs give no row, so they are cut before copies are
    removed."""
    designs, relation = _designs(catalog, run, accounts), _relation(catalog, run)
    ids = designs.select("design_id").distinct()
    cut = relation.join(F.broadcast(ids) if fits(ids, max_bytes) else ids, "design_id", "left_semi")
    return _detail(catalog, run, dedup(cut), _materials(catalog, run), designs, max_bytes)


def _materials(catalog: Catalog, run: RunDate) -> DataFrame:
    return snapshot(catalog.table("account_material"), run.ds).select(*MATERIAL)


def _relation(catalog: Catalog, run: RunDate) -> DataFrame:
    return snapshot(catalog.table("bridge"), run.ds).select("design_id", "brandgood_id")


def _designs(catalog: Catalog, run: RunDate, accounts: Sequence[int]) -> DataFrame:
    return (
        snapshot(catalog.table("design"), run.ds)
        .where(eq("deleted", False))
        .where(in_list("root_account_id", accounts))
        .select(
            "design_id",
            "root_account_id",
            F.col("created").alias("design_created"),
            F.col("lastmodified").alias("design_lastmodified"),
            F.col("community_name").alias("design_community_name"),
            "comm_logic_area_id",
            "comm_logic_province_id",
            F.col("user_id").alias("design_user_id"),
            F.col("user_name").alias("design_user_name"),
            F.col("province_name").alias("design_user_province_name"),
            F.col("city_name").alias("design_user_city_name"),
            "fpspec_devide_1",
            "area_devide_1",
        )
    )


def _detail(
    catalog: Catalog,
    run: RunDate,
    relation: DataFrame,
    materials: DataFrame,
    designs: DataFrame,
    max_bytes: int,
) -> DataFrame:
    """Only relations with a design and a material of one root account give a row, so all joins
    but the names are inner joins, and the account is part of the join key."""
    joined = relation.join(designs, "design_id").join(materials, ["brandgood_id", "root_account_id"])
    named = lookup(
        joined, snapshot(catalog.table("area"), run.ds), "area_id", "name",
        {"comm_logic_area_id": "design_community_city_name",
         "comm_logic_province_id": "design_community_province_name"},
        max_bytes,
    )
    return named.withColumn(
        "relation_design_id", F.coalesce("design_id", F.lit(-1))
    ).select(*APPLY_DETAIL.schema.names)
