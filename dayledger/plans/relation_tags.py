"""Design and material relations, tagged with user region, categories, usage source and age."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import child_or_parent, eq, first_rule, in_list, label, to_bigint
from dayledger.operators import (
    BROADCAST_LIMIT,
    fits,
    hot_keys,
    left_join,
    snapshot_diff,
    spread_join,
)
from dayledger.plans.schemas import RELATION_TAGS
from dayledger.rundate import RunDate
from dayledger.sources import Catalog, snapshot

# Item types that count as customized, and the usage labels by grant method.
CUSTOMIZED_ITEM_TYPES = (3, 8, 9, 14, 15, 19, 24)
USAGE = {0: "自建", (1, 2, 3): "授权"}
OTHER_USAGE = "公库"


def relation_tags(
    catalog: Catalog, run: RunDate, dedup: bool = True, max_bytes: int = BROADCAST_LIMIT
) -> DataFrame:
    """One row per relation of the day whose design has an organisation user and whose material
    is known.

    The relations are shuffled four times: by their whole key for the age flags, by design, by
    organisation and material, by material. The wide material columns come last, so only the last
    shuffle's result carries them. `dedup` is that of `snapshot_diff`.
    """
    key = ["design_id", "brandgood_id", "dhd_type"]
    relations = snapshot_diff(
        catalog.table("bridge").select(*key, "ds"), key, run, dedup=dedup).drop("ds")
    deco = _decoration(catalog, run)
    small, hot = fits(deco, max_bytes), []
    if small:
        deco = F.broadcast(deco)
    else:  # a few categories hold most materials: they are spread, and so are materials without one
        hot = hot_keys(snapshot(catalog.table("material"), run.ds), ["transprod_cat_id"])
    with_design = relations.join(_designs(catalog, run), "design_id")
    with_usage = left_join(with_design, _usage(catalog, run), ["org_id", "brandgood_id"])
    with_material = with_usage.join(_materials(catalog, run, deco, hot, not small), "brandgood_id")
    tagged = spread_join(
        with_material, deco, ["transprod_cat_id"], "left", when=eq("dhd_type", "decoration"),
        hot_left=hot, spread_nulls=not small)
    itemset = first_rule([
        (eq("dhd_type", "furniture"), 1),
        (eq("dhd_type", "customized") & in_list("item_type", CUSTOMIZED_ITEM_TYPES), 2),
        (eq("dhd_type", "decoration") & F.col("has_decoration"), 3),
    ], 0)
    return tagged.select(
        *[F.col(f"`{name}`") if name != "itemset_type" else itemset.cast("bigint").alias(name)
          for name in _output_names()],
    ).withColumnRenamed("shown_item_type", "item_type")


def _output_names() -> list[str]:
    return ["shown_item_type" if n == "item_type" else n for n in RELATION_TAGS.schema.names]


def _decoration(catalog: Catalog, run: RunDate) -> DataFrame:
    """Decoration categories by their own id, or their parent's where they have none."""
    return snapshot(catalog.table("deco_category"), run.ds).select(
        to_bigint(child_or_parent("cat2_id", "cat1_id")).alias("deco_cat2_id"),
        to_bigint("cat1_id").alias("deco_cat1_id"),
        F.col("cat1_name").alias("deco_cat1_name"),
        child_or_parent("cat2_name", "cat1_name").alias("deco_cat2_name"),
    ).withColumn("transprod_cat_id", F.col("deco_cat2_id"))


def _designs(catalog: Catalog, run: RunDate) -> DataFrame:
    designs = snapshot(catalog.table("design"), run.ds).select(
        "design_id", "user_id", "deleted", "fpspec_devide_1", "area_devide_1")
    org_users = snapshot(catalog.table("org_user"), run.ds).select(
        "user_id", "account_id", "org_id", "org_user_type")
    users = snapshot(catalog.table("user"), run.ds).select(
        "user_id",
        F.coalesce("province", F.lit(-1)).alias("province"),
        F.coalesce("province_name", F.lit("")).alias("province_name"),
        F.coalesce("city", F.lit(-1)).alias("city"),
        F.coalesce("city_name", F.lit("")).alias("city_name"),
    )
    return designs.join(org_users.join(users, "user_id"), "user_id")


def _materials(
    catalog: Catalog, run: RunDate, deco: DataFrame, hot: Sequence[tuple], spread_nulls: bool
) -> DataFrame:
    """A material plays two parts, its type for the item set and its categories for display, each
    joined to the relations. The parts are paired here, on the far smaller side, so that the
    relations are shuffled once for both; a material repeated k times still gives k * k rows."""
    materials = snapshot(catalog.table("material"), run.ds)
    typed = spread_join(
        materials.select("brandgood_id", "item_type", "transprod_cat_id"),
        deco.select("transprod_cat_id", F.lit(True).alias("has_decoration")),
        ["transprod_cat_id"], "left", hot_left=hot, spread_nulls=spread_nulls)
    shown = materials.select(
        "brandgood_id",
        F.col("item_type").alias("shown_item_type"),
        *[F.coalesce(f"prodcat{n}_id", F.lit(-1)).alias(f"prodcat{n}_id") for n in (1, 2, 3)],
        *[F.coalesce(f"prodcat{n}_name", F.lit("")).alias(f"prodcat{n}_name") for n in (1, 2, 3)],
    )
    return typed.join(shown, "brandgood_id")


def _usage(catalog: Catalog, run: RunDate) -> DataFrame:
    return snapshot(catalog.table("usable_material"), run.ds).select(
        "org_id",
        "brandgood_id",
        label("authorization_method", USAGE, OTHER_USAGE).alias("usable_bg_source"),
        "src_org_id",
    )
