"""Materials of submitted designs, in the variants that differ in where materials come from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions import eq, fill_defaults, fill_missing, label, not_in_list
from dayledger.operators import (
    BROADCAST_LIMIT,
    dedup,
    fallback_join,
    first_per_key,
    fits,
    hot_keys_each,
    merged_hot,
    sketch_days,
    spread_join,
)
from dayledger.plans.schemas import ORDER_MATERIAL
from dayledger.rundate import RunDate
from dayledger.sinks.staging import stage
from dayledger.sources import Catalog, constant_row, snapshot, trailing_days

# Review labels, order filter, audit item, fallback constants.
REVIEW_STATUS = {27: "待审核", 28: "审核中", 29: "已通过", 30: "已撤回", 31: "已驳回", 32: "已退回"}
LIVE_STATUS = 0
LEFT_OUT_STATES = (1, 30)
TEMPLATE = 2
AUDIT_ITEM = "auditRelationId"
HISTORY_DAYS = 7
UNKNOWN_MATERIAL = {"brandgood_id": 0, "brandgood_name": "未知商品"}
DEFAULT_MATERIAL = {
    "brandgood_id": 0,
    "dhd_type": "unknown",
    "b4110_1_design_brandgood_relation_cnt": 1,
    "brandgood_name": "默认商品",
}

CNT = "b4110_1_design_brandgood_relation_cnt"
CORE = ["org_id", "order_readable_id", "design_id", "value", "created", "review_status",
        "last_modified"]
MATERIAL = ["brandgood_id", "dhd_type", CNT]
OUTPUT = ORDER_MATERIAL.schema.names


@dataclass(frozen=True)
class Keyed:
    """A relation that is shuffled by keys that may be hot, the name of what it is, and its days."""

    rows: DataFrame
    keys: list[str]
    relation: str
    days: tuple[str, ...]


@dataclass(frozen=True)
class Source:
    """Rows that materials or names come from, what they are, and their days."""

    rows: DataFrame
    relation: str
    days: tuple[str, ...]

    def by(self, key: str) -> Keyed:
        return Keyed(self.rows, [key], self.relation, self.days)

    def without(self, col: str) -> Source:
        return replace(self, rows=self.rows.withColumn(col, F.lit(None).cast(self.rows.schema[col].dataType)))


def _hot(catalog: Catalog, keyed: Sequence[Keyed]) -> list[list[tuple]]:
    """The hot keys of each relation, told from the catalog's sketches where all its days have one."""
    relations = [(k.rows, k.keys) for k in keyed]
    stored = [catalog.sketch(k.relation, k.keys, k.days) for k in keyed]
    if all(kept is None for kept in stored):
        return hot_keys_each(relations)
    return hot_keys_each(relations, stored=stored)


def order_material_sketches(catalog: Catalog, run: RunDate, before: int = 0) -> DataFrame:
    """The run day's key sketches of all relations of these jobs, to be kept and given to later runs'
    `Catalog`: relations of seven days are then told from the sketches of their days. `before` adds the
    sketches of so many days before, for the first run."""
    sources = [_relation(catalog, run), _relation(catalog, run, keyed=True), _names(catalog, run)]
    if before:
        sources += [_relation(catalog, run, before, keyed=True), _names(catalog, run, before)]
    if catalog.has("order_design_detail"):
        sources.append(Source(_keyed(_design_detail(catalog, run)), "order_design_detail, keyed", (run.ds,)))
    keyed = [*_core_keys(catalog, run), *(x.by("brandgood_id") for x in sources)]
    keyed += [x.by("design_id") for x in sources if "design_id" in x.rows.columns]
    return reduce(DataFrame.unionByName, [
        sketch_days(k.rows if "ds" in k.rows.columns else k.rows.withColumn("ds", F.lit(run.ds)), k.relation, k.keys, k.days)
        for k in keyed
    ])


def order_core(
    catalog: Catalog,
    run: RunDate,
    ties: bool = False,
    distinct: bool = False,
    found: Sequence[Sequence[tuple]] | None = None,
) -> DataFrame:
    """First submission of each design, with its live order and audit numbers.

    With `ties` all submissions at the first moment count, else the one with the lowest order id.
    `distinct` drops repeated rows; without it every audit number of an order gives a row. `found` has
    the hot keys of `_core_keys` where they are known.
    """
    keyed = _core_keys(catalog, run)
    submissions, audits = keyed[0].rows, keyed[2].rows
    hot_designs, hot_orders, hot_audits = _hot(catalog, keyed) if found is None else found
    if ties:
        first = first_per_key(submissions, ["design_id"], ["created"], ties=True, hot=hot_designs)
    else:
        first = first_per_key(submissions, ["design_id"], ["created"], tiebreak=["order_id"])
    orders = (
        snapshot(catalog.table("order_info"), run.ds)
        .where(eq("status", LIVE_STATUS))
        .where(not_in_list("state", LEFT_OUT_STATES))
        .where(eq("template_id", TEMPLATE))
        .select("order_id", "org_id", "order_readable_id", "last_modified",
                label("state", REVIEW_STATUS).alias("review_status"))
    )
    if distinct:  # the result is distinct, so its parts may be, and copies never meet the join
        audits = dedup(audits)
    live = spread_join(first, orders, ["order_id"], hot_left=hot_orders)
    core = spread_join(live, audits, ["order_id"], "left", hot_left=hot_orders, hot_right=hot_audits)
    return dedup(core.select(*CORE)) if distinct else core.select(*CORE)


def _core_keys(catalog: Catalog, run: RunDate) -> list[Keyed]:
    """The relations of the core that are shuffled by a key that may be hot, with the key."""
    submissions = snapshot(catalog.table("order_design"), run.ds).where(
        eq("deleted", False)).select("design_id", "order_id", "created")
    audits = snapshot(catalog.table("order_item"), run.ds).where(
        eq("item_key", AUDIT_ITEM)).select("order_id", "value")
    day = (run.ds,)
    return [
        Keyed(submissions, ["design_id"], "order_design, live", day),
        Keyed(submissions, ["order_id"], "order_design, live", day),
        Keyed(audits, ["order_id"], "order_item, audits", day),
    ]


def _with_core(
    catalog: Catalog, run: RunDate, core: DataFrame | None, others: list[Keyed], **kwargs: bool
) -> tuple[DataFrame, list[list[tuple]]]:
    """The staged core, `core` if it was given, and the hot keys of `others`. One job looks for the hot
    keys of all relations."""
    if core is not None:
        return core, _hot(catalog, others)
    own = _core_keys(catalog, run)
    hot = _hot(catalog, [*own, *others])
    return stage(order_core(catalog, run, found=hot[: len(own)], **kwargs), "core"), hot[len(own):]


def order_material_detail(
    catalog: Catalog, run: RunDate, core: DataFrame | None = None, max_bytes: int = BROADCAST_LIMIT
) -> DataFrame:
    """Tied first submissions, distinct core rows, all materials of the day."""
    return _with_materials(catalog, run, core, _relation(catalog, run), max_bytes, ties=True, distinct=True)


def order_material_onepass(
    catalog: Catalog, run: RunDate, core: DataFrame | None = None, max_bytes: int = BROADCAST_LIMIT
) -> DataFrame:
    """One first submission per design, core rows as they come, materials with both keys set."""
    return _with_materials(catalog, run, core, _relation(catalog, run, keyed=True), max_bytes)


def order_material_fallback(
    catalog: Catalog,
    run: RunDate,
    core: DataFrame | None = None,
    latest_only: bool = False,
    max_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Materials and names of the day, else of the seven days before.

    History may hold a key on several days, and each gives a row unless `latest_only`. The core is
    staged unless a staged one is given.
    """
    sources = [_relation(catalog, run, days, keyed=True) for days in (0, HISTORY_DAYS)]
    names = [_names(catalog, run, days) for days in (0, HISTORY_DAYS)]
    return _fallback(catalog, run, core, sources, names, latest_only=latest_only, max_bytes=max_bytes)


def order_material_three_level(
    catalog: Catalog, run: RunDate, core: DataFrame | None = None, max_bytes: int = BROADCAST_LIMIT
) -> DataFrame:
    """Materials of the day, else of the seven days before, else of the designs' own detail table;
    names likewise, and at last a constant for material 0. The count is the day's own or 1."""
    today, history = (_relation(catalog, run, days, keyed=True) for days in (0, HISTORY_DAYS))
    detail = _keyed(_design_detail(catalog, run)).withColumn(CNT, F.lit(None).cast("bigint"))
    sources = [today, history.without(CNT), Source(detail, "order_design_detail, keyed", (run.ds,))]
    names = [
        *[_names(catalog, run, days) for days in (0, HISTORY_DAYS)],
        Source(constant_row(catalog.spark, **UNKNOWN_MATERIAL), "one constant row", ()),
    ]
    out = _fallback(catalog, run, core, sources, names, max_bytes=max_bytes)
    return out.withColumn(CNT, F.coalesce(CNT, F.lit(1)))


def order_material_defaults(catalog: Catalog, run: RunDate) -> DataFrame:
    """Constants in place of materials."""
    return fill_defaults(order_core(catalog, run), DEFAULT_MATERIAL, ORDER_MATERIAL.schema)


def order_material_nulls(catalog: Catalog, run: RunDate) -> DataFrame:
    """NULLs in place of materials."""
    return fill_missing(order_core(catalog, run), ORDER_MATERIAL.schema)


def order_material_detail_source(catalog: Catalog, run: RunDate) -> DataFrame:
    """Materials from the designs' own detail table, each counted once."""
    detail = _design_detail(catalog, run).where(F.col("brandgood_id").isNotNull())
    out = _with_materials(catalog, run, None, Source(detail, "order_design_detail, with a material", (run.ds,)))
    return fill_defaults(out, {CNT: 1}, ORDER_MATERIAL.schema).select(*OUTPUT)


def order_material_staged(
    catalog: Catalog, run: RunDate, core: DataFrame, materials: bool = True
) -> DataFrame:
    """From a core that was staged: the day's materials of its designs, or NULLs without them."""
    if not materials:
        return fill_missing(core, ORDER_MATERIAL.schema)
    return _with_materials(catalog, run, core, _relation(catalog, run))


def _relation(catalog: Catalog, run: RunDate, history: int = 0, keyed: bool = False) -> Source:
    """The day's relations, or those of the `history` days before it; `keyed` with both keys set."""
    rows = _days(catalog.table("bridge"), run, history).select("design_id", *MATERIAL, "ds")
    return Source(_keyed(rows) if keyed else rows, "bridge, keyed" if keyed else "bridge", _named(run, history))


def _names(catalog: Catalog, run: RunDate, history: int = 0) -> Source:
    rows = _days(catalog.table("material"), run, history).where(
        F.col("brandgood_id").isNotNull()).select("brandgood_id", "brandgood_name", "ds")
    return Source(rows, "material, with a key", _named(run, history))


def _named(run: RunDate, history: int) -> tuple[str, ...]:
    return tuple(run.days_before(n) for n in range(history, 0, -1)) if history else (run.ds,)


def _design_detail(catalog: Catalog, run: RunDate) -> DataFrame:
    return snapshot(catalog.table("order_design_detail"), run.ds).select(
        "design_id", "brandgood_id", "dhd_type", "ds")


def _days(df: DataFrame, run: RunDate, history: int) -> DataFrame:
    return trailing_days(df, run, history) if history else snapshot(df, run.ds)


def _keyed(relation: DataFrame) -> DataFrame:
    return relation.dropna(subset=["design_id", "brandgood_id"])


def _cut(relation: DataFrame, staged: DataFrame, key: str, max_bytes: int) -> DataFrame:
    """The relation's rows whose key a staged result has. Keys that are measured to fit are broadcast,
    so that only those rows are shuffled later; else the relation meets the keys alone, its rows
    narrow and cut before they meet anything wider."""
    ids = staged.select(key).dropna().distinct()
    return relation.join(F.broadcast(ids) if fits(ids, max_bytes) else ids, key, "left_semi")


def _with_materials(
    catalog: Catalog,
    run: RunDate,
    core: DataFrame | None,
    relation: Source,
    max_bytes: int = BROADCAST_LIMIT,
    **kwargs: bool,
) -> DataFrame:
    """Add materials and their names to the core, staged unless one is given. The relations are cut to
    its designs before they are shuffled. Names that are measured to fit are broadcast; else they are cut
    to the materials found, and rows without a material and of popular ones, both many, are spread."""
    source = _names(catalog, run)
    names = source.rows.drop("ds")
    small = fits(names, max_bytes)
    others = [relation.by("design_id")]
    if not small:
        others += [relation.by("brandgood_id"), source.by("brandgood_id")]
    core, (hot_designs, *hot) = _with_core(catalog, run, core, others, **kwargs)
    cut = _cut(relation.rows.drop("ds"), core, "design_id", max_bytes)
    out = spread_join(core, cut, ["design_id"], "left", hot_right=hot_designs)
    if small:
        named = out.join(F.broadcast(names), "brandgood_id", "left")
    else:
        out = stage(out, "materials")
        named = spread_join(out, _cut(names, out, "brandgood_id", max_bytes), ["brandgood_id"],
                            "left", hot_left=hot[0], hot_right=hot[1], spread_nulls=True)
    return named.select(*[c for c in OUTPUT if c in named.columns])


def _fallback(
    catalog: Catalog,
    run: RunDate,
    core: DataFrame | None,
    relations: Sequence[Source],
    names: Sequence[Source],
    latest_only: bool = False,
    max_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Materials from the first relation that has any, names likewise. Each relation is cut to the
    designs asked of it, and so are names that do not fit a broadcast."""
    name_rows = [x.rows for x in names]
    small = fits(reduce(DataFrame.unionByName, [x.select("brandgood_id", "brandgood_name") for x in name_rows]), max_bytes)
    others = [x.by("design_id") for x in relations]
    if not small:
        others += [x.by("brandgood_id") for x in [*relations, *names] if x.days]  # a constant has no hot key
    core, hot = _with_core(catalog, run, core, others)
    n = len(relations)
    out = fallback_join(core, [x.rows for x in relations], ["design_id"], MATERIAL, latest_only=latest_only, prefilter=True,
                        hot_sources=merged_hot(hot[:n]), max_bytes=max_bytes)
    if small:
        return fallback_join(out, name_rows, ["brandgood_id"], ["brandgood_name"], latest_only=latest_only, broadcast=True).select(*OUTPUT)
    return fallback_join(
        stage(out, "materials"), name_rows, ["brandgood_id"], ["brandgood_name"], latest_only=latest_only, prefilter=True,
        hot=merged_hot(hot[n : 2 * n]), hot_sources=merged_hot(hot[2 * n :]), spread_nulls=True, max_bytes=max_bytes,
    ).select(*OUTPUT)
