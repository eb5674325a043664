"""Joins whose keys may be hot: one key value can hold a third of all rows.

Adaptive execution splits a skewed side of an inner join and the left side of a left, semi or anti
join by itself, unless the next join relies on the partitioning. It cannot split the right side of a
left join. `spread_join` spreads chosen keys over many tasks on either side, with the same rows as
the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.expressions import flag

HOT_SHARE = 0.001
HOT_ROWS = 100_000
MERGE_GROUPS = 1024


class HotKey(tuple):
    """The values of a hot key, and the share of its relation's keyed rows that it holds."""

    share: float = 1.0

    @classmethod
    def of(cls, values: Sequence[Any], share: float) -> HotKey:
        key = cls(values)
        key.share = share
        return key


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, min_rows: int = HOT_ROWS
) -> list[tuple]:
    """Key values that hold at least `share` of the rows with a key, and at least `min_rows`. At
    most 1 / share values can.

    A frequent-items sketch over the key columns finds candidates without a shuffle of the rows.
    Only if it finds any are they counted exactly, so every value returned is one that occurs.
    """
    return hot_keys_each([(df, keys)], share, min_rows)[0]


def hot_keys_each(
    relations: Sequence[tuple[DataFrame, Sequence[str]]],
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
    stored: Sequence[DataFrame | None] | None = None,
) -> list[list[tuple]]:
    """`hot_keys` of several relations, each with its keys; one job sketches them all, and a
    relation given with several keys is read once for them. The tasks' sketches are merged in
    groups and the groups' then, so that no task merges one of every task.

    A relation that has `stored` sketches (n, sketch; together of all its rows, from `sketch_days` with
    the same `share`) is not read for one. Candidates are counted in the relation in any case."""
    if not relations:
        return []
    most = ceil(1 / share)
    stored = stored or [None] * len(relations)
    digests: dict[int, list[Column]] = {}  # number and digest of each key, by relation
    for i, ((df, keys), kept) in enumerate(zip(relations, stored, strict=True)):
        if kept is None:
            digest = F.when(~has_null(keys), F.xxhash64(*keys))
            digests.setdefault(id(df), []).extend([F.lit(i), digest])
    scanned = {id(df): df for df, _ in relations}
    sketches = [kept.select(F.lit(i).alias("i"), "n", "sketch") for i, kept in enumerate(stored) if kept is not None]
    if digests:
        sketches.append(_sketched(reduce(DataFrame.unionByName, [
            scanned[key].select(F.stack(F.lit(len(cols) // 2), *cols).alias("i", "digest")).dropna()
            for key, cols in digests.items()
        ]), ["i"], share))
    merged = _combined(reduce(DataFrame.unionByName, sketches), ["i"], share)
    sketched = merged.select(
        "i", "n",
        F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(most)).alias("top"))
    hot: list[list[tuple]] = [[] for _ in relations]
    for row in sketched.collect():  # a row per relation
        least = max(min_rows, ceil(row["n"] * share))
        likely = [item["item"] for item in row["top"] if item["count"] >= least]
        if likely:
            df, keys = relations[row["i"]]
            counts = df.select(*keys).dropna().where(F.xxhash64(*keys).isin(likely)).groupBy(
                *keys).agg(F.count(F.lit(1)).alias("_n"))
            found = counts.where(F.col("_n") >= least).collect()
            hot[row["i"]] = sorted(HotKey.of(r[:-1], r[-1] / row["n"]) for r in found)
    return hot


def _sketched(digests: DataFrame, by: Sequence[str], share: float) -> DataFrame:
    """n and sketch of the column `digest` for each group and part: a task's rows, or several tasks'."""
    grouped = digests.withColumn("part", F.spark_partition_id() % MERGE_GROUPS).groupBy(*by, "part").agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function("approx_top_k_accumulate", F.col("digest"), F.lit(8 * ceil(1 / share))).alias("sketch"),
    )
    return grouped.drop("part")


def _combined(sketches: DataFrame, by: Sequence[str], share: float) -> DataFrame:
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(8 * ceil(1 / share))).alias("sketch"),
    )


def sketch_days(
    df: DataFrame, relation: str, keys: Sequence[str], days: Sequence[str], share: float = HOT_SHARE
) -> DataFrame:
    """A row for each day: relation, keys, ds, n, and a sketch of the day's keys (null without rows), to be kept
    with those of other days. `relation` names the table and the filter that `df`, with `ds`, is made by."""
    digest = F.when(~has_null(keys), F.xxhash64(*keys)).alias("digest")
    rows = df.where(F.col("ds").isin(*days)).select("ds", digest).dropna()
    found = _combined(_sketched(rows, ["ds"], share), ["ds"], share)
    listed = df.sparkSession.createDataFrame([(ds,) for ds in days], "ds string").join(found, "ds", "left")
    return listed.select(F.lit(relation).alias("relation"), F.lit(",".join(keys)).alias("keys"), "ds", F.coalesce("n", F.lit(0)).alias("n"), "sketch")


def merged_hot(found: Sequence[Sequence[tuple]]) -> list[tuple]:
    """The hot keys of several relations that are read as one, each once, with its largest share."""
    shares: dict[tuple, float] = {}
    for keys in found:
        for key in keys:
            shares[tuple(key)] = max(shares.get(tuple(key), 0.0), getattr(key, "share", 1.0))
    return [HotKey.of(key, share) for key, share in sorted(shares.items())]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    when: Column | None = None,
    hot_left: Sequence[tuple[Any, ...]] = (),
    hot_right: Sequence[tuple[Any, ...]] = (),
    spread_nulls: bool = False,
    ways: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Equi-join on shared column names (`inner`, `left`, `left_semi`, `left_anti`).

    `when`, a condition on the left row, says whether the row may match at all. Rows of a hot key
    are dealt over slots on their side and the other side's rows of that key are copied to every
    slot. `spread_nulls` deals out the left rows with a NULL key as well, which a left or anti join
    keeps. A key that was hot when it was looked for and is gone when the plan runs does no harm: a
    left row is copied only if the plan itself finds its key on the right.

    A key has slots by its share of the rows, at most `ways` (the session's shuffle partitions,
    unless given). So copies are few beside the result: a copied row meets every row of the hot
    key, of which there are many more.

    Both sides are shuffled into `parts`, if given, which adaptive execution neither merges nor splits.
    """
    keys = list(on)
    if how in ("left_semi", "left_anti"):
        right, hot_right = right.select(*keys).distinct(), ()
    ways = ways or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = {k: f"_right_{k}" for k in keys}
    may_match = F.lit(True) if when is None else flag(when)

    slots = []
    nulls = spread_nulls and how in ("left", "left_anti")
    if hot_left or nulls:
        slots.append("_left_slot")
        over = slot_count(keys, hot_left, ways)
        left = deal(left, "_left_slot", F.when(has_null(keys), ways).otherwise(over) if nulls else over)
        if hot_left:
            right = copy(right, "_left_slot", slot_count(keys, hot_left, ways))
        else:
            right = right.withColumn("_left_slot", first_slot(keys))
    if hot_right:
        slots.append("_right_slot")
        over = slot_count(keys, hot_right, ways)
        if how == "left":  # at most as many rows as there are hot keys
            held = keys[: len(hot_right[0])]
            there = right.where(is_hot(held, hot_right)).select(*held).distinct()
            there = F.broadcast(there.withColumnsRenamed(names).withColumn("_there", F.lit(True)))
            left = left.join(there, reduce(and_, [F.col(k) == F.col(names[k]) for k in held]), "left")
            left = left.drop(*[names[k] for k in held])
            may_match = may_match & F.col("_there").isNotNull()
        right = deal(right, "_right_slot", over)
        left = copy(left, "_right_slot", F.when(may_match, over).otherwise(1))
    names |= {s: f"_right{s}" for s in slots}

    right = right.withColumnsRenamed(names)
    if hot_right and how == "left":
        right = right.withColumn("_hit", F.lit(True))
    if parts is not None:
        right = right.repartition(parts, *names.values())
    cond = reduce(and_, [F.col(a) == F.col(b) for a, b in names.items()])
    out = left.join(right, cond if when is None else cond & when, how)
    if hot_right and how == "left":  # of the copies, those that met rows of their slot
        copied = may_match & (over > 1)
        out = out.where(~copied | F.col("_hit").isNotNull()).drop("_hit", "_there")
    return out.drop(*slots, *names.values())


def is_hot(keys: Sequence[str], hot: Sequence[tuple[Any, ...]]) -> Column:
    """Whether the first keys have the values of a hot key: one set lookup, however many there are."""
    if not hot:
        return F.lit(False)
    if len(hot[0]) == 1:
        return F.col(keys[0]).isin([value for (value,) in hot])
    some = list(keys)[: len(hot[0])]
    listed = [F.struct(*[F.lit(v).alias(k) for k, v in zip(some, values)]) for values in hot]
    return F.struct(*[F.col(k).alias(k) for k in some]).isin(listed)


def slot_count(keys: Sequence[str], hot: Sequence[tuple[Any, ...]], ways: int) -> Column:
    """Over how many slots the rows of a key are dealt: 1 for a key that is not hot, else twice its
    share of `ways` and at least 2, as a power of two; `ways` where the share is not known."""
    groups: dict[int, list] = {}
    for key in hot:
        wanted = max(2, ceil(2 * getattr(key, "share", 1.0) * ways))
        groups.setdefault(max(1, min(ways, 1 << (wanted - 1).bit_length())), []).append(key)
    count = F.lit(1)
    for n, members in groups.items():
        count = F.when(flag(is_hot(keys, members)), n).otherwise(count)
    return count


def has_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def deal(df: DataFrame, slot: str, over: Column) -> DataFrame:
    """Give each row a slot from 0 to `over` - 1.

    The slot follows from the row and its partition, not from row order or a random number, so a
    task that is run again after a lost executor puts every row where it was. The partition number
    parts copies of one row.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
    return df.withColumn(slot, F.pmod(row, over.cast("bigint")).cast("int"))


def first_slot(keys: Sequence[str]) -> Column:
    """Slot 0, though not as a literal: the optimizer would take that out of the join's key."""
    return F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")


def copy(df: DataFrame, slot: str, over: Column) -> DataFrame:
    """Copy each row to the slots 0 to `over` - 1."""
    return df.withColumn(slot, F.explode(F.sequence(F.lit(0), over.cast("int") - 1)))
