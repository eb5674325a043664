"""Join shapes of the jobs. All are equi-joins; Catalyst and adaptive execution pick the strategy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.operators.records import first_per_key
from dayledger.operators.sizing import BROADCAST_LIMIT, fits, task_parts
from dayledger.operators.skew import (
    HOT_ROWS,
    HOT_SHARE,
    hot_keys,
    hot_keys_each,
    merged_hot,
    spread_join,
)


def semi(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows whose key occurs on the right, each once. The right keys are made distinct where
    they are read, so copies of a key do not meet in one task."""
    return left.join(right.select(*on).distinct(), list(on), "left_semi")


def anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows whose key does not occur on the right; a NULL key never occurs."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def join_when(left: DataFrame, right: DataFrame, on: Sequence[str], when: Column) -> DataFrame:
    """Left join in which only left rows that meet `when` may match. The others stay, with NULLs.
    For a right side of lookup size: `left_join` takes the same `when` and spreads hot keys."""
    return spread_join(left, right, on, "left", when=when)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    ways: int | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """The plain join's rows, with the keys that are hot on either side spread over `ways` tasks."""
    once = how in ("left_semi", "left_anti")  # only the distinct right keys count
    return spread_join(
        left, right, on, how, ways=ways,
        hot_left=hot_keys(left, on, share, min_rows),
        hot_right=[] if once else hot_keys(right, on, share, min_rows),
    )


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    when: Column | None = None,
    hot_left: Sequence[tuple] = (),
    spread_nulls: bool = False,
) -> DataFrame:
    """Left join to a large relation: hot right keys are looked for and spread by hand, hot left
    keys by adaptive execution, or by hand if they are given."""
    return spread_join(left, right, on, "left", when=when, hot_left=hot_left,
                       hot_right=hot_keys(right, on), spread_nulls=spread_nulls)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    value: str,
    names: Mapping[str, str],
    max_bytes: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join one dimension once per role: `names` maps each foreign key to its name column. The names
    come after the columns of `df`, whichever way the dimension is joined."""
    cols = [*df.columns, *names.values()]
    small = fits(dim.select(key, value), max_bytes)
    for fk, name in names.items():
        role = dim.select(F.col(key).alias(fk), F.col(value).alias(name))
        if small:
            df = df.join(F.broadcast(role), fk, "left")
        else:
            df = spread_join(df, role, [fk], "left", spread_nulls=True)
    return df.select(*[f"`{c}`" for c in cols])


def fallback_join(
    base: DataFrame,
    sources: Sequence[DataFrame],
    on: Sequence[str],
    cols: Sequence[str],
    *,
    latest_only: bool = False,
    prefilter: bool = False,
    hot: Sequence[tuple] = (),
    spread_nulls: bool = False,
    level: str | None = None,
    max_bytes: int = BROADCAST_LIMIT,
    hot_sources: Sequence[tuple] | None = None,
    broadcast: bool = False,
) -> DataFrame:
    """Left join `base` to the first of the ranked sources that has a match, base row by base row.

    Every base row stays. `latest_only` keeps only the newest `ds` of each key in each source,
    else all matches count. `prefilter` first cuts each source to the base's keys if they are measured to fit a
    broadcast: worth it for a staged base and a source many times its size. Keys that do not fit would
    have to meet every source in a shuffled join of its own, all of them in one task, only to drop rows that the
    join with the base drops: the sources are then not cut. `level` names a column for the rank of the source
    that matched, from 1.

    The sources are tagged with their rank and put in one relation; the rows of each key's first
    source, and of its newest day, are the first of the key in that order. So however many sources there
    are, their rows meet once and the base is joined, and shuffled, once. Base rows of the `hot` keys, and
    with `spread_nulls` those with a NULL key, are dealt over slots. Hot keys of the sources are looked for
    unless `hot_sources` has them. The rows of the sources, and of a staged base, are measured, and dealt into as many
    parts as keep a task small, unless `latest_only`. `broadcast` says that all sources together were measured to fit: the base
    is then not shuffled at all.
    """
    keys = list(on)
    wanted = base.select(*keys).dropna().distinct() if prefilter else None
    if wanted is not None and not fits(wanted, max_bytes):
        wanted = None
    # hot keys are looked for in the sources as they are read, not behind the cuts
    if broadcast:
        hot_matches = []
    elif hot_sources is None:
        hot_matches = merged_hot(hot_keys_each([(source, keys) for source in sources]))
    else:
        hot_matches = list(hot_sources)
    new = {c: f"_new_{c}" for c in cols}
    types = {c: sources[0].schema[c].dataType for c in cols}
    tagged = []
    for rank, source in enumerate(sources, start=1):
        if wanted is not None:
            source = source.join(F.broadcast(wanted), keys, "left_semi")
        row = [*keys, *[F.col(c).cast(types[c]).alias(n) for c, n in new.items()], F.lit(-rank).alias("_source")]
        if latest_only:
            row.append(F.col("ds").alias("_day"))
        tagged.append(source.select(*row).dropna(subset=[*keys, "_day"] if latest_only else keys))
    rows = reduce(DataFrame.unionByName, tagged)
    parts = None if broadcast or latest_only else task_parts(rows, *([base] if prefilter else []))
    ranked = latest_only or len(sources) > 1
    if ranked:
        by = ["_source", "_day"] if latest_only else ["_source"]
        # a task's rows are of one source, so none could go before the shuffle unless days differ
        rows = first_per_key(rows, keys, by, ties=True, hot=hot_matches, keyed=True, descending=True, cut=latest_only, parts=parts)
    rows = rows.select(*keys, *new.values(), "_source")
    if broadcast:
        base = base.drop(*cols)
        joined = base.join(F.broadcast(rows), keys, "left")
        out = joined.select(*[f"`{c}`" for c in [*base.columns, *new.values(), "_source"]])
    else:
        slotted = hot or hot_matches or spread_nulls
        out = spread_join(base.drop(*cols), rows, keys, "left", hot_left=hot, hot_right=hot_matches, spread_nulls=spread_nulls,
                          parts=parts if slotted or not ranked else None)  # ranked rows lie by key already
    out = out.withColumnsRenamed({n: c for c, n in new.items()})
    return out.drop("_source") if level is None else out.withColumn("_source", -F.col("_source")).withColumnRenamed("_source", level)
