"""First and latest records, duplicates, existence flags and snapshot differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.functions.expressions import flag
from dayledger.operators.skew import has_null, hot_keys, is_hot, spread_join
from dayledger.rundate import RunDate


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    ties: bool = False,
    tiebreak: Sequence[str] = (),
    hot: Sequence[tuple] | None = None,
    keyed: bool = False,
    descending: bool = False,
    cut: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """The first row per key in ascending `order`, NULL first, or in descending order, NULL last.

    Without `ties` exactly one row per key stays, and `tiebreak` must order equal rows. Spark cuts
    each task's rows to one per key before the shuffle, so a hot key costs nothing.

    With `ties` all rows equal to the first stay, and those of one key would meet in one task. So
    the `hot` keys, looked for unless given, and keys with a NULL part take another way: the first
    values, one per hot key and one per key with a NULL, are joined to the rows. `keyed` says that no
    key has a NULL part. Without `cut` no task cuts, and so sorts, its rows before the shuffle: for ties
    in which that would drop next to nothing; the rows are then shuffled into `parts`, if given, which
    adaptive execution does not merge.
    """
    if not ties and not tiebreak:
        raise ValueError("a single first row needs a tiebreak")
    by = order if ties else (*order, *tiebreak)
    order_by = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in by]
    window = Window.partitionBy(*keys).orderBy(*order_by)
    if not ties:
        return _only(df, F.row_number().over(window))
    hot = hot_keys(df, keys) if hot is None else hot
    value = F.struct(*order)
    best = F.max if descending else F.min

    def first(rows: DataFrame) -> DataFrame:
        if cut:
            return _only(rows, F.rank().over(window))
        rows = rows if parts is None else rows.repartition(parts, *keys)
        rows = rows.withColumn("_first", best(value).over(Window.partitionBy(*keys)))
        return rows.where(value.eqNullSafe(F.col("_first"))).drop("_first")

    if keyed and not hot:
        return first(df)
    # a NULL key is never looked for and may be many rows: it is held apart too
    held = flag(is_hot(keys, hot)) | has_null(keys)
    held_rows = df.where(held)
    firsts = held_rows.groupBy(*keys).agg(best(value).alias("_first"))
    firsts = firsts.withColumnsRenamed({k: f"_held_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
    if len(keys) == 1:  # a row per hot key, and one for NULL
        firsts = F.broadcast(firsts)
    held_first = held_rows.join(firsts, same & value.eqNullSafe(F.col("_first")))
    held_first = held_first.drop("_first", *[f"_held_{k}" for k in keys])
    return first(df.where(~held)).unionByName(held_first)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str]
) -> DataFrame:
    """The one row per key that is last in `order`, NULL before all; `tiebreak` orders equal rows."""
    if not tiebreak:
        raise ValueError("a single latest row needs a tiebreak")
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (*order, *tiebreak)])
    return _only(df, F.row_number().over(window))


def newest_partition(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of each key's newest `ds`."""
    newest = df.groupBy(*keys).agg(F.max("ds").alias("ds"))
    return df.join(newest, [*keys, "ds"])


def _only(df: DataFrame, rank: Column) -> DataFrame:
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedup(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct values of `cols` (all columns by default); NULLs count as equal."""
    return (df if cols is None else df.select(*cols)).distinct()


def mark(
    left: DataFrame, right: DataFrame, on: Sequence[str], name: str, dedup: bool = True
) -> DataFrame:
    """Add the flag `name`: the row's key occurs on the right. A key with a NULL part never does.

    Copies of a right key are removed first, so the left rows keep their number. With
    `dedup=False` a left row is repeated for every copy.
    """
    found = right.select(*on).dropna()
    found = (found.distinct() if dedup else found).withColumn(name, F.lit(True))
    hot = [] if dedup else hot_keys(found, on)
    return spread_join(left, found, on, "left", hot_right=hot).withColumn(name, flag(F.col(f"`{name}`")))


def seen_on(df: DataFrame, keys: Sequence[str], days: dict[str, str]) -> DataFrame:
    """One row per key of the given snapshots, with a flag per day: `days` maps flag name to ds.
    A single scan of those partitions and a single aggregation, however many days."""
    return (
        df.where(F.col("ds").isin(*sorted(set(days.values()))))
        .dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[F.max(F.col("ds") == ds).alias(name) for name, ds in days.items()])
    )


def snapshot_diff(
    df: DataFrame,
    keys: Sequence[str],
    run: RunDate,
    new_today: str = "1d_is_created",
    new_this_month: str = "1m_is_created",
    dedup: bool = True,
) -> DataFrame:
    """The run day's snapshot with two flags: the key was not in yesterday's snapshot, and not in
    that of last month's end. `dedup=False` repeats a row for every copy of its key on those days.
    """
    current = df.where(F.col("ds") == run.ds)
    names = {new_today: run.prev_day, new_this_month: run.prev_month_end}
    if dedup:
        current = current.join(seen_on(df, keys, names), list(keys), "left")
    else:
        for name, ds in names.items():
            current = mark(current, df.where(F.col("ds") == ds), keys, name, dedup=False)
    return current.withColumns({name: ~flag(F.col(f"`{name}`")) for name in names})
