"""A ledger of keys: on which days each key was in a daily snapshot, as intervals of days.

A snapshot difference asks of today's keys whether they were there yesterday and at last month's
end. Answered from the snapshots, that reads three whole days each day. The ledger has one row per
interval of consecutive days that a key was there without a break: `keys, first_day, last_day`. It is
moved on by a day with the day's keys alone, and answers for every day it reaches back to.

A day that was never written is a break, and so is a day a key was away: a key that returns starts a
new interval. Days are `ds` values (yyyyMMdd), so they compare as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions.expressions import flag
from dayledger.rundate import RunDate


def start_ledger(today: DataFrame, keys: Sequence[str], run: RunDate) -> DataFrame:
    """The ledger of a first day. Rows whose key has a NULL part are never in it."""
    day = F.lit(run.ds)
    return _keys(today, keys).withColumns({"first_day": day, "last_day": day})


def advance_ledger(
    ledger: DataFrame, today: DataFrame, keys: Sequence[str], run: RunDate, keep_from: str | None = None
) -> DataFrame:
    """`ledger`, as of any day before the run's, with the run day's keys.

    Intervals that reached yesterday and are met go on, other keys of today start one; all others stay
    as they are, but for those that ended before `keep_from`, which go: pass the earliest day still
    asked for and the ledger stays as large as the keys. One join of the open intervals with the
    day's distinct keys, and intervals that have ended are not shuffled. The same day over again, from
    the same ledger, gives the same rows.
    """
    names = list(keys)
    before = ledger.where(F.col("last_day") < run.ds)
    is_open = F.col("last_day") == run.prev_day
    ended = before.where(~is_open)
    if keep_from:
        ended = ended.where(F.col("last_day") >= keep_from)
    moved = before.where(is_open).join(_keys(today, keys).withColumn("_seen", F.lit(True)), names, "full_outer")
    moved = moved.withColumns({
        "first_day": F.coalesce("first_day", F.lit(run.ds)),
        "last_day": F.when(F.col("_seen"), run.ds).otherwise(F.col("last_day")),
    }).drop("_seen")
    if keep_from:
        moved = moved.where(F.col("last_day") >= keep_from)
    return moved.unionByName(ended.select(moved.columns))


def seen_by_ledger(ledger: DataFrame, keys: Sequence[str], days: dict[str, str]) -> DataFrame:
    """One row per key with a flag per day, `days` from flag name to ds: the key was there that day."""
    reached = [(F.col("first_day") <= ds) & (F.col("last_day") >= ds) for ds in days.values()]
    some = reached[0]
    for each in reached[1:]:
        some = some | each
    return ledger.where(some).groupBy(*keys).agg(*[F.max(r).alias(n) for r, n in zip(reached, days, strict=True)])


def ledger_diff(
    today: DataFrame,
    ledger: DataFrame,
    keys: Sequence[str],
    run: RunDate,
    new_today: str = "1d_is_created",
    new_this_month: str = "1m_is_created",
) -> DataFrame:
    """`today`'s rows with the flags of `snapshot_diff`, told from the ledger alone: the key was not
    there yesterday, and not at last month's end. The ledger may be as of yesterday or of the run day,
    and must reach back to last month's end. A key with a NULL part counts as new."""
    names = {new_today: run.prev_day, new_this_month: run.prev_month_end}
    out = today.join(seen_by_ledger(ledger, keys, names), list(keys), "left")
    return out.withColumns({name: ~flag(F.col(f"`{name}`")) for name in names})


def _keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).dropna().distinct()
