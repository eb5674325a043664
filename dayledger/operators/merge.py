"""Upsert: a day's increment over yesterday's snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.operators.records import latest_per_key
from dayledger.operators.sizing import BROADCAST_LIMIT, measured_bytes

HASHED_LIMIT = 64 * 1024 * 1024  # bytes of changed keys that one task holds as a hash table


def merge_increment(
    snapshot: DataFrame,
    increment: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str],
    max_bytes: int = BROADCAST_LIMIT,
    buckets: int | None = None,
) -> DataFrame:
    """The latest increment row per key, and the snapshot rows of all other keys.

    Rows deleted softly are kept like any other. If the increment's keys, copies and all, are
    measured to fit, they are broadcast and the snapshot is neither shuffled nor sorted.

    `buckets` says that the snapshot is read from a table with so many buckets by exactly these keys.
    An increment of any size then goes to the buckets, once, and the snapshot stays where it lies; it is
    not sorted either while a bucket's changed keys fit a hash table. The result lies in the buckets.
    """
    size = measured_bytes(increment.select(*keys))
    if buckets:
        increment = increment.repartition(buckets, *keys)
    latest = latest_per_key(increment, keys, order, tiebreak)
    changed = increment.select(*keys).distinct()  # the same keys, without a second window
    if size <= max_bytes:
        changed = F.broadcast(changed)
    elif buckets:
        changed = changed.hint("shuffle_hash" if size / buckets <= HASHED_LIMIT else "merge")
    untouched = snapshot.join(changed, list(keys), "left_anti")
    return latest.select(*snapshot.columns).unionByName(untouched)
