"""The reward log: yesterday's snapshot with today's increment merged in."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dayledger.operators import BROADCAST_LIMIT, merge_increment
from dayledger.plans.schemas import REWARD_LOG
from dayledger.rundate import RunDate
from dayledger.sources import Catalog, snapshot


def reward_merge(
    catalog: Catalog, run: RunDate, max_bytes: int = BROADCAST_LIMIT, buckets: int | None = None
) -> DataFrame:
    """The latest increment row per id replaces or adds. Rows changed at the same time are ordered
    by their other columns, so the choice is the same on every run. `buckets`: the snapshot is a table
    with so many buckets by id."""
    cols = REWARD_LOG.schema.names
    return merge_increment(
        snapshot(catalog.table("reward_snapshot"), run.prev_day).select(*cols),
        snapshot(catalog.table("reward_increment"), run.ds).select(*cols),
        keys=["id"],
        order=["lastmodified"],
        tiebreak=[c for c in cols if c not in ("id", "lastmodified")],
        max_bytes=max_bytes,
        buckets=buckets,
    )
