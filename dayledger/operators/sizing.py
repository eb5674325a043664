"""Broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 100 * 1024 * 1024
TASK_BYTES = 32 * 1024 * 1024

_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)


def measured_bytes(df: DataFrame) -> int:
    """Bytes the rows take in Spark's row format: a header word, a word per column, and the bytes
    of every string. One aggregation that moves one row per task, whatever the input."""
    width = 8 + 8 * ((len(df.columns) + 63) // 64) + 8 * len(df.columns)
    text = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)).cast("bigint")
        for f in df.schema if not isinstance(f.dataType, _FIXED)
    ]
    per_row = sum(text, F.lit(width).cast("bigint"))
    return df.agg(F.sum(per_row).alias("bytes")).first()["bytes"] or 0


def fits(df: DataFrame, max_bytes: int = BROADCAST_LIMIT) -> bool:
    """Runs `df` once: give it a scan or a staged result, not the end of a long plan."""
    return measured_bytes(df) <= max_bytes


def task_parts(*dfs: DataFrame) -> int | None:
    """Into how many parts rows that meet by key are dealt, so that a task sorts about TASK_BYTES of them
    whatever the session's shuffle partitions; nothing where one part holds them all. Runs each of
    `dfs` once, as `fits` does."""
    parts = -(-sum(measured_bytes(df) for df in dfs) // TASK_BYTES)
    return parts if parts > 1 else None


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    """`df` hinted for a broadcast if it is small enough, else `df` for a shuffled join."""
    return F.broadcast(df) if fits(df, max_bytes) else df
