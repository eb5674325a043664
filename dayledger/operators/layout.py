"""How rows lie over tasks and files; the rows themselves do not change."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def to_n(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def by_column(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """Rows of one value in one of n parts. A hot value makes a large part: see `rebalance`."""
    return df.repartition(n, *cols)


def rebalance(df: DataFrame, *cols: str) -> DataFrame:
    """Parts of about the advisory size, near each other by `cols` but split where one is too
    large, so a hot value does no harm."""
    return df.hint("rebalance", *cols)


def narrow(df: DataFrame, n: int) -> DataFrame:
    """At most n parts without a shuffle. It also narrows the stage before it, so use it on small
    results only."""
    return df.coalesce(n)


@contextmanager
def persisted(df: DataFrame, name: str | None = None) -> Iterator[DataFrame]:
    """Keep a result that is read several times, and give it a session-wide name if asked to.
    A part lost with its executor is computed again."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    if name:
        df.createOrReplaceTempView(name)
    try:
        yield df
    finally:
        if name:
            df.sparkSession.catalog.dropTempView(name)
        df.unpersist()
