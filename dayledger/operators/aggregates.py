"""Counts. Each is partly aggregated before its shuffle, so copies and hot groups shrink first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_distinct_by(df: DataFrame, keys: Sequence[str], col: str, alias: str) -> DataFrame:
    """Exact distinct count per group. Spark first shuffles on group and value together, so one
    large group is counted by many tasks."""
    return df.groupBy(*keys).agg(F.count_distinct(F.col(col)).alias(alias))


def count_rows(df: DataFrame, by: Sequence[str] = (), alias: str = "cnt") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(alias))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
