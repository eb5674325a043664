"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.operators.aggregates import count_rows, top_n


def audit_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named source, each with its own filter already applied."""
    return reduce(DataFrame.unionByName, [
        count_rows(df, alias="record_count").select(F.lit(name).alias("table_name"), "record_count")
        for name, df in sources.items()
    ])


def audit_result(df: DataFrame, ds: str) -> DataFrame:
    return count_rows(df.where(F.col("ds") == ds), alias="final_count")


def audit_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count of every column in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}_count") for c in cols])


def audit_trend(df: DataFrame, n: int = 10) -> DataFrame:
    """Row count of the latest n partitions."""
    return top_n(count_rows(df, ["ds"], "daily_count"), [F.col("ds").desc()], n)


def audit_skew(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n heaviest keys; the key settles equal counts."""
    return top_n(count_rows(df, [key]), [F.col("cnt").desc(), F.col(key)], n)


def audit_partitions(df: DataFrame) -> DataFrame:
    """Row count of every partition, newest first."""
    return count_rows(df, ["ds"]).orderBy(F.col("ds").desc())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, for tables a job takes to be unique."""
    return count_rows(df.dropna(subset=list(keys)), keys).where(F.col("cnt") > 1)
