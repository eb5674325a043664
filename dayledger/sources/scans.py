"""Partition scans relative to a run date. Every bound is a literal, so partitions are pruned."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.functions.predicates import between_ds
from dayledger.rundate import RunDate


def snapshot(df: DataFrame, ds: str) -> DataFrame:
    return df.where(F.col("ds") == ds)


def month_to_date(df: DataFrame, run: RunDate) -> DataFrame:
    return df.where(between_ds("ds", run.month_start, run.ds))


def trailing_days(df: DataFrame, run: RunDate, n: int) -> DataFrame:
    """The n partitions before the run date."""
    return df.where(between_ds("ds", *run.trailing(n)))


def increment(df: DataFrame, ds: str, action: Any = None, action_col: str = "action_type") -> DataFrame:
    day = snapshot(df, ds)
    return day if action is None else day.where(F.col(action_col) == F.lit(action))


def first_non_empty(*sources: DataFrame) -> DataFrame:
    """The first source that holds a row, else the last. Each look reads at most one row."""
    for df in sources[:-1]:
        if not df.isEmpty():
            return df
    return sources[-1]
