"""Exact distinct counts that can be added up over days.

A count of distinct values cannot be added to another day's, but the values can: as bitmaps, a row
per group and per 32,768 neighbouring numbers. A day's bitmaps are made once; a month to date is
yesterday's month to date or-ed with today's, and its count is the number of bits. Values are whole
numbers of any sign; others need numbers first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITMAP = "bitmap_bucket", "bitmap"


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """keys, bitmap_bucket and bitmap of the values of `col`; NULL is not a value, so a group of NULLs
    alone has no row. Groups are split by bucket, so a large one is made by many tasks, and bits are
    set where the rows are read before anything is shuffled."""
    value = F.col(col).cast("bigint")
    return (
        df.where(value.isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(value).alias(BUCKET))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias(BITMAP))
    )


def merge_bitmaps(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The bitmaps of all parts together: days, or a month to date and a day. Merging a part twice
    changes nothing."""
    rows = reduce(DataFrame.unionByName, [p.select(*keys, BUCKET, BITMAP) for p in parts])
    return rows.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def count_bitmaps(bitmaps: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """The distinct count of each group: of merged bitmaps, one row per group and bucket."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count(F.col(BITMAP))).alias(alias))


def month_to_date_bitmaps(before: DataFrame | None, today: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The month to date with today's bitmaps. `before`: that of yesterday, or none on the first day."""
    return merge_bitmaps([today] if before is None else [before, today], keys)
