"""Row conditions. NULL input keeps SQL's three-valued logic, so such rows fail a filter."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.rundate import RunDate


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def eq(col: str | Column, value: Any) -> Column:
    return as_column(col) == F.lit(value)


def in_list(col: str | Column, values: Collection[Any]) -> Column:
    return as_column(col).isin(*values)


def not_in_list(col: str | Column, values: Collection[Any]) -> Column:
    return ~as_column(col).isin(*values)


def between_ds(col: str | Column, lo: str, hi: str) -> Column:
    return as_column(col).between(lo, hi)


def same_month(ts: str | Column, run: RunDate) -> Column:
    """The row's calendar month is the run month, as a range that reaches the scan."""
    c = as_column(ts)
    return (c >= F.lit(run.first_of_month)) & (c < F.lit(run.first_of_next_month))


def category_filter(cols: Sequence[str], rules: Sequence[Sequence[Collection[Any]]]) -> Column:
    """True where any rule holds. A rule lists the allowed values level by level; a rule
    shorter than `cols` leaves the deeper levels free."""
    return reduce(or_, [
        reduce(and_, [in_list(col, sorted(allowed)) for col, allowed in zip(cols, rule)])
        for rule in rules
    ])
