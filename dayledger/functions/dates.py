"""Date expressions on `yyyyMMdd` text and on timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.expressions import flag
from dayledger.functions.predicates import as_column, same_month
from dayledger.rundate import RunDate


def format_ds(ts: str | Column) -> Column:
    return F.date_format(as_column(ts), "yyyyMMdd")


def parse_ds(ds: str | Column) -> Column:
    return F.to_date(as_column(ds), "yyyyMMdd")


def month_key(ts: str | Column) -> Column:
    return F.date_format(as_column(ts), "yyyyMM")


def month_start(date: str | Column) -> Column:
    return F.trunc(as_column(date), "MM")


def prev_month_end(date: str | Column) -> Column:
    return F.last_day(F.add_months(as_column(date), -1))


def period_flags(ts: str | Column, run: RunDate) -> tuple[Column, Column]:
    """Whether the timestamp falls on the run day, and in the run month; NULL gives false."""
    c = as_column(ts)
    today = (c >= F.lit(run.day)) & (c < F.lit(run.next_date))
    return flag(today), flag(same_month(c, run))
