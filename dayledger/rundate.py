"""The run date of a daily job and the partition values that follow from it."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunDate:
    """One calendar day. Partition values are `yyyyMMdd` strings, so text order is date order."""

    day: dt.date

    @classmethod
    def parse(cls, ds: str) -> RunDate:
        if len(ds) != 8 or not ds.isascii() or not ds.isdigit():
            raise ValueError(f"run date must be yyyyMMdd, got {ds!r}")
        return cls(dt.date(int(ds[:4]), int(ds[4:6]), int(ds[6:])))

    @property
    def ds(self) -> str:
        return self.day.strftime("%Y%m%d")

    @property
    def prev_day(self) -> str:
        return self.days_before(1)

    @property
    def month_start(self) -> str:
        return self.first_of_month.strftime("%Y%m%d")

    @property
    def prev_month_end(self) -> str:
        return (self.first_of_month - dt.timedelta(days=1)).strftime("%Y%m%d")

    @property
    def first_of_month(self) -> dt.date:
        return self.day.replace(day=1)

    @property
    def first_of_next_month(self) -> dt.date:
        return (self.first_of_month + dt.timedelta(days=31)).replace(day=1)

    @property
    def next_date(self) -> dt.date:
        return self.day + dt.timedelta(days=1)

    def days_before(self, n: int) -> str:
        return (self.day - dt.timedelta(days=n)).strftime("%Y%m%d")

    def trailing(self, n: int) -> tuple[str, str]:
        """First and last partition of the n days before the run date."""
        return self.days_before(n), self.prev_day
