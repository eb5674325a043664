import datetime as dt

import pytest

from dayledger import RunDate


@pytest.mark.parametrize("ds, prev_day, month_start, prev_month_end, next_month", [
    ("19980630", "19980629", "19980601", "19980531", dt.date(1998, 7, 1)),
    ("20240101", "20231231", "20240101", "20231231", dt.date(2024, 2, 1)),
    ("20240301", "20240229", "20240301", "20240229", dt.date(2024, 4, 1)),
    ("20230301", "20230228", "20230301", "20230228", dt.date(2023, 4, 1)),
    ("20250331", "20250330", "20250301", "20250228", dt.date(2025, 4, 1)),
    ("20241231", "20241230", "20241201", "20241130", dt.date(2025, 1, 1)),
])
def test_days(ds, prev_day, month_start, prev_month_end, next_month):
    run = RunDate.parse(ds)
    assert run.ds == ds
    assert run.prev_day == prev_day
    assert run.month_start == month_start
    assert run.prev_month_end == prev_month_end
    assert run.first_of_next_month == next_month


def test_trailing_days_cross_a_month():
    assert RunDate.parse("20240303").trailing(7) == ("20240225", "20240302")


@pytest.mark.parametrize("text", ["1998-06-30", "199806", "19981301", "1998063a", ""])
def test_bad_date(text):
    with pytest.raises(ValueError):
        RunDate.parse(text)
