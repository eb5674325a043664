from dayledger.sources.catalog import Catalog, constant_row
from dayledger.sources.scans import (
    first_non_empty,
    increment,
    month_to_date,
    snapshot,
    trailing_days,
)

__all__ = ["Catalog", "constant_row", "first_non_empty", "increment", "month_to_date",
           "snapshot", "trailing_days"]
