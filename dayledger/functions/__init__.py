from dayledger.functions.dates import (
    format_ds,
    month_key,
    month_start,
    parse_ds,
    period_flags,
    prev_month_end,
)
from dayledger.functions.expressions import (
    child_or_parent,
    conform,
    fill_defaults,
    fill_missing,
    first_rule,
    flag,
    label,
    remap,
    to_bigint,
)
from dayledger.functions.predicates import (
    between_ds,
    category_filter,
    eq,
    in_list,
    not_in_list,
    same_month,
)

__all__ = [
    "between_ds", "category_filter", "child_or_parent", "conform", "eq", "fill_defaults",
    "fill_missing", "first_rule", "flag", "format_ds", "in_list", "label", "month_key",
    "month_start", "not_in_list", "parse_ds", "period_flags", "prev_month_end", "remap",
    "same_month", "to_bigint",
]
