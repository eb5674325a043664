from dayledger.operators.aggregates import count_distinct_by, count_rows, top_n
from dayledger.operators.audit import (
    audit_nulls,
    audit_partitions,
    audit_result,
    audit_skew,
    audit_sources,
    audit_trend,
    duplicate_keys,
)
from dayledger.operators.bitmaps import count_bitmaps, distinct_bitmaps, merge_bitmaps, month_to_date_bitmaps
from dayledger.operators.joins import (
    anti,
    fallback_join,
    join_when,
    left_join,
    lookup,
    salted_join,
    semi,
)
from dayledger.operators.layout import by_column, narrow, persisted, rebalance, to_n
from dayledger.operators.ledger import advance_ledger, ledger_diff, seen_by_ledger, start_ledger
from dayledger.operators.merge import merge_increment
from dayledger.operators.records import (
    dedup,
    first_per_key,
    latest_per_key,
    mark,
    seen_on,
    snapshot_diff,
)
from dayledger.operators.sizing import BROADCAST_LIMIT, checked_broadcast, fits, measured_bytes
from dayledger.operators.skew import hot_keys, hot_keys_each, merged_hot, sketch_days, spread_join

__all__ = [
    "BROADCAST_LIMIT", "advance_ledger", "anti", "audit_nulls", "audit_partitions", "audit_result",
    "audit_skew", "audit_sources", "audit_trend", "by_column", "checked_broadcast", "count_bitmaps",
    "count_distinct_by", "count_rows", "dedup", "distinct_bitmaps", "duplicate_keys", "fallback_join",
    "first_per_key", "fits", "hot_keys", "hot_keys_each", "join_when", "latest_per_key", "ledger_diff",
    "left_join", "lookup", "mark", "measured_bytes", "merge_bitmaps", "merge_increment", "merged_hot",
    "month_to_date_bitmaps", "narrow", "persisted", "rebalance", "salted_join", "seen_by_ledger", "seen_on",
    "semi", "sketch_days", "snapshot_diff", "spread_join", "start_ledger", "to_n", "top_n",
]
