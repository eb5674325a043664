from dayledger.sinks.audited import (
    AuditFailed,
    figure_rows,
    observed,
    observed_sources,
    publish_partition,
    trend_of,
    write_audited,
)
from dayledger.sinks.retention import day_folders, drop_expired, drop_expired_path, expired_partitions
from dayledger.sinks.staging import shared_dir, stage, staged
from dayledger.sinks.tables import (
    TableSpec,
    append_partition,
    ensure_table,
    write_partition,
    write_partitions,
)

__all__ = ["AuditFailed", "TableSpec", "append_partition", "day_folders", "drop_expired", "drop_expired_path",
           "ensure_table", "expired_partitions", "figure_rows", "observed", "observed_sources", "publish_partition",
           "shared_dir", "stage", "staged", "trend_of", "write_audited", "write_partition", "write_partitions"]
