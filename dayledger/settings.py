"""SQL settings the jobs are tuned for. All can be changed on a running session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Split a skewed side even where that costs one more shuffle: a straggler costs more.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Judged on the size measured at run time, unlike spark.sql.autoBroadcastJoinThreshold.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "100MB",
    "spark.sql.broadcastTimeout": "1200",
    # ds=19980630 in a path is text, not a number.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


PART_BYTES = 128 * 1024 * 1024
FEWEST_PARTS = 200


def shuffle_parts(shuffle_bytes: int) -> int:
    """Shuffle partitions of about the advisory size for a job's largest shuffle. Adaptive
    execution merges parts that turn out small, but cannot add any."""
    return max(FEWEST_PARTS, -(-shuffle_bytes // PART_BYTES))


def apply_settings(
    spark: SparkSession, shuffle_bytes: int | None = None, **overrides: str
) -> SparkSession:
    """Set the recommended settings; with the size of the largest shuffle, its partitions too."""
    if shuffle_bytes is not None:
        overrides.setdefault("spark.sql.shuffle.partitions", str(shuffle_parts(shuffle_bytes)))
    for key, value in {**RECOMMENDED, **overrides}.items():
        spark.conf.set(key, value)
    return spark


def require_time_zone(spark: SparkSession) -> None:
    """Fail where the session's time zone was not set but taken from the machine: days and months of
    timestamps depend on it."""
    key = "spark.sql.session.timeZone"
    if spark.sql("SET").where(F.col("key") == key).isEmpty():  # lists what was set
        raise RuntimeError(f"set {key}, for example to UTC")


def scan_bytes(df: DataFrame, ds: str) -> int:
    """Size of the files behind `df`, of that day alone where days are folders. Lists the files and
    reads none."""
    files = df.inputFiles()
    files = [f for f in files if f"/ds={ds}/" in f] or files
    if not files:
        return 0
    return df.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0
