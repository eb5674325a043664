"""Dropping days that are past a table's retention."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.rundate import RunDate


def expired_partitions(partitions: DataFrame, run: RunDate, days: int) -> DataFrame:
    """Distinct `ds` values more than `days` days before the run date."""
    return partitions.where(F.col("ds") < run.days_before(days)).select("ds").distinct()


def drop_expired(spark: SparkSession, table: str, run: RunDate, days: int) -> list[str]:
    """Drop the table's expired days and return them. Only partition names reach the driver."""
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    parts = listed.select(F.regexp_extract("partition", r"ds=([0-9]{8})", 1).alias("ds"))
    gone = sorted(row["ds"] for row in expired_partitions(parts.where("ds <> ''"), run, days).collect())
    if gone:
        named = ", ".join(f"PARTITION (ds = '{ds}')" for ds in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named}")
    return gone


def day_folders(spark: SparkSession, path: str) -> list[str]:
    """The days that have a `ds=` folder under a path, ascending. Only names are listed."""
    folder, system = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder) if status.isDirectory()]
    return sorted(m[1] for m in (re.fullmatch(r"ds=([0-9]{8})", name) for name in names) if m)


def drop_expired_path(spark: SparkSession, path: str, run: RunDate, days: int) -> list[str]:
    """Delete the expired days under a path and return them, in any file system that Spark reaches.
    Folders of other names stay."""
    gone = [ds for ds in day_folders(spark, path) if ds < run.days_before(days)]
    for ds in gone:
        folder, system = _folder(spark, f"{path.rstrip('/')}/ds={ds}")
        system.delete(folder, True)
    return gone


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
