"""Days that are audited while they are written, and shown to readers only if they pass.

Row and NULL counts are gathered by the tasks that write, as observed metrics: they cost no scan of
their own. `publish_partition` writes a day beside the one readers see, looks at the figures, and then
points the table at the new files in one step of the catalog.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.rundate import RunDate
from dayledger.sinks.tables import TableSpec, laid_out, table_writer, write_partition

Figures = dict[str, int]
Rule = Callable[[Figures], bool]
AUDITS = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("ds", T.StringType()),
    T.StructField("metric", T.StringType()), T.StructField("value", T.LongType()),
])


class AuditFailed(ValueError):
    """A day that broke rules; `figures` has what was counted."""

    def __init__(self, day: str, broken: Sequence[str], figures: Figures):
        super().__init__(f"day {day} breaks {', '.join(broken)}: {figures}")
        self.figures = figures


def observed(df: DataFrame, nulls: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """`df`, and what will have been counted once an action has run it to its end: record_count, and
    null_{column}_count for each of `nulls`. Give it to one action only. For a source as well as for a
    result: each source of a job can be observed on its way into it."""
    seen = Observation()
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}_count") for c in nulls]
    return df.observe(seen, F.count(F.lit(1)).alias("record_count"), *counts), seen


def observed_sources(sources: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], Callable[[], Figures]]:
    """The named sources observed, and a function that gives each one's row count after the action. A
    source that is read in several places is counted as often."""
    both = {name: observed(df) for name, df in sources.items()}
    return {name: df for name, (df, _) in both.items()}, lambda: {name: seen.get["record_count"] for name, (_, seen) in both.items()}


def write_audited(
    df: DataFrame, spec: TableSpec, ds: str, path: str | None = None, nulls: Sequence[str] = (), cluster_by: Sequence[str] | None = None
) -> Figures:
    """`write_partition`, giving the day's figures, counted as it was written."""
    rows, seen = observed(df, nulls)
    write_partition(rows, spec, ds, path, cluster_by)
    return dict(seen.get)


def publish_partition(
    df: DataFrame,
    spec: TableSpec,
    ds: str,
    rules: Mapping[str, Rule],
    nulls: Sequence[str] = (),
    cluster_by: Sequence[str] | None = None,
) -> Figures:
    """Write a day aside, audit it, and make it the table's day. A rule gets the day's figures and says
    whether they will do; if one says no, AuditFailed is raised, readers go on seeing the day as it was, and
    what was written stays aside for a look. Readers see the old day or the new one, never a part of either.
    The old day's files stay in their folder."""
    spark, day = df.sparkSession, RunDate.parse(ds).ds
    if spec.buckets or spec.by_run:
        raise ValueError("only a plain table's day is published")
    folder = f"{_location(spark, spec)}/published/{day}-{uuid4().hex}"
    rows, seen = observed(laid_out(df, spec, cluster_by), nulls)
    table_writer(rows, spec).save(folder)
    figures = dict(seen.get)
    broken = [name for name, rule in rules.items() if not rule(figures)]
    if broken:
        raise AuditFailed(day, broken, figures)
    part = f"ALTER TABLE {spec.name} {{}} (ds = '{day}') {{}} '{folder}'"
    there = spark.sql(f"SHOW PARTITIONS {spec.name} PARTITION (ds = '{day}')")
    spark.sql(part.format("ADD PARTITION", "LOCATION") if there.isEmpty() else part.format("PARTITION", "SET LOCATION"))
    return figures


def _location(spark: SparkSession, spec: TableSpec) -> str:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {spec.name}").where("col_name = 'Location'").first()
    return about["data_type"].rstrip("/")


def figure_rows(spark: SparkSession, spec: TableSpec, ds: str, figures: Figures) -> DataFrame:
    """Figures as rows of AUDITS, to be kept with those of other days."""
    return spark.createDataFrame([(spec.name, ds, k, int(v)) for k, v in figures.items()], AUDITS)


def trend_of(audits: DataFrame, table: str, n: int = 10) -> DataFrame:
    """Row counts of a table's latest n days, told from kept figures: ds and daily_count."""
    own = audits.where((F.col("table_name") == table) & (F.col("metric") == "record_count"))
    return own.select("ds", F.col("value").alias("daily_count")).orderBy(F.col("ds").desc()).limit(n)
