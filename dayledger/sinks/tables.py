"""Partitioned target tables and the ways to write their days.

Every writer takes a table (`spec.name`) or, with `path`, a directory with `ds=` folders. One day is
written as the plan leaves it, since adaptive execution already sizes the parts of a last shuffle;
`cluster_by` asks for one more shuffle, to files of about the advisory size, near each other by
those columns (by none: just even files). Days are never gathered in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.functions.expressions import conform
from dayledger.operators.layout import rebalance
from dayledger.rundate import RunDate


@dataclass(frozen=True)
class TableSpec:
    """A table partitioned by `ds`; `schema` holds its other columns, with comments. With `buckets`
    each day lies in that many parts by the hash of the columns `bucket_by`, sorted by them: a join or
    merge on these columns reads the day without a shuffle. With `by_run` a day is made of runs that add
    to it, each in a part of its own that a second attempt replaces."""

    name: str
    schema: T.StructType
    comment: str = ""
    retention_days: int = 3650
    fmt: str = "orc"
    compression: str = "snappy"
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    by_run: bool = False

    def named(self, name: str) -> TableSpec:
        return replace(self, name=name)

    def bucketed(self, by: Sequence[str], buckets: int) -> TableSpec:
        return replace(self, bucket_by=tuple(by), buckets=buckets)


def column(name: str, type_: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, type_, True, {"comment": comment} if comment else {})


def ensure_table(spark: SparkSession, spec: TableSpec, location: str | None = None) -> None:
    """Create the table if there is none. One that is there must have the columns of `spec`, of the
    same types; their order does not matter, since rows are written by name."""
    cols = [
        f"`{f.name}` {f.dataType.simpleString()} COMMENT {_text(f.metadata.get('comment', ''))}"
        for f in spec.schema
    ]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {spec.name} "
        f"({', '.join(cols)}, ds STRING COMMENT 'day, yyyyMMdd'{', run STRING' if spec.by_run else ''}) "
        f"USING {spec.fmt} OPTIONS ('compression' = '{spec.compression}') "
        f"PARTITIONED BY (ds{', run' if spec.by_run else ''}) {_buckets(spec)} COMMENT {_text(spec.comment)}"
        + (f" LOCATION {_text(location)}" if location else "")
    )
    there = {f.name: f.dataType for f in spark.table(spec.name).schema}
    wanted = {f.name: f.dataType for f in _with_ds(spec)}
    if there != wanted:
        odd = sorted(n for n in there.keys() | wanted.keys() if there.get(n) != wanted.get(n))
        raise ValueError(f"table {spec.name} is of another shape; see columns {', '.join(odd)}")
    if spec.buckets:
        about = dict(spark.sql(f"DESCRIBE TABLE EXTENDED {spec.name}").select("col_name", "data_type").collect())
        lies = about.get("Num Buckets"), about.get("Bucket Columns")
        if lies != (str(spec.buckets), str([f"`{c}`" for c in spec.bucket_by]).replace("'", "")):
            raise ValueError(f"table {spec.name} does not lie in {spec.buckets} buckets by {', '.join(spec.bucket_by)}")


def write_partition(
    df: DataFrame,
    spec: TableSpec,
    ds: str,
    path: str | None = None,
    cluster_by: Sequence[str] | None = None,
    in_buckets: bool = False,
) -> None:
    """Replace one day, even by nothing; other days stay. Running it again changes nothing.

    For a table with buckets the rows are dealt to them first, unless they lie `in_buckets` already:
    a bucket is then written by the tasks that hold its rows. Its rows may come from another day of
    the same table."""
    day = RunDate.parse(ds).ds
    if spec.by_run:
        raise ValueError("a day made of runs is added to, run by run")
    rows = laid_out(df, spec, cluster_by)
    if spec.buckets and path:
        raise ValueError("only a table has buckets")
    if spec.buckets:
        _write_buckets(rows if in_buckets else rows.repartition(spec.buckets, *spec.bucket_by), spec, day)
    elif path:
        table_writer(rows, spec).mode("overwrite").save(f"{path}/ds={day}")
    else:
        df.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {spec.name} PARTITION (ds = '{day}') BY NAME SELECT * FROM {{rows}}",
            rows=rows,
        )


def write_partitions(df: DataFrame, spec: TableSpec, path: str | None = None) -> None:
    """Replace the days that occur in the data; other days stay. Rows are gathered by day, a large
    day over many tasks, so that not every task writes a file per day."""
    rows = rebalance(conform(df, _with_ds(spec)), "ds")
    if path:
        writer = table_writer(rows, spec).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("ds").save(path)
    else:
        with _dynamic_overwrite(df.sparkSession):
            there = df.sparkSession.table(spec.name).columns  # insertInto goes by position
            rows.select(*[f"`{c}`" for c in there]).write.insertInto(spec.name, overwrite=True)


def append_partition(
    df: DataFrame,
    spec: TableSpec,
    ds: str,
    path: str | None = None,
    cluster_by: Sequence[str] | None = None,
    token: str | None = None,
) -> None:
    """Add rows to one day. Running it again adds them again: prefer `write_partition`, or a table
    `by_run`. There a run is named by `token`, letters, digits and dashes, the same whenever it is tried
    again: it then replaces its own rows, and those of other runs stay."""
    day = RunDate.parse(ds).ds
    rows = laid_out(df, spec, cluster_by)
    if spec.by_run:
        if not re.fullmatch(r"[A-Za-z0-9-]+", token or ""):
            raise ValueError("a run needs a token of letters, digits and dashes")
        into = "OVERWRITE", f"ds = '{day}', run = '{token}'"
    else:
        into = "INTO", f"ds = '{day}'"
    if path and spec.by_run:
        table_writer(rows, spec).mode("overwrite").save(f"{path}/ds={day}/run={token}")
    elif path:
        table_writer(rows, spec).mode("append").save(f"{path}/ds={day}")
    else:
        df.sparkSession.sql(
            f"INSERT {into[0]} TABLE {spec.name} PARTITION ({into[1]}) BY NAME SELECT * FROM {{rows}}",
            rows=rows,
        )


def _write_buckets(rows: DataFrame, spec: TableSpec, day: str) -> None:
    # by dynamic overwrite, which may read other days of its target but leaves a day without new rows
    spark, seen = rows.sparkSession, Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n")).withColumn("ds", F.lit(day))
    with _dynamic_overwrite(spark):
        there = spark.table(spec.name).columns
        rows.select(*[f"`{c}`" for c in there]).write.insertInto(spec.name, overwrite=True)
    if not seen.get["n"]:
        spark.sql(f"ALTER TABLE {spec.name} DROP IF EXISTS PARTITION (ds = '{day}')")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """`insertInto` ignores the writer's option; without the setting it would clear every day."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_path(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The days written under a path; the given schema keeps `ds` a string."""
    return spark.read.schema(_with_ds(spec)).format(spec.fmt).load(path)


def laid_out(df: DataFrame, spec: TableSpec, cluster_by: Sequence[str] | None) -> DataFrame:
    """The columns of `spec`, gathered by `cluster_by` if it is given."""
    rows = conform(df, spec.schema)
    return rows if cluster_by is None else rebalance(rows, *cluster_by)


def _buckets(spec: TableSpec) -> str:
    if not spec.buckets:
        return ""
    by = ", ".join(f"`{c}`" for c in spec.bucket_by)
    return f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {spec.buckets} BUCKETS"


def _with_ds(spec: TableSpec) -> T.StructType:
    parts = ["ds", "run"] if spec.by_run else ["ds"]
    return T.StructType([*spec.schema.fields, *[T.StructField(p, T.StringType()) for p in parts]])


def table_writer(rows: DataFrame, spec: TableSpec):
    return rows.write.format(spec.fmt).option("compression", spec.compression)


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
