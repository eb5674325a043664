"""Where each role a job reads comes from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Catalog:
    """Maps a role name to a catalog table (`namespace.table`), a path, or a ready DataFrame. `sketches` are
    kept key sketches (`sketch_days`) of the relations that jobs make from the tables."""

    def __init__(
        self, spark: SparkSession, tables: Mapping[str, str | DataFrame], fmt: str = "orc", sketches: DataFrame | None = None
    ):
        self.spark = spark
        self.tables = dict(tables)
        self.fmt = fmt
        self.sketches = sketches
        self._kept: set[tuple[str, str, str]] | None = None

    def sketch(self, relation: str, keys: Sequence[str], days: Sequence[str]) -> DataFrame | None:
        """The kept sketches of a relation's days, or nothing unless every day has one."""
        if self.sketches is None:
            return None
        if self._kept is None:  # names and days alone
            self._kept = {tuple(r) for r in self.sketches.select("relation", "keys", "ds").distinct().collect()}
        named = ",".join(keys)
        if not all((relation, named, ds) in self._kept for ds in days):
            return None
        own = (F.col("relation") == relation) & (F.col("keys") == named) & F.col("ds").isin(*days)
        # a day that was kept twice counts once, a day without rows not at all
        return self.sketches.where(own & (F.col("n") > 0)).dropDuplicates(["ds"]).select("n", "sketch")

    def table(self, role: str) -> DataFrame:
        if role not in self.tables:
            raise KeyError(f"no table is mapped to {role!r}")
        source = self.tables[role]
        if isinstance(source, DataFrame):
            return source
        if "/" not in source:
            return self.spark.table(source)
        return text_ds(self.spark.read.format(self.fmt).load(source))

    def has(self, role: str) -> bool:
        return role in self.tables


def text_ds(df: DataFrame) -> DataFrame:
    """A path partition ds=19980630 may be read as a number; the cast still prunes partitions."""
    if "ds" in df.columns and df.schema["ds"].dataType.typeName() != "string":
        return df.withColumn("ds", F.col("ds").cast("string"))
    return df


def constant_row(spark: SparkSession, **cols: str | int | bool) -> DataFrame:
    """One row of constants, whole numbers as BIGINT. An inline table rather than literals in a
    select: a literal would be folded out of a join's key and leave a nested loop."""
    values = [
        f"CAST(:{name} AS BIGINT)" if type(value) is int else f":{name}" for name, value in cols.items()
    ]
    names = ", ".join(f"`{name}`" for name in cols)
    return spark.sql(f"SELECT * FROM VALUES ({', '.join(values)}) AS t({names})", args=cols)
