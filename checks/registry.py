"""Queries by name, and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger import RunDate
from dayledger.functions import format_ds

RUN = RunDate.parse("19980630")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one directory, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, df)  # the footer is read once per query
        return df

    @property
    def daily(self) -> DataFrame:
        """lineitem with its ship day as `ds`."""
        return self.lineitem.withColumn("ds", format_ds("l_shipdate"))

    @property
    def rated(self) -> DataFrame:
        """orders with the digit of the priority as a code, and a flag and a text that are NULL
        for status P."""
        known = F.col("o_orderstatus") != "P"
        return self.orders.withColumns({
            "code": F.substring("o_orderpriority", 1, 1).cast("int"),
            "maybe_done": F.when(known, F.col("o_orderstatus") == "F"),
            "maybe_status": F.when(known, F.col("o_orderstatus")),
        })


# The same two views for the SQL side.
DAILY = "daily AS (SELECT *, strftime(l_shipdate, '%Y%m%d') AS ds FROM lineitem)"
RATED = """rated AS (
    SELECT *, CAST(left(o_orderpriority, 1) AS INTEGER) AS code,
           CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS maybe_done,
           nullif(o_orderstatus, 'P') AS maybe_status
    FROM orders)"""


def query(sql: str, name: str | None = None):
    """Register a query on `Tables` under its function's name, with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        ORACLES[key] = sql
        return build

    return register
