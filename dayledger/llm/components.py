"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.operators.sizing import TASK_BYTES
from dayledger.sinks.staging import stage

EDGE_BYTES = 64  # of an edge in a task that sorts it, roughly


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node in `edges` (a, b: long), which is read
    several times: give it a scan or a staged result.

    Large-star and small-star steps alternate until every edge leads from a node to its component; the
    number of rounds grows with the logarithm of the longest path. Each round is written to the shared
    folder, in as many files as its edges need: they are few beside the rows a session's shuffles are
    set for.
    """
    spark = edges.sparkSession
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        count, done = _told(current)
        if done:
            break
        parts = max(spark.sparkContext.defaultParallelism, -(-count * EDGE_BYTES // TASK_BYTES))
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.union(low.where("low < a")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        current = stage(small.union(low).distinct().coalesce(parts), "edges")
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(current.select("b", "b")).distinct()


def _told(edges: DataFrame) -> tuple[int, bool]:
    """How many edges (a, b: a > b) there are, and whether each node has one end only: that of its
    component's smallest, or its own."""
    ends = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("b")))).alias("e")).select("e.*")
    each = ends.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.sum((F.col("b") < F.col("a")).cast("long")).alias("n"))
    told = each.agg(F.sum("n").alias("n"), F.count_if(F.col("low") < F.col("high")).alias("open")).first()
    return told["n"] or 0, not told["open"]
