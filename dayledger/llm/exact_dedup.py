"""Exact dedup by a tree merge of sorted digest runs, in DataFrame functions only.

Every input partition makes a run: its digests in order, each with its count and the identifier it
keeps. In each round the runs of FAN_IN neighbouring partitions meet and are merged; a round's
exchange is keyed by the node and the digest, so one node's merge is itself spread over tasks and a
digest with very many copies arrives as one row per run. `max` over a struct makes Spark aggregate by
sorting, on both sides of the exchange: the runs are sorted runs.

Two things differ from a binomial merge of runs in place. DataFrame functions cannot hand a sorted run to
another task, so a round deals digests by hash and sorts what arrives; and since the digests without a
copy move in every round, FAN_IN partitions meet at a time instead of two: log8 rounds, not log2.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.operators.sizing import checked_broadcast
from dayledger.sinks.staging import stage

FAN_IN = 8
GONE_BYTES = 32 << 20  # of what goes: a broadcast takes some times that in the driver
KEY = ["text_sha256", "n_bytes", "check"]  # equal digests with another length or check hash stay apart


def normalised(text: str = "text") -> Column:
    """The text with A-Z, and nothing else, in lower case; null is the empty text."""
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the key of each row's normalised text and its partition, written to the shared folder."""
    texts = docs.select(F.col("doc_id").cast("long"), normalised().alias("text"))
    return stage(texts.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text").alias("check"),
        F.spark_partition_id().alias("node"),
    ), "digests")


def merged_runs(rows: DataFrame) -> DataFrame:
    """One row per distinct key: keep (struct of the largest doc_id) and group_size."""
    nodes = (rows.agg(F.max("node")).first()[0] or 0) + 1
    runs = rows.select(*KEY, "node", F.struct("doc_id").alias("keep"), F.lit(1).cast("long").alias("group_size"))
    while True:
        nodes = -(-nodes // FAN_IN)
        node = F.floor(F.col("node") / FAN_IN).cast("int").alias("node")
        runs = runs.groupBy(node, *KEY).agg(F.max("keep").alias("keep"), F.sum("group_size").alias("group_size"))
        if nodes == 1:
            return runs.drop("node")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs` (doc_id, text).

    Equal texts (see `normalised`) form a group; its largest doc_id is kept. Rows that repeat both id
    and text are all kept or all dropped; a null id is kept only where its group has no other. Other
    columns are not read. No rows give no rows.
    """
    rows = digests(docs)
    # written down, so that the join below is between two scans and a hot digest can be split
    groups = stage(merged_runs(rows).where("group_size > 1").select(*KEY, F.col("keep.doc_id").alias("_keep"), F.col("group_size").alias("_size")), "runs")
    keep = F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_keep"))
    return rows.join(groups, KEY, "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of `docs` per text, with all its columns: that of the largest doc_id. Of rows that share
    id and text too, any one. What goes is broadcast where it was measured to fit, so that the documents
    are not shuffled to drop a few."""
    marked = exact_dedup(docs).groupBy("doc_id", "text_sha256", "kept").agg(F.count("*").alias("rows"))
    marked = stage(marked.where("NOT kept OR rows > 1").withColumn("sha256", F.unhex("text_sha256")), "marked")
    # the rows of `docs` travel whole, in one column, so that no name of theirs can clash
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.unhex(F.sha2(normalised(), 256)).alias("digest"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("digest") == F.col("sha256"))
    gone, again = (marked.where(which).select("doc_id", "sha256") for which in ("NOT kept", "kept"))
    out = rows.join(checked_broadcast(gone, GONE_BYTES), same, "left_anti")
    if not again.isEmpty():
        repeated = out.join(again, same, "left_semi").dropDuplicates(["id", "digest"])
        out = out.join(again, same, "left_anti").unionByName(repeated)
    return out.select("row.*")
