"""Token counts through a cache keyed by digests of the content and of the tokenizer's version."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.chunks import library_encoder, sliced
from dayledger.llm.workers import in_arrow, kept
from dayledger.sinks.staging import path_exists, stage

CACHE = "tokenizer string, content binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and of its library's version."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        return hashlib.sha256(library.__version__.encode() + b"\0" + file.read()).hexdigest()


def content_digest(text: str | object):
    """Of the content as the tokenizer gets it: null is the empty text. Nothing else is normalised,
    since a change of case or white space can change a count."""
    return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))


@kept
@lru_cache(maxsize=4)
def _counter(path: str):
    """Texts -> token counts, one per Python worker."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)

        def pieces(texts: pa.Array) -> np.ndarray:
            found = model.encode([t or "" for t in texts.to_pylist()], num_threads=1)
            return np.array([len(ids) for ids in found], np.int64)

        return pieces
    encode = library_encoder(path)
    return lambda texts: np.diff(encode(texts)[1])


def counted(texts: DataFrame, path: str) -> DataFrame:
    """content, n_tokens of rows (content, text), encoded whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(count(batch.column("text")))], ["content", "n_tokens"])

    return in_arrow(texts.select("content", "text"), run, "content binary, n_tokens long", "token_counts")


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache's rows; makes an empty cache where there is none. Two runs may have added the same row."""
    if not path_exists(spark, path):
        spark.createDataFrame([], CACHE).write.mode("append").parquet(path)
    return spark.read.schema(CACHE).parquet(path)


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of `docs` (doc_id, text).

    Distinct contents that the cache at folder `cache` lacks are encoded once each and appended to it.
    The cache is read once, but for files of other tokenizers, which their statistics rule out, and only
    what is asked for goes on from there. Equal texts share a count whatever their ids; rows without
    an id and repeated rows are answered like any other. Null text counts as empty. Other columns are
    not read.
    """
    spark, version = docs.sparkSession, tokenizer_version(path)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("content", content_digest("text"))
    rows = stage(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content"), "contents")
    wanted = rows.groupBy("content").agg(F.min("doc_id").alias("of"))
    stored = open_cache(spark, cache).where(F.col("tokenizer") == version)
    hits = stage(
        stored.join(wanted, "content", "left_semi").groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "hits"
    )
    missing = wanted.join(hits, "content", "left_anti").withColumnRenamed("content", "_content")
    # one text per content: the row of its smallest id; rows that repeat both are encoded each
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("content") == F.col("_content"))
    new = stage(counted(texts.join(missing, same, "left_semi"), path).distinct(), "counted")
    new.select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache)
    counts = hits.unionByName(new)
    return rows.join(counts, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
