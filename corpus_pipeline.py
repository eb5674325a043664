"""The training-data pipeline: five stages over `documents`, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dayledger.llm import exact_dedup, language, near_dedup, packing, quality
from dayledger.sinks.staging import stage

ORACLE_SQL = None  # language, quality and ids of a tokenizer are not for SQL


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is mostly in one learned language; texts without a letter go."""
    return language.with_language(docs, language.learn(docs.where(language.in_training())))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer learned from the labellers' posteriors takes for good."""
    return quality.good_texts(docs, quality.learn(docs))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.deduplicated(docs)


def unlike_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_dedup.deduplicated(docs, near_dedup.Settings(size=5))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, and where they lie in sequences of 4096 tokens."""
    # the workers hold what the stages before needed too, so they remember less text here
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, remembered=48 << 20)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("quality", good_quality),
    ("exact_dedup", distinct_texts),
    ("near_dedup", unlike_texts),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"stage-{name}")
    return docs
