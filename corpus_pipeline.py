"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from touchline.llm import exact, jaccard, mixing, packing, quality
from touchline.session import fresh_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts stays: that with the largest doc_id."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of near copies stays: that with the smallest doc_id."""
    return jaccard.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out as the mix of sources takes them."""
    return mixing.take_copies(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end=1).drop("slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("packing", packed_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a directory."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
