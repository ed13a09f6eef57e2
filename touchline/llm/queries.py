"""One query per operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.llm import (
    exact,
    jaccard,
    mixing,
    negatives,
    packing,
    personal,
    quality,
    substring,
    suffix_dedup,
    tokens,
    toxicity,
    variants,
    warc,
)
from touchline.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query(
    "op10_exact_dedup",
    """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.identify(_table(spark, sf_dir, "documents")).drop("row")


@query("op1_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path, end=1).drop("slot")


@query("op5_token_files")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), tokens.token_folder(spark)
    manifest = tokens.write_token_files(_table(spark, sf_dir, "documents"), folder, path, end=0)
    return tokens.read_token_files(manifest, folder)


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select("doc_id", *names, "kept", "quality")


@query(
    "op8_warc",
    """
    WITH payload AS (
        SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
    ), last AS (
        SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM payload
    )
    SELECT page_id,
           octet_length(body) AS payload_bytes,
           sha1(body) AS payload_digest,
           CASE WHEN octet_length(body) >= 1000 AND page_id < top
                THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN octet_length(body) >= 1000 AND page_id < top THEN top END AS refers_to
    FROM last
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "archives")
    names = warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(names, folder)


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op4_ngram_jaccard")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard.link(_table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id", "kept")


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = variants.words(_table(spark, sf_dir, "documents"), change=variants.drop_letters(31))
    return variants.variants(counted)


@query(
    "op13_hard_negatives",
    """
    WITH vectors AS (
        SELECT vec_id AS id,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scores AS (
        SELECT a.id AS anchor_id, a.label AS anchor_label, v.id, v.label,
               CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
        FROM vectors a JOIN vectors v ON a.id <> v.id
        WHERE a.id % 100 = 0
    ), positives AS (
        SELECT anchor_id, anchor_label, id AS positive_id, score AS positive_score
        FROM scores
        WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT p.anchor_id, p.positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
           s.id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
    WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
    QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= 10
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find(_table(spark, sf_dir, "documents"))
