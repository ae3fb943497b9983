"""Registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokoledger.llm import bpe, divergence, fill_in_middle, langid, license_digest, packing, pivots, segments, simhash, token_count, url_reputation
from tokoledger.llm import quality as lines
from tokoledger.llm import toxicity as toxic
from tokoledger.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dedup(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.url_reputation(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.license_scan(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), holdout=0, parts=5)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_top_k(table(spark, sf_dir, "embeddings"), queries="vec_id % 50 = 0", k=5, scale=256)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"), holdout=2, parts=4)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, public_tokenizers.PATTERN, capacity=1024, end_id=0)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.embedding_near_dedup(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests come from the operator's output and from the text restored from it."""
    cut = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=1, percent=90, spm_percent=20)
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), holdout=1, parts=3)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"), least=3, most=200)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_simhash, op2_url_filter, op3_license_scan, op4_token_counts, op5_toxicity,
        op6_exact_top_k, op7_bpe, op8_language_id, op9_packing, op10_embedding_dedup,
        op11_fill_in_middle, op12_quality, op13_source_divergence,
    )
    return {f.__name__: f for f in every}


TOP_K_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.k, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.k <> c.k AND len(q.v) = len(c.v))
SELECT query_id, (row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score::BIGINT AS score
FROM scored QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    """Only what SQL can express; tests/llm holds the others against plain Python."""
    return {
        "op2_url_filter": url_reputation.oracle(),
        "op3_license_scan": license_digest.oracle(),
        "op6_exact_top_k": TOP_K_SQL,
        "op11_fill_in_middle": fill_in_middle.ORACLE,
        "op13_source_divergence": divergence.ORACLE,
    }
