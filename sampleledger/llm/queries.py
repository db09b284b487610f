"""The operators of this subpackage as registered queries, with equal SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleledger.llm import bpe, divergence, embedding_dedup, langid, licenses, mixing, oracles, sharding, simhash, spelling, suffix_dedup, topk, toxicity, warc
from sampleledger.llm.common import table

SHARDS = 8
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleaved(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs.select("doc_id", "text"), model)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.notices(table(spark, sf_dir, "documents"))


def op5_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, digest=True).drop("text")


def op8_byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predicted(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(found.fp).alias("fingerprint"), "component_id")


def op10_target_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixture(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "shards")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents"))


def op13_warc_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_stratified_shards, op2_weak_toxicity, op3_bucket_refinement, op4_license_notices, op5_collision_counting, op6_threshold_top_k,
            op7_byte_bpe, op8_byte_gru_language, op9_covering_simhash, op10_target_mixture,
            op11_source_divergence, op12_spelling_variants, op13_warc_chains,
        )
    }


def oracle_sql() -> dict[str, str]:
    """The others rest on trained models, hashes or tokens that SQL lacks, or are too slow in it."""
    return {
        "op1_stratified_shards": oracles.SHARDS,
        "op4_license_notices": oracles.NOTICES,
        "op5_collision_counting": oracles.LINKS,
        "op6_threshold_top_k": oracles.TOP,
        "op11_source_divergence": oracles.DIVERGENCE,
        "op12_spelling_variants": oracles.VARIANTS,
        "op13_warc_chains": oracles.ARCHIVED,
    }
