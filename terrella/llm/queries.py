"""Queries of this subpackage: each applies one operator to its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrella.llm import (
    common,
    decontam,
    fingerprints,
    langid,
    lexical,
    manifest,
    mixing,
    near_dedup,
    ngram_lm,
    oracles,
    packing,
    pii,
    secrets,
    sharding,
    substring_dedup,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return common.prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    """Path and word pattern of the tokenizer that packing uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), *tokenizer())


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, folder, "documents"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data_digest(table(spark, folder, "documents"))


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets_digest(table(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify_language(table(spark, folder, "documents"))


def op7_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score_documents(table(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards_digest(table(spark, folder, "documents"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.manifest_digest(table(spark, folder, "documents"))


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_digest(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to function of (session, data folder), by operator number."""
    return {
        f.__name__: f
        for f in (
            op1_substring_dedup,
            op2_best_fit_packing,
            op3_fingerprints,
            op4_pii,
            op5_secrets,
            op6_language_id,
            op7_ngram_lm,
            op8_sharding,
            op9_near_dedup,
            op10_decontamination,
            op11_lexical_search,
            op12_merkle_manifest,
            op13_mixing,
        )
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested by brute force in tests/llm."""
    return {
        "op11_lexical_search": oracles.OP11,
        "op12_merkle_manifest": oracles.OP12,
        "op13_mixing": oracles.OP13,
    }
