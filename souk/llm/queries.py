"""The operators applied to the whole given tables, one query each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import (
    alignment, bpe, embeddings, langid, lexical, licenses, minhash, packing, quality_model, quality_rules, scoring, secrets, suffix,
)
from souk.llm.common import ship


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "documents")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(given(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_documents(documents(spark, sf_dir))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = given(spark, sf_dir, "labels")
    return quality_model.sample_by_importance(documents(spark, sf_dir), labels)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.quality_verdicts(documents(spark, sf_dir))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(documents(spark, sf_dir), given(spark, sf_dir, "benchmark"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_path, piece_path = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(documents(spark, sf_dir), byte_path, piece_path)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_language_id": op2_language_id,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_packing": op5_packing,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality_model": op7_quality_model,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_secrets": op10_secrets,
    "op11_lexical_search": op11_lexical_search,
    "op12_alignment": op12_alignment,
    "op13_license_scan": op13_license_scan,
}
