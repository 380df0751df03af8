"""The queries of the operators, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from priceflow.llm import alignment, decontam, divergence, line_dedup, merkle, mixing, near_dup, packing, pii, quality_bayes, secrets, simple8b, warc

#: Files of the public tokenizers, found by their name on every executor.
WORDS, BYTES, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bayes.op1_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.op2_rules(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.op3_near_duplicates(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op4_lines(table(spark, sf_dir, "documents"))


def op5_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.op5_tokens(table(spark, sf_dir, "documents"), WORDS)


def op6_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op6_archives(table(spark, sf_dir, "pages"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.op7_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op8_packing(table(spark, sf_dir, "documents"), BYTES)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op9_secrets(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op10_personal_data(table(spark, sf_dir, "documents"))


def op11_capped_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op11_mixture(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.op12_alignment(table(spark, sf_dir, "documents"), BYTES, PIECES)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.op13_proofs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_divergence_rules": op2_divergence_rules,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_simple8b_tokens": op5_simple8b_tokens,
    "op6_warc_normaliser": op6_warc_normaliser,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_secret_scan": op9_secret_scan,
    "op10_personal_data": op10_personal_data,
    "op11_capped_mixture": op11_capped_mixture,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}
