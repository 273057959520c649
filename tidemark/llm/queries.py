"""The operators over the whole test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, jaccard, language, merkle, packing, phrases, quality, sharding, spelling, token_counts, token_files, toxicity
from tidemark.llm.texts import table
from tidemark.session import shared_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_repeats(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0, capacity=2048)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), WORD_BPE, shared_dir(spark, "token-counts"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents"), shards=16)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_files,
        op2_language_id,
        op3_quality_classifier,
        op4_benchmark_decontamination,
        op5_repeated_phrases,
        op6_toxicity,
        op7_exact_dedup,
        op8_best_fit_packing,
        op9_ngram_jaccard_join,
        op10_token_counts,
        op11_sharding,
        op12_spelling_variants,
        op13_merkle_manifest,
    )
}
SQL: dict[str, str] = {
    "op4_benchmark_decontamination": decontaminate.SQL,
    "op5_repeated_phrases": phrases.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op9_ngram_jaccard_join": jaccard.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
