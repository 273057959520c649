"""Raw documents to packed training sequences: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, jaccard, packing, toxicity
from tidemark.llm.queries import BYTE_BPE
from tidemark.llm.texts import table
from tidemark.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that similar shingle sets link, the one with the smallest id stays."""
    return jaccard.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    return packing.pack(docs, BYTE_BPE, end_id=0, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", one_of_similar),
    ("benchmark_decontamination", uncontaminated),
    ("best_fit_packing", packed),
]

#: Scores of a trained network cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
