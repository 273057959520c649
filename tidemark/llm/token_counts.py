"""Token counts through a digest cache: only texts that no run has counted are encoded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import encoder
from tidemark.llm.texts import bounded, only_texts

CACHE = "digest string, tokenizer string, n_tokens long"
#: Characters encoded in one call.
BATCH = 8_000_000


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; none where nothing has been written yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def _counter(content: bytes, model: bool, tokenizer: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder.encoder(content, model)
        size = coder.dtype.itemsize
        for frame in bounded(frames, "text", BATCH):
            counts = [len(x) // size for x in coder.encode(frame["text"].tolist())]
            yield pd.DataFrame({"digest": frame["digest"].to_numpy(), "tokenizer": tokenizer, "n_tokens": counts})

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = 2048) -> DataFrame:
    """One row per table row: ``doc_id, n_bytes, n_tokens, over_limit``.

    A text (null: empty) is known by the SHA-256 of its bytes together with a
    digest of the vocabulary and the library's version, so a new tokenizer
    never meets old counts.  Misses are reduced to one text per digest before
    the shuffle, encoded, and appended to the cache in ``cache_path``; then
    every row takes its count from the cache.  A hot text is one row there,
    and Spark splits the rows that join it.  Repeated rows and ids come back
    as often as they are given, null ids included; an empty table gives none.
    A run that dies leaves the cache as it was or with whole new counts; counts
    written twice by runs at the same time agree, and one is used.
    """
    spark = docs.sparkSession
    content = encoder.load(tokenizer_path)
    version = encoder.version(tokenizer_path, content)
    digested = only_texts(docs).withColumn("digest", F.sha2(F.col("text"), 256))
    known = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    misses = (
        digested.join(known, "digest", "left_anti")
        .groupBy("digest")
        .agg(F.first("text").alias("text"))
        .mapInPandas(_counter(content, tokenizer_path.endswith(".model"), version), CACHE)
    )
    misses.write.mode("append").parquet(cache_path)
    counts = read_cache(spark, cache_path).where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return digested.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest").join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
