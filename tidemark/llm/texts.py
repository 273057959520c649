"""Small helpers that all text operators share."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.sizing import fits_broadcast


#: Where this package lies.
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; workers on this machine find the package where the driver has it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stands for a null id inside Python tasks, where pandas would turn the column to floats.
NO_ID = -(1 << 63)


def only_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (null: empty), whatever else the table holds."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def for_python(docs: DataFrame) -> DataFrame:
    """As :func:`only_texts`, with ids that are never null; :func:`id_back` undoes that."""
    return only_texts(docs).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))


def id_back(column: str = "doc_id") -> Column:
    return F.nullif(F.col(column), F.lit(NO_ID)).alias(column)


def small_side(rows: DataFrame) -> DataFrame:
    """Marked for broadcast if it passes the size check; else the join shuffles."""
    return F.broadcast(rows) if fits_broadcast(rows) else rows


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an id's decimal text, as the folds use it."""
    return F.crc32(F.col(column).cast("string"))


def partitions(spark: SparkSession) -> int:
    """The session's own setting, which is sized with the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded(frames: Iterator[pd.DataFrame], column: str, limit: int) -> Iterator[pd.DataFrame]:
    """Cut frames into pieces whose texts hold about ``limit`` characters; a longer text stands alone."""
    for frame in frames:
        start, held = 0, 0
        for i, size in enumerate(frame[column].str.len().to_numpy()):
            if held and held + size > limit:
                yield frame.iloc[start:i]
                start, held = i, 0
            held += size
        if start < len(frame):
            yield frame.iloc[start:]
