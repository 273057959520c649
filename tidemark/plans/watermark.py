"""Incremental load marks: read, reset, advance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.spec import START_OF_TIME, SyncRow


def current(row: SyncRow) -> Column:
    """The watermark a load starts from: the stored one, or 1900-01-01 for a full load."""
    since = row.watermark if row.incremental else START_OF_TIME
    return F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")


def advance(control: DataFrame, extracted: DataFrame, table: str, change_column: str) -> DataFrame:
    """Control rows with the table's watermark set to the highest change value extracted.

    Taken from the rows, not from the clock, so rows that change during the
    load are picked up by the next one.  An empty extract leaves the mark.
    """
    seen = extracted.agg(F.max(change_column).alias("m")).scalar()
    value = F.coalesce(F.date_format(seen, "yyyy-MM-dd HH:mm:ss.SSS"), F.col("WatermarkValue"))
    return control.withColumn(
        "WatermarkValue", F.when(F.col("TableName") == table, value).otherwise(F.col("WatermarkValue"))
    )


def reset(control: DataFrame, table: str | None = None) -> DataFrame:
    """Control rows with the watermark back at the start of time."""
    start = F.lit(START_OF_TIME.strftime("%Y-%m-%d %H:%M:%S.000"))
    hit = F.lit(True) if table is None else F.col("TableName") == table
    return control.withColumn("WatermarkValue", F.when(hit, start).otherwise(F.col("WatermarkValue")))
