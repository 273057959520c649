"""Aggregates with explicit defaults, and argmax rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def max_or(df: DataFrame, column: str, default: Column, alias: str) -> DataFrame:
    """Global maximum, or the default when there are no rows."""
    return df.agg(F.coalesce(F.max(column), default).alias(alias))


def group_max(df: DataFrame, by: list[str], column: str, alias: str, default: Column | None = None) -> DataFrame:
    top = F.max(column)
    return df.groupBy(*by).agg((top if default is None else F.coalesce(top, default)).alias(alias))


def group_count(df: DataFrame, by: list[str], alias: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(alias)).orderBy(*by)


def distinct_count(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias(alias))


def argmax_rows(df: DataFrame, column: str) -> DataFrame:
    """All rows that hold the maximum, ties included."""
    top = df.agg(F.max(column).alias("m")).scalar()
    return df.where(F.col(column) == top)


def profile(df: DataFrame, table: str) -> DataFrame:
    """Row count, distinct values and nulls per column, in one pass over the rows.

    Values are counted per (column, value) before they are counted per
    column, so no task holds all values of a column.
    """
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in df.columns])
        ).alias("p")
    ).select("p.column_name", "p.v")
    counted = pairs.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.count("v").alias("distinct_count"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
    ).withColumn("table_name", F.lit(table))
