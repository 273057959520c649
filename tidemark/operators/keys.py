"""Contiguous numbering without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranges import RANGE, ranged, running
from tidemark.functions.sizing import fits_broadcast

FIRST_SURROGATE = 1000


def number_rows(df: DataFrame, order_by: list[str], alias: str, after: Column | int = 0, written: bool = False) -> DataFrame:
    """Add ``alias`` = ``after`` + 1, + 2, ... in ``order_by`` order.

    Equal to ``row_number() over (order by ...)``, but the rows are cut into
    ordered ranges (``ranges.ranged``) that are numbered in parallel and
    shifted by the sizes of the ranges before them.  ``order_by`` must be
    unique per row.  Rows that fit one task are counted only; more are written
    once and read from there, unless the caller has (``written``).
    """
    base = (after if isinstance(after, Column) else F.lit(after)).cast("bigint")
    rows = ranged(df, order_by, written)
    if rows is None:
        return df.withColumn(alias, F.row_number().over(Window.orderBy(*order_by)) + base)
    starts = running(rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n")), {"_n": "_start"})
    ranked = rows.withColumn(alias, F.row_number().over(Window.partitionBy(RANGE).orderBy(*order_by)))
    placed = ranked.join(F.broadcast(starts) if fits_broadcast(starts) else starts, RANGE)
    return placed.withColumn(alias, F.col(alias) + F.col("_start") + base).select(*df.columns, alias)


def max_key(df: DataFrame | None, column: str, default: int = FIRST_SURROGATE) -> Column:
    """Highest key so far as a scalar subquery, or ``default`` when there is none."""
    if df is None:
        return F.lit(default).cast("bigint")
    return F.coalesce(df.agg(F.max(column).cast("bigint").alias("m")).scalar(), F.lit(default).cast("bigint"))


def surrogate_key(df: DataFrame, keys: list[str], alias: str = "sk", existing: DataFrame | None = None) -> DataFrame:
    """Surrogate keys continuing after the highest one in ``existing``."""
    return number_rows(df, keys, alias, max_key(existing, alias))
