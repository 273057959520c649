"""Neighbouring rows, latest rows and top rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.compare import any_null
from tidemark.functions.ranges import bucket_of, hot_keys, split_points


def neighbour(
    df: DataFrame,
    partition_by: list[str],
    order_by: list[str],
    value: str,
    alias: str,
    step: int = 1,
    points_from: DataFrame | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``lead(value)`` (``step=1``) or ``lag(value)`` (``step=-1``) per key.

    The rows of a hot key are not gathered in one task: the order columns are
    cut into even ranges and a hot key's window runs per (key, range), with
    one extra row per range that stands for the edge of the key's next (or
    previous) range.  (key, order) must be unique; a (key, range) group then
    holds at most about one bucket of all rows.  The ranges come from
    ``points_from`` when given, e.g. a cheaper frame with the same order
    columns; they never change the result.  Hot keys are counted on
    ``hot_from`` when given, a cheaper frame with the same keys.
    """
    if step not in (1, -1):
        raise ValueError("step must be 1 or -1")
    near = F.lead if step == 1 else F.lag
    hot = hot_keys(df if hot_from is None else hot_from, partition_by, nulls=True)
    if hot is None:
        return df.withColumn(alias, near(value).over(Window.partitionBy(*partition_by).orderBy(*order_by)))
    points = split_points(points_from if points_from is not None else df, order_by)
    marks = hot.select(*[F.col(c).alias(f"_hot_{c}") for c in partition_by], F.lit(True).alias("_hot"))
    same = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in partition_by]
    marked = df.join(F.broadcast(marks), same, "left")
    range_of = F.when(F.col("_hot"), bucket_of(df, order_by, points)).otherwise(F.lit(0))
    rows = marked.select(*df.columns, range_of.alias("_slice"), F.col("_hot"), F.lit(False).alias("_edge"))
    edges = _edges(rows.where("_hot"), partition_by, order_by, value, step)
    rows = rows.drop("_hot").unionByName(edges, allowMissingColumns=True)
    w = Window.partitionBy(*partition_by, "_slice").orderBy(*order_by)
    return rows.withColumn(alias, near(value).over(w)).where("NOT _edge").drop("_slice", "_edge")


def _edges(rows: DataFrame, partition_by: list[str], order_by: list[str], value: str, step: int) -> DataFrame:
    """The first (``step=1``) or last row of each (key, range), moved to the key's neighbouring range."""
    fields = list(dict.fromkeys([*order_by, value]))
    outermost = F.min if step == 1 else F.max
    neighbour_range = F.lag if step == 1 else F.lead
    edges = rows.groupBy(*partition_by, "_slice").agg(outermost(F.struct(*fields)).alias("_row"))
    to = neighbour_range("_slice").over(Window.partitionBy(*partition_by).orderBy("_slice"))
    edges = edges.withColumn("_slice", to).where("_slice IS NOT NULL")
    moved = [F.col(f"_row.{f}").alias(f) for f in fields if f not in partition_by]
    return edges.select(*partition_by, "_slice", *moved, F.lit(True).alias("_edge"))


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """One row per key: the first by ``order_by``, which must be a total order.

    Spark keeps at most one row per key and map task before the shuffle
    (window group limit).  Rows with a null in the key are different unknown
    keys: all of them are kept, equal ones too, and they pass by the window.
    """
    unknown = any_null(keys)
    w = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.where(~unknown).withColumn("_rn", F.row_number().over(w))
    return ranked.where("_rn = 1").drop("_rn").unionByName(df.where(unknown))


def top_rank(df: DataFrame, partition_by: list[str], order_by: list[Column]) -> DataFrame:
    """All rows that rank first in their group, ties included."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rank", F.rank().over(w)).where("_rank = 1").drop("_rank")


def top_one(df: DataFrame, partition_by: list[str], order_by: list[Column]) -> DataFrame:
    """The first row of each group."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
