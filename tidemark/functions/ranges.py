"""Ordered buckets: split points from a sample, looked up per row.

Results never depend on which points were drawn; they only decide how evenly
the rows spread.  The bucket of a row is a function of its own values, so it
is the same however often a task is run again.

``ranged`` cuts all rows of a table, into as many ranges as they need.
``split_points`` and ``bucket_of`` cut the rows of hot keys, of which there
are few, into at most ``MAX_BUCKETS``.
"""

from __future__ import annotations

from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.sizing import fits_broadcast
from tidemark.session import materialize

MAX_BUCKETS = 4096
ROWS_PER_BUCKET = 1_000_000
SAMPLED_ROWS = 1_000_000
SAMPLED_ROWS_PER_BUCKET = 16
FAN = 64


RANGE = "_range_bucket"
COARSE_BITS = 32


def ranged(df: DataFrame, order_by: list[str], written: bool = False) -> DataFrame | None:
    """``df`` with ``_range_bucket``, a number that rises with ``order_by`` (nulls first); None if one task can sort all.

    One range holds what one task should sort.  Rows are cut in two
    levels: coarse ranges, the square root of all of them, by points that the
    driver holds; and fine ones inside each by points that are rows of a table,
    joined by the coarse number (broadcast behind a size check).  The input is
    written once before anything but its rows are counted (``written``: it
    is), so that a source that changes cannot come in between.
    """
    buckets = -(-df.count() // ROWS_PER_BUCKET)
    if buckets < 2:
        return None
    rows = df if written else materialize(df, "ranged")
    total = max(rows.count(), 1)
    coarse = isqrt(buckets - 1) + 1
    fine = ceil(buckets / coarse)
    key = F.struct(*[F.col(c).alias(c) for c in order_by])
    keys = rows.select(key.alias("_key"))
    firsts = _coarse_points(keys, coarse, total).scalar().alias("_firsts")
    number = _bisect(F.col("_firsts"), F.col("_key"), coarse).alias("_coarse")
    named = rows.select(*rows.columns, key.alias("_key"), firsts).select(*rows.columns, "_key", number)
    cuts = _fine_points(keys.select("_key", firsts).select("_key", number), fine, buckets, total)
    cuts = materialize(cuts, "range-points")
    met = named.join(F.broadcast(cuts) if fits_broadcast(cuts) else cuts, "_coarse", "left")
    at = F.coalesce(_bisect(F.col("_cuts"), F.col("_key"), fine), F.lit(0))
    return met.withColumn(RANGE, F.col("_coarse").cast("long") * (1 << COARSE_BITS) + at).drop("_coarse", "_key", "_cuts")


def _coarse_points(keys: DataFrame, ranges: int, total: int) -> DataFrame:
    """Keys that cut all rows into about even ranges, as one array in one row; the driver sees 16 for each range."""
    drawn = keys.sample(fraction=min(1.0, ranges * SAMPLED_ROWS_PER_BUCKET / total), seed=11)
    found = [r[0] for r in drawn.distinct().orderBy("_key").collect()]
    picked = sorted({int(i * len(found) / ranges) for i in range(1, ranges)} - {0}) if found else []
    shape = T.StructType([T.StructField("_firsts", T.ArrayType(keys.schema["_key"].dataType))])
    return keys.sparkSession.createDataFrame([([found[i] for i in picked],)], shape)


def _fine_points(keys: DataFrame, ranges: int, buckets: int, total: int) -> DataFrame:
    """``_coarse, _cuts``: keys that cut each coarse range evenly, from a sample that stays distributed."""
    drawn = keys.sample(fraction=min(1.0, buckets * SAMPLED_ROWS_PER_BUCKET / total), seed=12).distinct()
    within = Window.partitionBy("_coarse")
    drawn = drawn.withColumn("_nth", F.row_number().over(within.orderBy("_key"))).withColumn("_of", F.count(F.lit(1)).over(within))
    step = lambda n: F.floor(n * ranges / F.col("_of"))
    picked = drawn.where((step(F.col("_nth")) > step(F.col("_nth") - 1)) & (F.col("_nth") < F.col("_of")))
    return picked.groupBy("_coarse").agg(F.sort_array(F.collect_list("_key")).alias("_cuts"))


def _bisect(points: Column, key: Column, most: int) -> Column:
    """How many of the sorted points, ``most`` or fewer, are not above the key: halving steps."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(most, 1).bit_length()))])

    def step(low: Column, by: Column) -> Column:
        there = low + by <= F.size(points)
        return F.when(there & (F.element_at(points, F.least(low + by, F.size(points))) <= key), low + by).otherwise(low)

    return F.when(F.size(points) > 0, F.aggregate(steps, F.lit(0), step)).otherwise(F.lit(0))


def running(totals: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``_range_bucket`` and the sums of ``columns`` (``{column: alias}``) over the ranges before it.

    ``totals`` has one row per range.  Coarse ranges are summed up first, so
    no task sees more than about the square root of all ranges.  The sums are
    written: they are used beside the rows they come from.
    """
    shape = totals.withColumn("_coarse", F.shiftright(RANGE, COARSE_BITS))
    whole = shape.groupBy("_coarse").agg(*[F.sum(c).alias(f"_w_{c}") for c in columns])
    earlier = Window.orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("_coarse", *[F.coalesce(F.sum(f"_w_{c}").over(earlier), F.lit(0)).alias(f"_w_{c}") for c in columns])
    inside = Window.partitionBy("_coarse").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    both = shape.join(whole, "_coarse")
    sums = both.select(RANGE, *[(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_w_{c}")).alias(alias) for c, alias in columns.items()])
    return materialize(sums, "range-starts")


def bucket_count(rows: int) -> int:
    """Enough buckets for one task each; 1 while a single task can hold all rows."""
    return max(1, min(MAX_BUCKETS, -(-rows // ROWS_PER_BUCKET)))


def split_points(df: DataFrame, order_by: list[str], seed: int = 11) -> list[tuple]:
    """Sorted key tuples that cut ``df`` into even ranges; none for a small frame.

    At most ``MAX_BUCKETS * SAMPLED_ROWS_PER_BUCKET`` keys, give or take the
    sampling error, reach the driver.
    """
    keys = df.select(*order_by)
    total = keys.count()
    buckets = bucket_count(total)
    if buckets < 2:
        return []
    wanted = buckets * SAMPLED_ROWS_PER_BUCKET
    if total > wanted:
        keys = keys.sample(fraction=wanted / total, seed=seed)
    rows = [tuple(r) for r in keys.distinct().orderBy(*order_by).collect()]
    step = len(rows) / buckets
    picked = {int(i * step): None for i in range(1, buckets)} if rows else {}
    return [rows[i] for i in picked if i > 0]


def hot_keys(df: DataFrame, on: list[str], nulls: bool = False) -> DataFrame | None:
    """Keys with more rows than a fair share of one task, or None.

    Counted on a sample, so a key near the limit may be missed or included;
    callers give the same result either way.  At most ``MAX_BUCKETS`` keys can
    exceed the share, which bounds the result.
    """
    keys = df.select(*on) if nulls else df.select(*on).dropna()
    total = keys.count()
    share = max(total / MAX_BUCKETS, ROWS_PER_BUCKET)
    if total <= share:
        return None
    fraction = min(1.0, SAMPLED_ROWS / total)
    if fraction < 1.0:
        keys = keys.sample(fraction=fraction, seed=5)
    rows = keys.groupBy(*on).count().where(F.col("count") > share * fraction).drop("count").collect()
    return df.sparkSession.createDataFrame(rows, keys.schema) if rows else None


def _literal(value: object, field: T.StructField) -> Column:
    if value is not None and isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = str(value)
    return F.lit(value).cast(field.dataType).alias(field.name)


def bucket_of(df: DataFrame, order_by: list[str], points: list[tuple]) -> Column:
    """Bucket number of a row, rising with ``order_by`` (nulls first).

    Two short scans over the points: first over every 64th, then within the
    chosen run.
    """
    if not points:
        return F.lit(0)
    fields = [df.schema[c] for c in order_by]
    here = F.struct(*[F.col(c).alias(c) for c in order_by])

    def as_array(rows: list[tuple]) -> Column:
        return F.array(*[F.struct(*[_literal(v, f) for v, f in zip(row, fields)]) for row in rows])

    def below(rows: Column) -> Column:
        return F.size(F.filter(rows, lambda p: p <= here))

    if len(points) <= FAN:
        return below(as_array(points))
    runs = [points[i : i + FAN] for i in range(0, len(points), FAN)]
    coarse = below(as_array([run[0] for run in runs[1:]]))
    return coarse * FAN + below(F.element_at(F.array(*[as_array(run) for run in runs]), coarse + 1))
