import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.functions import ranges
from tidemark.operators import keys, windows
from tidemark.operators.codes import code_table, encode


def hot_frame(spark, n=600):
    """A third of the rows share one key; some keys and values are null."""
    rng = random.Random(1)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        data.append((key, i * 7 % n, None if i % 11 == 0 else i))
    return spark.createDataFrame(data, "k string, o int, v int").repartition(4)


@pytest.mark.parametrize("step", [1, -1])
@pytest.mark.parametrize("value", ["v", "o"])
def test_neighbour_equals_window(spark, small_buckets, step, value):
    df = hot_frame(spark)
    w = Window.partitionBy("k").orderBy("o")
    expected = df.withColumn("x", (F.lead if step == 1 else F.lag)(value).over(w))
    assert rows(windows.neighbour(df, ["k"], ["o"], value, "x", step)) == rows(expected)


def test_neighbour_splits_the_hot_key(spark, small_buckets):
    df = hot_frame(spark)
    points = ranges.split_points(df, ["o"])
    sizes = df.where("k = 'hot'").groupBy(ranges.bucket_of(df, ["o"], points).alias("b")).count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 40


@pytest.mark.parametrize("split", [False, True])
def test_numbers_equal_global_row_number(spark, split, request):
    if split:
        request.getfixturevalue("small_buckets")
    df = hot_frame(spark)
    expected = df.withColumn("n", F.row_number().over(Window.orderBy("k", "o")).cast("bigint") + 1000)
    got = keys.surrogate_key(df, ["k", "o"], "n")
    assert rows(got) == rows(expected)
    assert ("SinglePartition" in plan(got)) == (not split)  # one task only while it can hold all rows


def test_numbers_continue(spark, small_buckets):
    old = spark.createDataFrame([(1500,)], "sk bigint")
    new = spark.range(100).withColumnRenamed("id", "k")
    assert [r["sk"] for r in keys.surrogate_key(new, ["k"], "sk", old).orderBy("k").collect()] == list(range(1501, 1601))
    assert keys.surrogate_key(new.limit(1), ["k"], "sk", old.limit(0)).first()["sk"] == 1001


def test_buckets_rise_with_order_over_two_levels(spark, monkeypatch):
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", 5)
    df = spark.range(2000).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    points = ranges.split_points(df, ["d"])
    assert len(points) > ranges.FAN
    bucketed = df.select("d", ranges.bucket_of(df, ["d"], points).alias("b"))
    expected = [sum(p[0] <= r["d"] for p in points) for r in bucketed.orderBy("d").collect()]
    assert [r["b"] for r in bucketed.orderBy("d").collect()] == expected


def test_a_hundred_thousand_ranges(spark, monkeypatch):
    """Ten rows a range: the driver holds the coarse points only, and no range is much fuller than the others."""
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", 10)
    df = spark.range(0, 1_000_000, 1, 8).select((F.col("id") * 7919 % 1_000_003).alias("k"))
    got = keys.number_rows(df, ["k"], "n")
    found = got.agg(F.count(F.lit(1)), F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(found) == (1_000_000, 1, 1_000_000, 1_000_000)
    ordered = got.repartitionByRange(8, "n").sortWithinPartitions("n").withColumn("p", F.spark_partition_id())
    w = Window.partitionBy("p").orderBy("n")
    assert ordered.withColumn("before", F.lag("k").over(w)).where("before >= k").isEmpty()
    sizes = ranges.ranged(df, ["k"]).groupBy(ranges.RANGE).count()
    n, largest = sizes.agg(F.count(F.lit(1)), F.max("count")).first()
    assert n > 80_000 and largest < 200


def test_ranges_take_nulls_ties_and_several_columns(spark, monkeypatch):
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", 7)
    data = [(None if i % 9 == 0 else i % 5, None if i % 4 == 0 else f"s{i % 50:02d}", i) for i in range(600)]
    df = spark.createDataFrame(data, "a int, b string, c int")
    expected = df.withColumn("n", F.row_number().over(Window.orderBy("a", "b", "c")).cast("bigint"))
    assert rows(keys.number_rows(df, ["a", "b", "c"], "n")) == rows(expected)
    cut = ranges.ranged(df, ["a"])  # no key is unique: equal keys share a range
    assert cut.groupBy("a").agg(F.count_distinct(ranges.RANGE).alias("r")).where("r > 1").isEmpty()


def test_the_source_is_read_once_after_the_count(spark, monkeypatch, tmp_path):
    """Rows that come into the source while it is numbered change nothing."""
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", 10)
    path = str(tmp_path / "growing")
    spark.range(100).write.parquet(path)
    got = keys.number_rows(spark.read.parquet(path), ["id"], "n")
    spark.range(1000, 1100).write.mode("append").parquet(path)
    assert [tuple(r) for r in got.orderBy("n").collect()] == [(i, i + 1) for i in range(100)]


def test_small_frame_needs_no_points(spark):
    assert ranges.split_points(spark.range(10), ["id"]) == []
    assert ranges.split_points(spark.range(0), ["id"]) == []


def test_top_rank_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, 0)], "g string, id int, n int")
    assert rows(windows.top_rank(df, ["g"], [F.col("n").desc()])) == [("a", 1, 1), ("a", 2, 1)]
    assert rows(windows.top_one(df, ["g"], [F.col("n").desc(), F.col("id")])) == [("a", 1, 1)]


@pytest.mark.parametrize("split", [False, True])
def test_code_table(spark, split, request):
    if split:
        request.getfixturevalue("small_buckets")
    df = spark.createDataFrame([(f"v{i % 40:02d}" if i % 5 else None,) for i in range(300)], "c string")
    table = {r["c"]: r["code"] for r in code_table(df, "c", "code").collect()}
    assert table == {v: i for i, v in enumerate(sorted(table))}
    assert encode(df, {"c": "code"}).count() == 240
