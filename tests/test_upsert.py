import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.functions.hashing import hash_key, row_checksum
from tidemark.operators import upsert
from tidemark.session import materialize

SHAPE = "id int, name string, n int"
TARGET = [(1, "a", 1), (2, "b", None), (3, "c", 3), (None, "t", 0)]
SOURCE = [(1, "a", 1), (2, "b", 5), (4, "d", 4), (None, "s", 9), (None, "s2", 9)]


def frames(spark):
    return spark.createDataFrame(TARGET, SHAPE), spark.createDataFrame(SOURCE, SHAPE)


@pytest.mark.parametrize("fits", [True, False, None])
def test_column_guard(spark, fits):
    target, source = frames(spark)
    out = upsert.upsert_columns(target, source, ["id"], batch_fits=fits)
    assert rows(out) == sorted(
        [
            (1, "a", 1, "N"), (2, "b", 5, "U"), (3, "c", 3, "K"), (4, "d", 4, "I"),
            (None, "t", 0, "K"), (None, "s", 9, "I"), (None, "s2", 9, "I"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("fits", [True, False])
def test_plain_comparison_misses_null_to_value(spark, fits):
    target, source = frames(spark)
    out = upsert.upsert_columns(target, source, ["id"], null_safe=False, batch_fits=fits)
    assert (2, "b", None, "N") in rows(out)


def test_applying_twice_changes_nothing(spark):
    target, source = frames(spark)
    source = source.where("id is not null")
    once = upsert.snapshot(upsert.upsert_columns(target, source, ["id"]))
    twice = upsert.upsert_columns(once, source, ["id"])
    assert rows(upsert.snapshot(twice)) == rows(once)
    assert twice.where("_action IN ('I', 'U')").count() == 0


@pytest.mark.parametrize("fits", [True, False])
def test_counts_add_up(spark, fits):
    target, source = frames(spark)
    merged = upsert.merge(target, source, ["id"], "always", batch_fits=fits)
    counts = upsert.merge_counts(merged).first()
    assert tuple(counts) == (3, 2, 0, 2)
    written = materialize(merged, "test-merge")
    assert tuple(upsert.merge_counts(written).first()) == (3, 2, 0, 2)
    again = upsert.merge(written, source, ["id"], batch_fits=fits)
    assert again.columns.count(upsert.ACTION) == 1


@pytest.mark.parametrize("fits", [True, False])
def test_new_and_missing_columns(spark, fits):
    target = spark.createDataFrame([(1, "old", "x")], "id int, name string, only_target string")
    source = spark.createDataFrame([(1, "new", 7), (2, "two", 8)], "id int, name string, only_source int")
    out = upsert.snapshot(upsert.merge(target, source, ["id"], batch_fits=fits))
    assert out.columns == ["id", "name", "only_target", "only_source"]
    assert rows(out) == [(1, "new", "x", 7), (2, "two", None, 8)]


@pytest.mark.parametrize("fits", [True, False])
def test_fact_keeps_surrogate(spark, fits):
    target = spark.createDataFrame([(100, 1, 1, "a")], "sk int, a int, b int, v string")
    source = spark.createDataFrame([(900, 1, 1, "z"), (901, 1, 2, "y")], "sk int, a int, b int, v string")
    out = upsert.snapshot(upsert.upsert_fact(target, source, ["a", "b"], ["sk"], batch_fits=fits))
    assert rows(out.select("sk", "a", "b", "v")) == [(100, 1, 1, "z"), (901, 1, 2, "y")]


def test_update_only(spark):
    target, source = frames(spark)
    out = upsert.snapshot(upsert.update_matched(target, source, ["id"], {"n": F.lit(0)}))
    assert rows(out) == sorted([(1, "a", 0), (2, "b", 0), (3, "c", 3), (None, "t", 0)], key=repr)


def test_missing_target_and_empty_batch(spark):
    target, source = frames(spark)
    assert upsert.merge(None, source, ["id"]).where("_action = 'I'").count() == 5
    out = upsert.merge(target, source.limit(0), ["id"])
    assert rows(upsert.snapshot(out)) == rows(target)


def test_duplicate_batch_keys(spark):
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], SHAPE)
    kept = upsert.dedupe_batch(batch, ["id"], [F.col("n").desc()])
    assert rows(kept) == [(1, "new", 2), (2, "x", 1)]
    with pytest.raises(ValueError):
        upsert.dedupe_batch(batch, ["id"], on_duplicate="error")


def test_dedupe_keeps_rows_without_key_and_limits_before_the_shuffle(spark):
    batch = spark.createDataFrame([(None, "a", 1), (None, "b", 1), (1, "c", 1), (1, "d", 2)], SHAPE)
    kept = upsert.dedupe_batch(batch, ["id"], [F.col("n").desc()])
    assert rows(kept.select("name")) == [("a",), ("b",), ("d",)]
    assert "WindowGroupLimit" in plan(kept) and "Partial" in plan(kept)


def test_small_batch_does_not_shuffle_the_target(spark, tables):
    target = spark.read.parquet(f"{tables}/customer.parquet")
    batch = target.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0))
    text = plan(upsert.update_matched(target, batch, ["c_custkey"], batch_fits=True))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_update_delete_three_valued(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id int, v int")
    assert rows(upsert.table_delete(df, F.col("v") == 5)) == [(1, None), (3, 6)]
    updated = upsert.table_update(df, F.col("v") >= 5, {"id": F.col("v"), "v": F.col("id")})
    assert rows(updated) == [(1, None), (5, 2), (6, 3)]


def test_replace_one_bu(spark):
    target = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "bu string, v int")
    batch = spark.createDataFrame([("B", 8), ("B", 9)], "bu string, v int")
    assert rows(upsert.replace_by_keys(target, batch, ["bu"])) == [("A", 1), ("A", 2), ("B", 8), ("B", 9)]


def test_checksum_separates_columns_and_nulls(spark):
    df = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), (None, "x"), ("", "x"), ("-", "x"), ("a\u001f1:b", None)], "a string, b string"
    )
    sums = [r[0] for r in df.select(row_checksum(df)).collect()]
    assert len(set(sums)) == 6


def test_checksum_takes_any_type(spark):
    df = spark.sql("SELECT 1 AS i, timestamp'2024-01-01 00:00:00' AS t, date'2024-01-01' AS d, array(1, null) AS a, null AS n")
    first = df.select(row_checksum(df), hash_key(df, ["i", "t"])).first()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        shifted = spark.sql("SELECT 1 AS i, timestamp'2024-01-01 09:00:00' AS t, date'2024-01-01' AS d, array(1, null) AS a, null AS n")
        assert tuple(shifted.select(row_checksum(shifted), hash_key(shifted, ["i", "t"])).first()) == tuple(first)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("fits", [True, False])
def test_names_match_without_case(spark, fits):
    target = spark.createDataFrame([(1, "a")], "Id int, Name string")
    source = spark.createDataFrame([(1, "b"), (2, "c")], "ID int, NAME string")
    out = upsert.snapshot(upsert.upsert_columns(target, source, ["id"], batch_fits=fits))
    assert out.columns == ["Id", "Name"] and rows(out) == [(1, "b"), (2, "c")]
