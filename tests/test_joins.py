import pytest

from tests.conftest import plan, rows
from tidemark.functions import ranges, sizing
from tidemark.operators import joins


def sides(spark):
    big = spark.createDataFrame(
        [("hot", i) for i in range(100)] + [(f"k{i % 9}", i) for i in range(150)] + [(None, i) for i in range(50)],
        "k string, v int",
    )
    small = spark.createDataFrame([("hot", "H"), ("k1", "1"), ("k2", "2"), ("zz", "Z")], "k string, name string")
    return big, small


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("fits", [True, False])
def test_lookup_join_equals_plain_join(spark, small_buckets, how, fits):
    big, small = sides(spark)
    expected = big.join(small, ["k"], how)
    got = joins.lookup_join(big, small, ["k"], how, lookup_fits=fits)
    assert rows(got.select(*expected.columns)) == rows(expected)


def test_hot_keys_found(spark, small_buckets):
    big, _ = sides(spark)
    found = {r["k"] for r in ranges.hot_keys(big, ["k"]).collect()}
    assert "hot" in found and None not in found


def test_no_hot_keys_in_a_small_frame(spark):
    big, _ = sides(spark)
    assert ranges.hot_keys(big, ["k"]) is None


def test_size_check(spark, monkeypatch):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "i int, s string")
    assert sizing.measure(df) == (2, 2 * 2 * sizing.FIXED_BYTES + 3)
    assert sizing.measure(df.limit(0)) == (0, 0)
    assert sizing.fits_broadcast(df)
    assert not sizing.fits_broadcast(df, max_rows=1)
    assert not sizing.fits_broadcast(df, max_bytes=10)


def test_large_lookup_is_not_broadcast(spark, monkeypatch):
    big, small = sides(spark)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.lookup_join(big, small, ["k"], "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text


def test_changed_rows_null_modes(spark):
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "id int, v string")
    assert rows(joins.changed_rows(new, old, ["id"], ["v"])) == [(2, "b"), (3, "c")]
    assert rows(joins.changed_rows(new, old, ["id"], ["v"], null_safe=False)) == [(3, "c")]


def test_generated_join_needs_keys(spark):
    with pytest.raises(ValueError):
        joins.generated_join(spark.range(1), {"id": "id"}, [joins.JoinStep(spark.range(1), ())])


@pytest.mark.parametrize("lookups", [2, 4, 6])
def test_chained_lookups_read_each_table_once(spark, lookups, tmp_path):
    spark.range(200).selectExpr("id", *[f"id % {i + 3} as k{i}" for i in range(lookups)]).write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    for i in range(lookups):
        spark.range(i + 3).selectExpr(f"id as k{i}", f"id * 10 as v{i}").write.parquet(f"{tmp_path}/{i}")
        df = joins.lookup_join(df, spark.read.parquet(f"{tmp_path}/{i}"), [f"k{i}"], "left", lookup_fits=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(df)
        found = df.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("FileScan") == lookups + 1
    assert len(found) == 200 and all(r[f"v{i}"] == 10 * r[f"k{i}"] for r in found for i in range(lookups))


def test_null_keys_are_spread_and_match_nothing(spark):
    rows = spark.createDataFrame([(None, i, {"m": i}) for i in range(50)] + [(1, 99, None)], "k long, v long, m map<string,long>")
    lookup = spark.createDataFrame([(None, "null"), (1, "one")], "k long, name string")
    left = joins.lookup_join(rows, lookup, ["k"], "left", lookup_fits=False)
    assert left.count() == 51 and left.where("name is not null").count() == 1 and left.columns == ["k", "v", "m", "name"]
    assert joins.lookup_join(rows, lookup, ["k"], "left_anti", lookup_fits=False).count() == 50
