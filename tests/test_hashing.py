"""Checksums of nested values, keys from SQL, JDBC texts and folders."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions import hashing
from tidemark.operators.windows import latest_per_key
from tidemark.sources import files, jdbc

NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def sums(spark, values, shape):
    df = spark.createDataFrame([(v,) for v in values], f"v {shape}")
    return [r[0] for r in df.select(hashing.row_checksum(df)).collect()]


@pytest.mark.parametrize(
    "shape,values",
    [
        ("struct<t:timestamp,n:int>", [(NOON, 1), (NOON + timedelta(microseconds=1), 1), (None, 1), None]),
        ("array<timestamp>", [[NOON], [NOON + timedelta(microseconds=1)], [], [None], None]),
        ("array<string>", [["a", "b"], ["a\x1fb"], ["ab"], ["a", None], [None, "a"], [""]]),
        ("array<struct<a:string,b:string>>", [[("x", "yz")], [("xy", "z")], [("x", None)], [None], []]),
        ("struct<a:string,b:string>", [("1:x", ""), ("", "1:x"), (None, None)]),
    ],
)
def test_nested_values_differ(spark, shape, values):
    assert len(set(sums(spark, values, shape))) == len(values)


@pytest.mark.parametrize("shape", ["map<string,int>", "array<map<string,int>>", "struct<a:map<string,int>>"])
def test_maps_are_refused_at_any_depth(spark, shape):
    df = spark.createDataFrame([], f"v {shape}")
    with pytest.raises(TypeError, match="canonical"):
        hashing.row_checksum(df)


def test_checksum_does_not_depend_on_the_time_zone(spark):
    before = sums(spark, [(NOON, 1)], "struct<t:timestamp,n:int>")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert sums(spark, [(NOON, 1)], "struct<t:timestamp,n:int>") == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_equal_null_key_rows_are_all_kept(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), (5, 1), (5, 2)], "k int, v int")
    got = latest_per_key(df, ["k"], [F.col("v").desc()]).collect()
    assert sorted(((r.k or 0), r.v) for r in got) == [(0, 1), (0, 1), (0, 2), (5, 2)]


def test_with_query_goes_through_prepare_query():
    text = "WITH a AS (SELECT 1 AS x, ') select (' AS y), b AS (SELECT * FROM a) SELECT * FROM b WHERE x IN (SELECT x FROM a)"
    before, query = jdbc.prepared(text)
    assert before.startswith("WITH a AS") and before.endswith("FROM a)")
    assert query == "SELECT * FROM b WHERE x IN (SELECT x FROM a)"
    assert jdbc.watermark_query("select 1", "d", datetime(2024, 1, 2), literal="TIMESTAMP '{}'").endswith("q.d >= TIMESTAMP '2024-01-02 00:00:00.000') src")


def test_folder_below(spark):
    df = spark.createDataFrame([("file:///a/b.c/EU/contact/2024/05/f.parquet",), ("file:///a/b.c/bu=007/t/f.parquet",)], "p string")
    for root in ("/a/b.c", "/a/b.c/", "file:///a/b.c", "file:/a/b.c"):
        assert [r[0] for r in df.select(files.folder_below(F.col("p"), root)).collect()] == ["EU", "007"]


def test_intermediates_are_deleted(spark):
    import os

    with session.intermediates(spark):
        df = session.materialize(spark.range(3), "gone")
        path = session._HANDED_OUT[-1]
        assert df.count() == 3
    local = path.removeprefix("file://")
    assert path not in session._HANDED_OUT and not os.path.exists(local)


def test_cluster_without_the_setting_is_an_error():
    class Context:
        master, applicationId = "spark://host:7077", "a"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")
    Context.master = "local[2]"
    assert session.shared_dir(Session(), "x").rsplit("/", 1)[0] == session.shared_dir(Session(), "y").rsplit("/", 1)[0]
