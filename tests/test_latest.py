import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import latest


def test_latest_flag_golden(spark):
    target = spark.createDataFrame([(1, "old", 1), (2, "two", 1), (3, "three", 1)], "id int, name string, IsLatest int")
    batch = spark.createDataFrame([(1, "mid", 1), (1, "new", 2)], "id int, name string, seq int")
    assert rows(latest.latest_flag(target, batch, "id", "seq")) == [
        (1, "mid", 0), (1, "new", 1), (1, "old", 0), (2, "two", 1), (3, "three", 1),
    ]


@pytest.mark.parametrize("end_from, first_end", [("self", "2024-01-01"), ("successor", "2024-01-05")])
def test_end_timestamp_golden(spark, end_from, first_end):
    target = spark.createDataFrame(
        [(1, "a", "2024-01-01", 1, "9999-12-31"), (2, "b", "2024-01-02", 1, "9999-12-31")],
        "id int, cond_cols string, trans_proc_ts string, IsLatest int, trans_proc_end_ts string",
    )
    batch = spark.createDataFrame([(3, "a", "2024-01-05")], "id int, cond_cols string, trans_proc_ts string")
    out = latest.latest_flag_end_ts(target, batch, "cond_cols", "id", "trans_proc_ts", end_from=end_from)
    assert rows(out.select(*target.columns)) == [
        (1, "a", "2024-01-01", 0, first_end),
        (2, "b", "2024-01-02", 1, "9999-12-31"),
        (3, "a", "2024-01-05", 1, "9999-12-31"),
    ]


@pytest.mark.parametrize("fits", [True, False])
def test_one_hot_group(spark, monkeypatch, small_buckets, fits):
    monkeypatch.setattr(latest, "fits_broadcast", lambda df: fits)
    target = spark.createDataFrame([], "g string, id int, IsLatest int")
    batch = spark.range(300).select(
        F.when(F.col("id") < 200, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), F.col("id").cast("int")
    )
    out = latest.latest_flag(target, batch, "g", "id")
    assert out.count() == 300
    assert rows(out.where("IsLatest = 1 AND g = 'hot'").select("id")) == [(199,)]
    assert out.where("IsLatest = 1").count() == 8


def test_null_keys_are_each_latest(spark):
    target = spark.createDataFrame([(None, "t", 1)], "id int, name string, IsLatest int")
    batch = spark.createDataFrame([(None, "x", 1), (None, "y", 2)], "id int, name string, seq int")
    assert rows(latest.latest_flag(target, batch, "id", "seq").select("IsLatest")) == [(1,), (1,), (1,)]
