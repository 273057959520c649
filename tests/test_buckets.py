import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.upsert import merge, snapshot
from tidemark.sinks.buckets import BucketedTable

SHAPE = "a int, b string, v string"


def frame(spark, values):
    return spark.createDataFrame([(a, b, v) for (a, b), v in values.items()], SHAPE)


def files(path):
    return {f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "t"), ["a", "b"], buckets=8)


def start(spark):
    return {(i, f"k{i % 3}"): f"v{i}" for i in range(60)}


def test_equals_the_plain_merge(spark, table):
    rng = random.Random(4)
    plain = frame(spark, start(spark))
    table.upsert(plain)
    for step in range(2):
        batch = frame(spark, {(a, f"k{a % 3}"): f"s{step}" for a in rng.sample(range(90), 12)})
        plain = spark.createDataFrame(snapshot(merge(plain, batch, ["a", "b"])).collect(), SHAPE)
        table.upsert(batch)
        assert rows(table.read()) == rows(plain)
    assert rows(table.read(1)) == rows(frame(spark, start(spark)))


def test_untouched_buckets_keep_their_files(spark, table, tmp_path):
    table.upsert(frame(spark, start(spark)))
    before, state = files(tmp_path), table.state()
    batch = frame(spark, {(1, "k1"): "changed", (100, "k1"): "new"})
    table.upsert(batch)
    touched = {r[0] for r in batch.select(table.bucket_of(batch, 8)).collect()}
    now = table.state()
    assert before <= files(tmp_path)
    assert {b for b in now.folders if now.folders[b] != state.folders.get(b)} == touched
    written = files(tmp_path) - before
    assert len(written) == len(touched), "one file for each touched bucket"


def test_the_target_is_not_shuffled_and_only_touched_buckets_are_read(spark, table):
    table.upsert(frame(spark, start(spark)))
    batch = frame(spark, {(1, "k1"): "changed"})
    _, merged, touched = table.merged(batch)
    merged.collect()
    text = merged._jdf.queryExecution().executedPlan().toString()
    text = text[text.find("== Final Plan ==") :].split("== Initial Plan ==")[0]
    scan = text[text.index("Scan parquet") :]
    assert "Bucketed: true" in scan or "SelectedBucketsCount" in scan
    assert text.count("Exchange hashpartitioning") == 1, text
    assert len(touched) == 1 and len(merged.inputFiles()) == 1


def test_a_merge_that_died_changes_nothing(spark, table, monkeypatch):
    table.upsert(frame(spark, start(spark)))
    before = rows(table.read())
    with monkeypatch.context() as m:
        m.setattr(BucketedTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            table.upsert(frame(spark, {(1, "k1"): "dead"}))
    assert rows(table.read()) == before
    table.upsert(frame(spark, {(2, "k2"): "alive"}))
    assert rows(table.read()) == sorted([r for r in before if r[:2] != (2, "k2")] + [(2, "k2", "alive")], key=repr)


def test_new_columns_and_wider_batch_keys(spark, table):
    table.upsert(frame(spark, start(spark)))
    table.upsert(frame(spark, {(1, "k1"): "x"}).select(F.col("a").cast("bigint").alias("a"), "b", F.lit(7).alias("w")), changed="always")
    out = {(r.a, r.b): (r.v, r.w) for r in table.read().collect()}
    assert out[1, "k1"] == ("v1", 7) and out[2, "k2"] == ("v2", None) and len(out) == 60


def test_null_keys_and_second_writers_are_refused(spark, table):
    with pytest.raises(ValueError, match="null in the key"):
        table.upsert(frame(spark, {(None, "x"): "v"}))
    state = table.upsert(frame(spark, start(spark)))
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish(state)


def test_empty_batch(spark, table):
    assert table.read() is None
    table.upsert(frame(spark, start(spark)))
    table.upsert(frame(spark, start(spark)).limit(0))
    assert table.read().count() == 60
