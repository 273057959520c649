import zlib
from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding

ROWS = [(1, "a"), (2, None), (3, ""), (4, "é" * 50_000), (5, "a"), (5, "a"), (5, "b"), (None, "a"), (None, None)] + [(i, f"text {i}") for i in range(6, 60)]


def slots(df):
    found = {}
    for r in df.select("shard", "slot").collect():
        found.setdefault(r.shard, []).append(r.slot)
    return {s: sorted(v) for s, v in found.items()}


def test_every_row_has_a_place_and_sizes_are_exact(docs):
    out = sharding.document_shards(docs(ROWS), shards=16).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ROWS)
    by_shard = slots(sharding.document_shards(docs(ROWS), shards=16))
    assert sorted(map(len, by_shard.values())) == sorted(sharding.shard_sizes(len(ROWS), 16))
    assert all(v == list(range(len(v))) for v in by_shard.values())
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}


def test_bins_of_a_shard_join_without_gaps(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BIN_ROWS", 3)
    by_shard = slots(sharding.shuffle_into_shards(docs(ROWS), 4, seed=3))
    assert {s: len(v) for s, v in by_shard.items()} == dict(enumerate(sharding.shard_sizes(len(ROWS), 4)))
    assert all(v == list(range(len(v))) for v in by_shard.values())


def test_many_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_BITS", 3)
    monkeypatch.setattr(sharding, "GROUP_BITS", 1)
    df = spark.range(0, 1003, 1, 7).withColumn("shard", F.lit("mine"))
    out = sharding.shuffle_into_shards(df, 5, seed=1)
    assert out.columns == ["id", "shard", "slot"]
    by_shard = slots(out)
    assert [len(by_shard[s]) for s in range(5)] == sharding.shard_sizes(1003, 5)
    assert all(v == list(range(len(v))) for v in by_shard.values())
    assert sorted(r.id for r in out.collect()) == list(range(1003))


def test_empty_and_fewer_rows_than_shards(docs):
    assert sharding.document_shards(docs([])).collect() == []
    assert slots(sharding.document_shards(docs(ROWS[:3]))) == {0: [0], 1: [0], 2: [0]}


def test_columns_pass_and_the_seed_decides(docs):
    df = docs(ROWS)
    first = sharding.shuffle_into_shards(df, 4, seed=1)
    assert first.columns == [*df.columns, "shard", "slot"]
    assert sorted(map(repr, first.drop("shard", "slot").collect())) == sorted(map(repr, df.collect()))
    place = lambda seed: sorted((repr((r.doc_id, r.text)), r.shard, r.slot) for r in sharding.shuffle_into_shards(df, 4, seed=seed).collect())
    assert place(1) == place(1) != place(2)


def test_places_are_uniform(spark):
    """Where rows were against where they are, over six seeds: chi squared with room for chance."""
    df = spark.range(0, 600, 1, 3)
    seen = np.zeros((12, 12))
    for seed in range(6):
        for r in sharding.shuffle_into_shards(df, 3, seed=seed).collect():
            seen[r.id // 50, (r.shard * 200 + r.slot) // 50] += 1
    assert (seen.sum(axis=0) == 300).all()
    chi = ((seen - 25) ** 2 / 25).sum()
    assert 121 - 5 * np.sqrt(2 * 121) < chi < 121 + 5 * np.sqrt(2 * 121)


@pytest.mark.parametrize("good, bad, drawn", [(7, 5, 4), (1, 9, 3), (6, 0, 4), (0, 6, 4), (5, 5, 10), (9, 9, 0)])
def test_inversion_has_the_exact_law(good, bad, drawn):
    rng = np.random.default_rng(5)
    n = 20_000
    counts = Counter(sharding.inverted(rng, good, bad, drawn) for _ in range(n))
    for k in range(0, drawn + 1):
        p = comb(good, k) * comb(bad, drawn - k) / comb(good + bad, drawn) if drawn - k <= bad and k <= good else 0
        assert abs(counts[k] - n * p) <= 5 * np.sqrt(n * p * (1 - p)) + 1e-9


def test_draws_beyond_numpys_limit():
    rng = np.random.default_rng(1)
    rows, shards = 10**12, 16
    drawn = np.array([sharding.matrix_row(rng, sharding.shard_sizes(rows, shards), 10**8) for _ in range(60)])
    assert (drawn.sum(axis=1) == 10**8).all()
    sigma = np.sqrt(10**8 / 16 * 15 / 16)
    assert abs(drawn.mean() - 10**8 / 16) < 1 and np.abs(drawn - 10**8 / 16).max() < 6 * sigma
    assert 0.8 * sigma < drawn.std() < 1.2 * sigma


def test_files_of_shards(docs, spark, tmp_path):
    path = f"{tmp_path}/shards"
    sharding.write_shards(docs(ROWS), path, 4, seed=2)
    back = spark.read.parquet(path)
    assert back.count() == len(ROWS) and sorted(map(len, slots(back).values())) == sorted(sharding.shard_sizes(len(ROWS), 4))
