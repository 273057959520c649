"""The pipeline on small tables: each stage's decisions take effect, and nothing else goes."""

import random

import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_jaccard import brute as similar
from tidemark.llm import decontaminate, queries, toxicity

TABLES = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]


@pytest.fixture
def folder(spark, docs, tmp_path):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(8, 60)) + (" nasty rotten" if i % 4 == 0 else "")) for i in range(80)]
    rows += [(100 + i, rows[4 * i + 1][1]) for i in range(5)]
    rows += [(200 + i, rows[4 * i + 2][1] + " end") for i in range(5)]
    rows += [(300, "asked words of an item " + prose(rng, 9)), (301, None), (302, ""), (None, "no id here"), (303, prose(rng, 3000)), (1, rows[1][1])]
    docs(rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "Asked words of an item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def test_against_brute_force(spark, folder):
    path, rows = folder
    left = spark.read.parquet(f"{path}/documents.parquet")
    expected = list(dict.fromkeys(rows))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        source = left
        left = stage(spark, source, path)
        assert left.columns == source.columns, name
        left.write.parquet(f"{path}/{name}")
        left = spark.read.parquet(f"{path}/{name}")
        got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
        if name == "toxicity":
            scored = toxicity.score_toxicity(source, spark.read.parquet(f"{path}/labels.parquet")).collect()
            bad = {r.doc_id for r in scored if r.predicted}
            assert len(bad & {i for i in range(0, 80, 4)}) >= 18 and len(bad) <= 22
            expected = [r for r in rows if r[0] not in bad]
        elif name == "exact_dedup":
            best = {}
            for i, t in expected:
                best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
            expected = [r for r in dict.fromkeys(expected) if best[r[1] or ""] == (-1 if r[0] is None else r[0])]
        elif name == "ngram_jaccard_join":
            reached = {i: c for i, _, c in similar([(-1 if i is None else i, t) for i, t in expected])}
            expected = [r for r in expected if reached[-1 if r[0] is None else r[0]] == (-1 if r[0] is None else r[0])]
        else:
            expected = [r for r in expected if r[0] != 300]
        assert got == sorted(expected, key=repr), name


def test_run_packs_what_is_left(spark, folder):
    path, _ = folder
    out = corpus_pipeline.run(spark, path).collect()
    ids = {r.doc_id for r in out}
    assert len(ids) > 40 and not ids & {0, 300, 301}
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048



def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13
    assert set(queries.SQL) <= set(queries.QUERIES) and "pipeline" not in __spark_entry__.oracle_sql()
    assert decontaminate.WINDOW == 10


def test_run_on_the_tables(spark):
    assert corpus_pipeline.run(spark, TABLES).count() > 100
