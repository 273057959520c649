import hashlib

from pyspark.sql import functions as F

from tests.conftest import plan
from tidemark.llm import exact_dedup

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "a "), (7, "x" * 300_000), (8, "x" * 300_000), (3, "a"), (3, "c"), (None, "a"), (None, None), (9, "c")]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = set()
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.add((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest(), sum(1 for r in rows if (r[0], r[1] or "") == (i, t or ""))))
    return out


def found(df):
    rows = [tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_rows").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_against_brute_force(docs):
    assert found(exact_dedup.exact_duplicates(docs(ROWS))) == brute(ROWS)


def test_digest_collisions_are_told_apart_by_bytes(docs):
    weak = lambda text: F.md5(F.substring(text, 1, 1))
    rows = [*ROWS, (20, "ab"), (21, "ac"), (22, "ab")]
    assert found(exact_dedup.exact_duplicates(docs(rows), digest=weak)) == brute(rows)
    assert found(exact_dedup.exact_duplicates(docs(rows), digest=weak, second=weak)) == brute(rows)


def test_empty(docs):
    assert exact_dedup.exact_duplicates(docs([])).collect() == []
    assert exact_dedup.drop_exact_duplicates(docs([])).collect() == []


def test_drop_keeps_columns_and_one_row(docs):
    df = docs(ROWS)
    out = exact_dedup.drop_exact_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text and r.text[:3]) for r in out.select("doc_id", "text").collect()) == [(2, "b"), (3, "a"), (5, ""), (6, "a "), (8, "xxx"), (9, "c")]


def test_no_python_in_the_plan(docs):
    text = plan(exact_dedup.exact_duplicates(docs(ROWS)))
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
