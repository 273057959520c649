import hashlib
import random
import re

import pytest

from tests.conftest import plan
from tests.llm.conftest import prose
from tidemark.llm import decontaminate, texts

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(rows, items, size=10):
    out = []
    for i, text in rows:
        said, hit, seen = words(text), set(), set()
        for item, asked in items:
            asked = words(asked)
            length = min(size, len(asked))
            for k in range(len(asked) - length + 1 if length else 0):
                for p in range(len(said) - length + 1):
                    if said[p : p + length] == asked[k : k + length]:
                        hit.update(range(p, p + length))
                        seen.add("null" if item is None else str(item))
        out.append((i, len(said), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, doc_id string, at int")


def test_against_brute_force(docs, items):
    rng = random.Random(3)
    asked = [(i, prose(rng, rng.choice([3, 9, 10, 11, 25]))) for i in range(12)]
    asked += [(12, None), (13, ""), (14, "!!"), (15, "the the the the the the the the the the the the"), (15, "of the"), (16, "Zebra"), (2, asked[2][1]), (None, "lonely Term")]
    rows = []
    for i in range(60):
        text = prose(rng, rng.randrange(0, 80))
        if i % 3 == 0:
            part = rng.choice(asked)[1] or ""
            text += ". " + part.upper() + " " + prose(rng, 5)
        rows.append((i, text))
    rows += [(60, None), (61, ""), (62, "the " * 40), (63, "... ,"), (64, "ÉCOLE zebra é"), (65, "lonely-TERM"), (None, asked[3][1])]
    assert found(decontaminate.contamination(docs(rows), items(asked))) == brute(rows, asked)
    long = [(1, prose(rng, 30_000) + " " + asked[4][1] + " " + prose(rng, 30_000))]
    assert found(decontaminate.contamination(docs(long), items(asked))) == brute(long, asked)


def test_beyond_the_size_checks(docs, items, monkeypatch):
    rng = random.Random(4)
    asked = [(i, prose(rng, 14)) for i in range(5)]
    rows = [(i, prose(rng, 10) + " " + asked[i % 5][1][: 40 + 10 * (i % 7)] + " " + prose(rng, 4)) for i in range(30)]
    monkeypatch.setattr(texts, "fits_broadcast", lambda df: False)
    assert found(decontaminate.contamination(docs(rows), items(asked))) == brute(rows, asked)


def test_repeated_rows_are_one_document(docs, items):
    asked = [(1, "alpha beta gamma")]
    out = found(decontaminate.contamination(docs([(1, "x alpha beta gamma"), (1, "x alpha beta gamma")]), items(asked)))
    assert out == brute([(1, "x alpha beta gamma")], asked)


def test_empty_tables(docs, items):
    assert found(decontaminate.contamination(docs([]), items([(1, "a b")]))) == []
    assert found(decontaminate.contamination(docs([(1, "a b")]), items([]))) == brute([(1, "a b")], [])


def test_proximity(docs, items, spark):
    near = decontaminate.contamination(docs([(1, "alpha then beta gamma"), (2, "alpha one two three four beta gamma")]), items([(1, "alpha beta gamma")]), slack=1)
    assert {r.doc_id: r.contaminated for r in near.collect()} == {1: True, 2: False}


def test_filter_keeps_columns(docs, items):
    df = docs([(1, "alpha beta gamma"), (2, "clean"), (None, "clean too"), (3, None)])
    out = decontaminate.without_contaminated(df, items([(1, "alpha beta")]))
    assert out.columns == df.columns and sorted(map(repr, (r.doc_id for r in out.collect()))) == ["2", "3", "None"]


def test_no_python_in_the_plan(docs, items):
    text = plan(decontaminate.contamination(docs([(1, "a b")]), items([(1, "a")])))
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
