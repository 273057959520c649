import hashlib
import zlib
from collections import Counter
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

SHAPE = "doc_id long, source string, lang string, n_chars long, text string, idx long, digest string, level int, grp string, path string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], text)]
    return sha("".join(parts))


def tree(leaves):
    """Levels from the leaves up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i : i + 8])) for i in range(0, len(now), 8)])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        yield i % 8, run
        i //= 8


def brute(rows):
    none_first = lambda v: (v is not None, v if v is not None else 0)
    named = [(r, leaf(r, r[4])) for r in rows]
    named.sort(key=lambda x: (x[0][2] is not None, (x[0][2] or "").encode(), none_first(x[0][0]), x[1]))
    groups = [list(g) for _, g in groupby(named, key=lambda x: x[0][2])]
    trees = [tree([h for _, h in g]) for g in groups]
    top = tree([t[-1][0] for t in trees]) if trees else []
    out = Counter()
    for number, (members, levels) in enumerate(zip(groups, trees)):
        for i, (row, h) in enumerate(members):
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            fold, others = leaf(row, text), ""
            for at, run in [*steps(levels, i), *steps(top, number)]:
                others += "".join(run[:at] + run[at + 1 :])
                fold = sha("".join([*run[:at], fold, *run[at + 1 :]]))
            out[row[0], h, levels[-1][0], top[-1][0], sha(others), fold, fold == top[-1][0]] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def make(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", 9, "x", "x") for r in rows], SHAPE)


LANGS = [None, "", "de", "en", "fr", "é", "zz", "a", "b", "c", "d"]


def mixed():
    rows = [(i, f"src{i % 3}", LANGS[i % 11], i, f"Text {i}") for i in range(1, 40)]
    rows += [(1000 + i, None, "en", None, "Upper" if i % 2 else None) for i in range(600)]
    rows += [(5, "s", "en", 1, "same"), (5, "s", "en", 1, "same"), (5, "s", "en", 1, "Other"), (None, None, None, None, None), (None, "q", "en", 2, "")]
    return rows + [(7000, "s", "fr", 300_000, "é" * 300_000)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(merkle, "small_side", lambda rows: rows)
    rows = mixed()
    expected = brute(rows)
    assert {k[-1] for k in expected} == {True, False}
    assert found(merkle.verified_manifest(make(spark, rows))) == expected


@pytest.mark.parametrize("rows", [
    [(3, "s", "en", 1, "One")],
    [(3, "s", "en", 1, "One"), (4, "s", None, 1, "Two")],
    [(i, "s", "en", 1, "Ab") for i in range(9)],
    [(1, "s", "en", 1, "equal")] * 20,
])
def test_small_trees(spark, rows):
    assert found(merkle.verified_manifest(make(spark, rows))) == brute(rows)


def test_empty(spark):
    assert merkle.verified_manifest(make(spark, [])).collect() == []


def test_a_changed_node_or_place_breaks_the_proof(spark):
    leaves = make(spark, mixed()[:60]).select(F.col("lang").alias("grp"), F.col("doc_id").alias("id"), merkle.leaf_digest({"text": F.col("text")}).alias("digest"))
    made = merkle.manifest(leaves)
    moved = F.transform("path", lambda s, i: F.when(i == 0, s.withField("place", (s["place"] + 1) % F.size(s["kids"]))).otherwise(s))
    wrong = F.transform("path", lambda s, i: s.withField("kids", F.transform(s["kids"], lambda k, j: F.when((i == 0) & (j != s["place"]), F.unhex(F.lit("00"))).otherwise(k))))
    first = made.proofs.where("size(path) > 1 and size(path[0].kids) > 1")
    roots = first.select(
        merkle.as_hex(merkle.folded(F.col("digest"), F.col("path"))).alias("right"),
        merkle.as_hex(merkle.folded(F.col("digest"), moved)).alias("moved"),
        merkle.as_hex(merkle.folded(F.col("digest"), wrong)).alias("wrong"),
    ).collect()
    assert roots and all(r.right == made.root and r.wrong != made.root and r.moved != made.root for r in roots)
