import random
import re

import pytest

from tests.llm.conftest import prose
from tidemark.llm import jaccard
from tidemark.llm.components import components

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    said = SPLIT.findall(low)
    return {tuple(said[i : i + 5]) for i in range(len(said) - 4)} if len(said) >= 5 else {tuple(said)} if said else set()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    known = [(i, shingles(t)) for i, t in rows]
    links = [
        (a, b) for k, (a, x) in enumerate(known) for b, y in known[:k] if a != b and x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    root = roots({i for i, _ in known}, links)
    return sorted((i, len(x), root[i]) for i, x in known)


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def edited(rng, text, n):
    said = text.split()
    for _ in range(n):
        said[rng.randrange(len(said))] = f"new{rng.randrange(1000)}"
    return " ".join(said)


def corpus(rng):
    rows = []
    for g in range(8):
        base = prose(rng, rng.choice([6, 20, 60, 200]))
        for _ in range(rng.choice([1, 2, 9])):
            rows.append(edited(rng, base, rng.choice([0, 0, 1, 2, 3])))
    rows += [prose(rng, rng.randrange(0, 12)) for _ in range(25)]
    rows += ["one two", "One  TWO", "one two three", "", None, " \n", "\x0b", "É a b c d", "é a b c d", "x　y z"]
    rows += ["common line of five words here " + prose(rng, 3) for _ in range(12)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return list(zip(order, rows, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs, seed):
    rows = corpus(random.Random(seed))
    assert found(jaccard.similar_documents(docs(rows))) == brute(rows)


def test_chain_that_the_first_of_a_group_does_not_reach(docs):
    rng = random.Random(9)
    said = prose(rng, 400).split()
    rows = [(i, " ".join(said[25 * i : 25 * i + 200])) for i in range(8)]
    got = found(jaccard.similar_documents(docs(rows)))
    assert got == brute(rows) and len({c for _, _, c in got}) == 1


def test_repeated_rows_and_ids(docs):
    text, other = prose(random.Random(1), 40), prose(random.Random(2), 40)
    rows = [(5, text), (5, text), (3, text), (7, other), (3, other), (None, None), (None, "alone here")]
    got = jaccard.similar_documents(docs(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(3, 3), (3, 3), (5, 3), (5, 3), (7, 3)]
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]


def test_long_and_empty(docs):
    long = prose(random.Random(3), 60_000)
    rows = [(1, long), (2, long + " end"), (3, "short")]
    assert [(i, c) for i, _, c in found(jaccard.similar_documents(docs(rows)))] == [(1, 1), (2, 1), (3, 3)]
    assert found(jaccard.similar_documents(docs([]))) == []
    assert found(jaccard.similar_documents(docs([(1, None)]))) == [(1, 0, 1)]


def test_one_of_each_keeps_columns(docs):
    text = prose(random.Random(1), 40)
    df = docs([(4, text), (2, text), (9, "other"), (None, text), (None, None), (8, None)])
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in out.collect()))) == ["8", "9", "None", "None"]


def test_components(spark):
    rng = random.Random(6)
    links = [(a, a + 1) for a in range(100, 160)] + [(200, b) for b in range(201, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    root = roots({x for p in links for x in p}, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {n: root[n] for n in nodes} and len(got) == len(nodes)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def star_of(rng, copies, original_last):
    """One text and copies that are each similar to it, but not to one another."""
    said = prose(rng, 300).split()
    rows = [" ".join(said)]
    for _ in range(copies):
        at = rng.sample(range(0, 300, 6), 8)
        rows.append(" ".join(f"{w}x{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(said)))
    ids = range(copies, -1, -1) if original_last else range(copies + 1)
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("original_last", [True, False])
def test_copies_of_one_text_cost_one_pair_each(docs, original_last):
    for copies in (20, 80):
        rows = star_of(random.Random(copies), copies, original_last)
        join = jaccard.Join(docs(rows))
        join.scan()
        join.share()
        star = join.star_pairs()
        links = join.verify(jaccard.ordered(join.best(star)))
        assert links.count() == copies and join.cross_pairs(components(links)).count() == 0
        got = found(jaccard.similar_documents(docs(rows)))
        assert got == brute(rows) and {c for _, _, c in got} == {0}


def test_common_passage_of_texts_that_are_not_similar(docs):
    """Texts that share a passage shorter than their prefixes leave pairs to look at, in proportion to their number."""
    rng = random.Random(4)
    passage = prose(rng, 60)
    rows = [(i, f"{passage} {prose(rng, 60 + i % 9)}") for i in range(120)]
    join = jaccard.Join(docs(rows))
    join.scan()
    join.share()
    assert join.shared.count() <= len(rows) and join.cross_pairs(components(join.verify(join.star_pairs()))).count() <= len(rows)
    assert found(jaccard.similar_documents(docs(rows))) == brute(rows)
