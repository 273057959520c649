import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidemark.llm import spelling

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xC0, 0x100))


def counts(rows, misspelt=97):
    found = Counter()
    for i, text in rows:
        run = ""
        for c in [*(text or ""), " "]:
            c = c.lower() if "A" <= c <= "Z" else c
            if c in LETTERS:
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % misspelt == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 5:
                    found[run] += 1
            run = ""
    return found


def variants(word):
    """Every string one edit away."""
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in LETTERS)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in LETTERS)


def brute(rows, least=3, misspelt=97):
    n = {w: k for w, k in counts(rows, misspelt).items() if k >= least}
    near = {w: {v for v in variants(w) if v in n and v != w} for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def typos(rng, n, alphabet="abé"):
    """Words over few letters: many of them one edit apart, many with repeated letters."""
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(4, 8))) for _ in range(n)]
    return " ".join(rng.choices(words, weights=[(i + 1) ** -1.4 for i in range(n)], k=60 * n))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs, seed):
    rng = random.Random(seed)
    rows = [(i, typos(rng, 60)) for i in range(3)] + [(9, prose(rng, 300)), (None, typos(rng, 40)), (11, None), (12, ""), (13, "Ab aB 12, x")]
    expected = brute(rows, misspelt=7)
    assert len(expected) > 100 and any(r[2] not in (r[0], r[1]) for r in expected)
    assert found(spelling.spelling_variants(docs(rows), misspelt=7)) == expected


def test_borders_of_words(docs):
    """Edits at either end and in runs of one letter, words at the shortest length, large accented letters."""
    kinds = ["stone", "stones", "astone", "tone", "stonee", "sttone", "stoné", "stonÉ", "aaaaa", "aaaaaa", "aaaaaaa", "abcde", "bbcde", "abcdf"]
    rows = [(i, " ".join(f"{w}-{w.upper() if w.isascii() else w};{w}" for w in kinds[: i + 3])) for i in range(len(kinds))]
    assert found(spelling.spelling_variants(docs(rows))) == brute(rows)


def test_ties_take_the_smallest_form(docs):
    rows = [(1, "house " * 3 + "mouse " * 6 + "louse " * 6 + "houses " * 6)]
    out = {r.word: r for r in spelling.spelling_variants(docs(rows), misspelt=10**9).collect()}
    assert (out["house"].form, out["house"].form_n, out["house"].n_near) == ("houses", 6, 3)
    assert out["mouse"].form is None and out["mouse"].root == "mouse"


def test_very_long_words(docs):
    long = "xy" * 20_000
    rows = [(i, f"{long} {long}z {long[:100]}q{long[100:]} short") for i in range(3)]
    out = {len(r.word): (r.n, r.n_near) for r in spelling.spelling_variants(docs(rows), misspelt=10**9).where(F.length("word") > 100).collect()}
    assert out == {40_000: (3, 2), 40_001: (3, 1)}


def test_no_words(docs):
    assert spelling.spelling_variants(docs([])).collect() == []
    assert spelling.spelling_variants(docs([(1, None), (2, ""), (3, "one two"), (4, "rarely")])).collect() == []


def test_node_clashes_make_no_pairs(docs, monkeypatch):
    monkeypatch.setattr(spelling, "BASE", 1)  # a prefix and its anagrams share a node
    rows = [(i, "stone notes onset tones stones house") for i in range(4)]
    assert found(spelling.spelling_variants(docs(rows))) == brute(rows)
