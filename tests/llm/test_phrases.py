import hashlib
import random
import re

import pytest

from tests.llm.conftest import prose
from tidemark.llm import phrases

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def brute(rows):
    known = [(i, SPLIT.findall(t or "")) for i, t in rows]
    first = {}
    for i, said in known:
        for p in range(len(said) - 12):
            g = tuple(said[p : p + 13])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, said in known:
        gone = {q for p in range(len(said) - 12) if first[tuple(said[p : p + 13])] < i for q in range(p, p + 13)}
        kept = " ".join(w for p, w in enumerate(said) if p not in gone)
        out.append((i, len(said), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def corpus(rng):
    passages = [prose(rng, n) for n in (12, 13, 14, 40, 90)]
    rows = [(i, prose(rng, rng.randrange(0, 60)) + rng.choice([" ", "\n", "\t "]) + rng.choice(passages) + " " + prose(rng, rng.randrange(0, 30))) for i in range(40)]
    rows += [(i, rows[rng.randrange(40)][1]) for i in range(40, 50)]
    whole = prose(rng, 70).split()
    # pieces of one text that the smallest document under a mark does not have whole
    rows += [(50 + i, " ".join(whole[5 * i : 5 * i + 30])) for i in range(9)]
    rows += [(60, None), (61, ""), (62, " \n "), (63, "a " * 13), (64, "a " * 40), (65, "a　b " * 14), (66, "é\x0bü " * 20)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [(ids[k], t) for k, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("runs", [5_000, 2])
def test_against_brute_force(docs, seed, runs):
    rows = corpus(random.Random(seed))
    assert found(phrases.remove_repeats(docs(rows), runs)) == brute(rows)


def test_full_alphabet_begins_another_automaton(docs, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(phrases, "LETTERS", 30)
    rng = random.Random(4)
    own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)).encode() for _ in range(3)]
    rows = [(phrases.OWNED, 1, 0, 1, 0, 0, x) for x in own] + [(phrases.RUN, 2, 0, 1, 0, 5, x) for x in own]
    frame = pd.DataFrame(rows, columns=["kind", "doc_id", "key", "owner", "salt", "start", "body"])
    got = pd.concat(phrases._locate(iter([frame])))
    sure = got[got["last"] >= 0]
    assert sure[["first", "last"]].values.tolist() == [[5, 24]] * 3


def test_a_run_with_more_words_than_letters_takes_several_automata(monkeypatch):
    import pandas as pd

    made = []

    class Noted(phrases.Automaton):
        def __init__(self):
            super().__init__()
            made.append(self)

    monkeypatch.setattr(phrases, "LETTERS", 30)
    monkeypatch.setattr(phrases, "Automaton", Noted)
    said = [b"w%d" % i for i in range(200)]
    runs = [(5, said), (0, said[40:53]), *((0, said[k : k + 20]) for k in range(0, 181, 9)), (0, said[:12] + [b"x"] + said[13:25])]
    rows = [(phrases.OWNED, 1, 0, 1, 0, 0, b" ".join(said))]
    rows += [(phrases.RUN, 2 + k, 0, 1, 0, start, b" ".join(some)) for k, (start, some) in enumerate(runs)]
    frame = pd.DataFrame(rows, columns=["kind", "doc_id", "key", "owner", "salt", "start", "body"])
    got = pd.concat(phrases._locate(iter([frame])))
    sure = got[got["last"] >= 0]
    assert sure[["doc_id", "first", "last"]].values.tolist() == [[2 + k, start, start + len(some) - 1] for k, (start, some) in enumerate(runs[:-1])]
    assert len(made) > 1 and all(len(x.letters) <= 30 for x in made)


def test_marks_of_equal_windows_are_equal():
    rng = random.Random(5)
    a, b, c = prose(rng, 30), prose(rng, 17), prose(rng, 25)
    (n, of_a), (m, of_c) = phrases.marks(phrases.Batch.of([f"{a} {b}", f"{b} {c}"]))
    assert (n, m) == (47, 42)
    assert of_a[30:35].tolist() == of_c[:5].tolist()
    alone = list(phrases.marks(phrases.Batch.of([f"{b} {c}"])))
    assert alone[0][1].tolist() == of_c.tolist()


def test_same_id_and_null_ids(docs):
    text = prose(random.Random(6), 30)
    got = phrases.remove_repeats(docs([(3, text), (3, text), (3, text + " more"), (8, text), (None, "x")])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (3, 0), (3, 0), (3, 0), (8, 30)]


def test_long_and_empty(docs):
    long = prose(random.Random(7), 40_000)
    got = found(phrases.remove_repeats(docs([(1, long), (2, "start " + long)])))
    assert [(i, gone) for i, _, gone, _ in got] == [(1, 0), (2, 40_000)]
    assert found(phrases.remove_repeats(docs([]))) == []
    assert found(phrases.remove_repeats(docs([(1, None)]))) == brute([(1, None)])
