"""Held-out accuracy on the test tables, and gradients and scores by hand on small ones."""

import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidemark.llm import language, quality, queries, samples, toxicity
from tidemark.llm.features import Batch, class_of, grams, words

TABLES = "/root/testdata/sf0.01"
SMALL = [(1, "some text"), (2, None), (3, ""), (4, "... 123 !!"), (5, "word " * 30_000), (1, "some text"), (None, "no id"), (6, "\U0001f642 あ")]


def joined(df, spark, table):
    known = spark.read.parquet(f"{TABLES}/{table}.parquet")
    return df.join(known.drop("text"), "doc_id").collect()


def test_features_do_not_depend_on_the_batch():
    texts = ["One two. three", "", "x", "Été two two", "  "]
    whole = Batch.of(texts)
    letter = class_of(str.isalpha)
    for i, text in enumerate(texts):
        alone = Batch.of([text])
        a, b = whole.starts[i : i + 2]
        assert whole.codes[a:b].tolist() == alone.codes.tolist()
        seen, own = words(whole.codes, letter[whole.codes]), words(alone.codes, letter[alone.codes])
        inside = (seen.at >= a) & (seen.at < b)
        assert seen.hash[inside].tolist() == own.hash.tolist() and seen.size[inside].tolist() == own.size.tolist()
        at = whole.within(3)
        at = at[(at >= a) & (at < b)]
        assert grams(whole.codes, 3, 16)[at].tolist() == grams(alone.codes, 3, 16)[alone.within(3)].tolist()


def test_language_held_out(spark):
    rows = joined(queries.op2_language_id(spark, TABLES), spark, "documents")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 250 and sum(r.lang_pred == r.lang for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_is_naive_bayes():
    texts, langs = ["aab", "bbc"], ["x", "y"]
    counts = np.full((2, 1 << language.BITS), language.SMOOTHING)
    for k, text in enumerate(texts):
        for _, h in language._grams(Batch.of([text])):
            np.add.at(counts[k], h, 1)
    logs = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    found, odds = language.score_texts(["aab", "", "12", "c"], langs, logs)
    assert found == ["x", "und", "und", "y"] and odds[1] == odds[2] == 0
    sums = [sum(float(logs[k][h].sum()) for _, h in language._grams(Batch.of(["aab"]))) for k in range(2)]
    assert abs(odds[0] - 1 / (1 + np.exp(sums[1] - sums[0]))) < 1e-6


def test_language_edge_cases(docs):
    got = language.identify(docs(SMALL)).collect()
    assert len(got) == len(SMALL)
    assert {r.doc_id: r.lang_pred for r in got} == {1: "en", 2: "und", 3: "und", 4: "und", 5: "en", 6: "en", None: "en"}
    assert language.identify(docs([])).collect() == []
    nothing = docs([(i, "text here") for i in range(6)]).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language.identify(nothing).collect()} == {("und", 0.0)}


def test_quality_held_out(spark):
    rows = joined(queries.op3_quality_classifier(spark, TABLES), spark, "labels")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_quality_reduces_to_a_mean_of_weights():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=quality.KINDS << quality.BITS).astype(np.float32)
    texts = ["One two two three", "", "a"]
    got = quality.score_texts(texts, weights, 0.25)
    for text, score in zip(texts, got, strict=True):
        logit = 0.25
        for _, h in quality.features(Batch.of([text])):
            logit += float(weights[h].astype(float).sum()) / max(1, len(h)) / quality.KINDS
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-9
    pair = [list(h) for _, h in quality.features(Batch.of(["x x x", "b b"]))][1]
    assert pair[1] == pair[2] == pair[4]


def labelled(column, rng, n=120):
    rows = []
    for i in range(n):
        bad = i % 3 == 0
        rows.append((i, prose(rng, 20) + (" | $$$ junk" if bad and column == "quality" else " nasty rotten" if bad else "") + " " + prose(rng, 9)))
    return rows, [(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(n)]


@pytest.mark.parametrize("scorer,column", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_learns_and_handles_every_row(docs, labels, scorer, column):
    rows, known = labelled(column, random.Random(2))
    more = [(i and i + 1000, t) for i, t in SMALL]
    got = scorer(docs(rows + more), labels([*known, (None, 1, 1), (5, None, None), (0, None, 1)])).collect()
    assert len(got) == len(rows) + len(more)
    assert all(r.score is not None and 0 <= r.score <= 1 for r in got)
    truth = {i: (q if column == "quality" else t) for i, q, t in known}
    mine = [r for r in got if r.doc_id in truth and r.held_out]
    high, low = [r.score for r in mine if truth[r.doc_id]], [r.score for r in mine if not truth[r.doc_id]]
    assert len(high) > 5 and len(low) > 5 and np.mean([a > b for a in high for b in low]) > 0.95
    assert scorer(docs([]), labels(known)).collect() == []


@pytest.mark.parametrize("scorer", [quality.score_quality, toxicity.score_toxicity])
def test_without_labels_of_both_classes(docs, labels, scorer):
    one = scorer(docs([(i, "text") for i in range(8)]), labels([(i, 1, 0) for i in range(8)])).collect()
    none = scorer(docs([(1, "text"), (2, None)]), labels([])).collect()
    assert len({r.score for r in one}) == 1 and len(none) == 2


def test_toxicity_on_the_tables(spark):
    """Three hundred labels hold few toxic texts; the order of scores shows that it learns."""
    rows = joined(queries.op6_toxicity(spark, TABLES), spark, "labels")
    bad, good = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([x > y for x in bad for y in good]) > 0.9
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.02 * len(good)


def test_windows_cover_every_word():
    text = " ".join(f"w{i}" for i in range(200))
    seen = toxicity.read([text, "", "one", "same same same"])
    assert len(np.unique(seen.windows[seen.owner == 0][seen.windows[seen.owner == 0] > 0])) == 200
    assert not (seen.owner == 1).any() and (seen.windows[seen.owner == 2] > 0).sum() == 1 and (seen.windows[seen.owner == 3] > 0).sum() == 1


def test_a_passage_of_half_a_window_stands_whole_in_one():
    text = toxicity.read([" ".join(f"w{k}" for k in range(150))])
    order = list(dict.fromkeys(text.windows[text.windows > 0].tolist()))  # windows follow each other as the words do
    assert len(order) == 150
    seen = [set(w.tolist()) for w in text.windows]
    half = toxicity.WINDOW // 2
    assert all(any(set(order[k : k + half]) <= w for w in seen) for k in range(150 - half + 1))


def test_gradients_by_differences():
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    for k in ("word", "char"):
        net.p[k] = rng.normal(0, 0.5, net.p[k].shape)
    text = toxicity.read(["one two three four", "five six " * 30])
    target = np.arange(len(text.windows)) % 2

    def loss():
        logits = net.forward(net.project(net.inputs(text)), text.windows)
        p = toxicity.sigmoid(logits)
        return float(-(target * np.log(p) + (1 - target) * np.log(1 - p)).sum())

    x, kept = net.inputs(text), {}
    logits = net.forward(net.project(x), text.windows, kept)
    slope = net.backward(text, x, text.windows, kept, toxicity.sigmoid(logits) - target)
    for k, g in slope.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        held = net.p[k][at]
        step = 1e-2
        net.p[k][at] = held + step
        up = loss()
        net.p[k][at] = held - step
        down = loss()
        net.p[k][at] = held
        assert abs((up - down) / (2 * step) - g[at]) < 2e-2 * max(1.0, abs(g[at])), k


def test_filter_keeps_columns(docs, labels):
    rows, known = labelled("toxic", random.Random(2))
    df = docs([*rows, (None, None), (900, "nasty rotten nasty"), (901, "")])
    out = toxicity.without_toxic(df, labels(known))
    assert out.columns == df.columns
    left = {r.doc_id for r in out.collect()}
    assert {None, 901} <= left and 900 not in left and len(left & set(range(120))) <= 84


def test_sample_has_one_row_for_each_id(docs, labels):
    rows = [(1, "b"), (1, "a"), (1, None), *[(2, "same")] * 300, (3, "x" * 11), (4, "d")]
    known = samples.labelled(labels([(k, k % 2, None) for k in (1, 2, 3, 4)]), "quality", 1, 1)
    got = samples.draw(docs(rows), known, {0: 10, 1: 10}, 10).collect()
    assert sorted((r.text, r.y) for r in got) == [("b", 1), ("d", 0), ("same", 0)]
