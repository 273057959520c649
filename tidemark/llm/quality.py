"""Quality classifier: learned vectors of hashed words and character n-grams, averaged over a document.

The average goes through a softmax of two classes; vectors and output are
learned by stochastic gradient descent in numpy on a bounded sample of labelled
documents.  Since averaging is linear, the trained model reduces to one number
per bucket, and a text of any length is scored by a lookup and a mean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import WIDE, Batch, class_of, fold, grams, words
from tidemark.llm.samples import draw, labelled, prior_shift
from tidemark.llm.texts import bounded, crc_of_id, for_python, id_back

BITS = 15
#: Words, pairs of words, and characters of each order have buckets of their own.
ORDERS = (2, 3, 4)
KINDS = 2 + len(ORDERS)
BATCH = 500_000
REPEATED = np.uint64(1)


def features(batch: Batch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and buckets of each kind of feature; case and punctuation count."""
    codes = batch.codes
    seen = words(codes, ~class_of(str.isspace)[codes])
    yield seen.at, fold(seen.hash, BITS)
    if len(seen.at):
        # a pair belongs to its second word; a word beside itself is one feature, whatever the word
        before = np.concatenate([[np.uint64(0)], seen.hash[:-1]])
        before[np.searchsorted(seen.at, batch.starts[:-1][batch.totals(seen.at) > 0])] = 0
        pair = np.where(before == seen.hash, REPEATED, before * WIDE + seen.hash)
        yield seen.at, fold(pair, BITS) + (1 << BITS)
    else:
        yield seen.at, np.zeros(0, np.int64)
    for k, n in enumerate(ORDERS):
        at = batch.within(n)
        yield at, grams(codes, n, BITS)[at].astype(np.int64) + ((2 + k) << BITS)


def _sparse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Buckets and their shares of each kind, for training."""
    for frame in frames:
        rows = []
        for text in frame["text"]:
            batch = Batch.of([text])
            at, share = [], []
            for _, h in features(batch):
                found, n = np.unique(h, return_counts=True)
                at.append(found)
                share.append(n / max(1, len(h)) / KINDS)
            rows.append((np.concatenate(at).astype("<i4").tobytes(), np.concatenate(share).astype("<f4").tobytes()))
        yield pd.DataFrame(rows, columns=["at", "share"]).assign(y=frame["y"].to_numpy(), key=frame["key"].to_numpy())


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled documents that are learned from."""

    per_class: int = 3000
    max_chars: int = 50_000
    width: int = 16
    epochs: int = 6
    batch: int = 32
    rate: float = 0.3
    seed: int = 7


def fit(rows: pd.DataFrame, settings: Settings) -> tuple[np.ndarray, float]:
    """Logit of class 1 as one weight per bucket and a constant."""
    rng = np.random.default_rng(settings.seed)
    size = KINDS << BITS
    vectors = rng.uniform(-1, 1, (size, settings.width)).astype(np.float32) / settings.width
    out = np.zeros((settings.width, 2), np.float32)
    bias = np.zeros(2, np.float32)
    square_v, square_o, square_b = np.full(size, 1e-6, np.float32), np.full_like(out, 1e-6), np.full_like(bias, 1e-6)
    at = [np.frombuffer(x, "<i4") for x in rows["at"]]
    share = [np.frombuffer(x, "<f4") for x in rows["share"]]
    labels = rows["y"].to_numpy()
    for _ in range(settings.epochs):
        order = rng.permutation(len(labels))
        for some in np.array_split(order, max(1, len(order) // settings.batch)):
            some = [i for i in some if len(at[i])]
            if not some:
                continue
            index, weight = np.concatenate([at[i] for i in some]), np.concatenate([share[i] for i in some])
            sizes = np.array([len(at[i]) for i in some])
            mean = np.add.reduceat(vectors[index] * weight[:, None], np.cumsum(sizes) - sizes)
            logits = mean @ out + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            odds[np.arange(len(some)), labels[some]] -= 1
            odds /= len(some)
            back = np.repeat(odds @ out.T, sizes, axis=0) * weight[:, None]
            for value, square, slope in ((out, square_o, mean.T @ odds), (bias, square_b, odds.sum(axis=0))):
                square += slope**2
                value -= settings.rate * slope / np.sqrt(square)
            touched, places = np.unique(index, return_inverse=True)
            slope = np.zeros((len(touched), settings.width), np.float32)
            np.add.at(slope, places, back)
            square_v[touched] += (slope**2).mean(axis=1)
            vectors[touched] -= settings.rate * slope / np.sqrt(square_v[touched])[:, None]
    weights = vectors @ (out[:, 1] - out[:, 0])
    return weights.astype(np.float32), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, settings: Settings) -> tuple[np.ndarray, float]:
    known = labelled(labels, "quality", folds, held_out)
    sample = draw(docs, known, {0: settings.per_class, 1: settings.per_class}, settings.max_chars)
    rows = sample.mapInPandas(_sparse, "at binary, share binary, y int, key long").toPandas().sort_values("key", ignore_index=True)
    if rows["y"].nunique() < 2:  # one class or none: its share is all that can be said
        return np.zeros(KINDS << BITS, np.float32), 0.0 if rows.empty else 10.0 * (2 * int(rows["y"][0]) - 1)
    weights, constant = fit(rows, settings)
    return weights, constant + prior_shift(known, rows["y"].value_counts().to_dict())


def score_texts(texts: list[str], weights: np.ndarray, constant: float) -> np.ndarray:
    batch = Batch.of(texts)
    logits = np.full(len(texts), constant)
    for at, h in features(batch):
        logits += batch.totals(at, weights[h]) / np.maximum(1, batch.totals(at)) / KINDS
    return 1 / (1 + np.exp(-logits))


def _scorer(model) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, constant = model.value
        for frame in bounded(frames, "text", BATCH):
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "score": score_texts(frame["text"].tolist(), weights, constant)})

    return score


def score_quality(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3, settings: Settings = Settings()
) -> DataFrame:
    """One row per table row: ``doc_id, held_out, score, predicted``.

    Labels of documents whose ``crc32`` of the id leaves ``held_out`` on
    division by ``folds`` teach nothing.  Null and empty texts get the score of
    a text without any word; every text is scored whole.  Without labels of
    both classes every text gets the same score: that of the one class, or 0.5.
    Repeated rows and null ids come back as given, an empty table gives none.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds, held_out, settings))
    scored = for_python(docs).mapInPandas(_scorer(model), "doc_id long, score double").withColumn("doc_id", id_back())
    fold_of = F.coalesce(crc_of_id() % folds == held_out, F.lit(False))
    return scored.select("doc_id", fold_of.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
