"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows of words.

Every word enters as the vector of its own bucket beside the mean vector of
its hashed character n-grams, so new words with a known stem are recognised.
The network reads overlapping windows that cover the whole text; a text scores
as its worst window.  It is trained in numpy on a bounded sample: a toxic label
belongs to a document, so after a first pass over all windows only the worst
window of a toxic document counts as toxic.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import Batch, Words, class_of, fold, grams, words
from tidemark.llm.samples import draw, labelled
from tidemark.llm.texts import bounded, crc_of_id, for_python, id_back, small_side
from tidemark.session import materialize

WORD_BITS, CHAR_BITS = 15, 15
ORDERS = (3, 4, 5)
#: Words of a window, and from one window to the next: a passage of up to half a window stands whole in one.
WINDOW, STEP = 32, 16
WIDTH, HIDDEN = 8, 8
#: Characters and windows in one numpy batch.
BATCH, ROWS = 500_000, 4096


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the labelled documents (class 0, class 1) that are learned from.

    The share ``calibrate`` of them only sets the scale of the scores.  A small
    sample is gone through again and again until there were ``steps`` steps.
    """

    per_class: tuple[int, int] = (2400, 1000)
    max_chars: int = 10_000
    rounds: int = 5
    batch: int = 192
    steps: int = 400
    calibrate: float = 0.25
    rate: float = 0.01
    seed: int = 11


@dataclass
class Text:
    """The different words of a batch, as buckets, and every window as word numbers (0: no word)."""

    word: np.ndarray
    chars: np.ndarray
    chars_of: np.ndarray
    windows: np.ndarray
    owner: np.ndarray


def once(seen: Words, edges: np.ndarray) -> Words:
    """A word that directly repeats itself counts once; ``edges`` are the texts' first words."""
    new = np.ones(len(seen.at), bool)
    new[1:] = seen.hash[1:] != seen.hash[:-1]
    new[edges[edges < len(new)]] = True
    return Words(seen.at[new], seen.size[new], seen.hash[new])


def read(texts: list[str]) -> Text:
    batch = Batch.of([t.lower() for t in texts])
    codes = batch.codes
    seen = words(codes, class_of(str.isalnum)[codes])
    seen = once(seen, np.searchsorted(seen.at, batch.starts))
    hashes, first, number = np.unique(seen.hash, return_index=True, return_inverse=True)
    at, size = seen.at[first] - 1, seen.size[first] + 2  # with the border on both sides
    chars, of = [], []
    for n in ORDERS:
        h = grams(codes, n, CHAR_BITS)
        count = np.maximum(0, size - n + 1)
        place = np.repeat(at - (np.cumsum(count) - count), count) + np.arange(count.sum())
        chars.append(h[place])
        of.append(np.repeat(np.arange(len(first)), count))
    chars_of = np.concatenate(of)
    order = np.argsort(chars_of, kind="stable")
    counts = batch.totals(seen.at)
    n_windows = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STEP)) + 1, 0)
    owner = np.repeat(np.arange(len(texts)), n_windows)
    begin = (np.cumsum(counts) - counts)[owner] + (np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)) * STEP
    end = np.cumsum(counts)[owner]
    place = begin[:, None] + np.arange(WINDOW)
    windows = np.where(place < end[:, None], np.append(number + 1, 0)[np.minimum(place, len(number))], 0)
    return Text(fold(hashes, WORD_BITS), np.concatenate(chars).astype(np.int64)[order], chars_of[order], windows, owner)


def sums_by(keys: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Row sums of ``values`` for each key below ``size``."""
    out = np.zeros((size, values.shape[1]), np.float32)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.diff(keys[order], prepend=-1))
        out[keys[order][first]] = np.add.reduceat(values[order], first)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name; ``forward`` keeps what ``backward`` needs only if asked to."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)

        def draw_(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        inputs = 2 * WIDTH
        self.p = {
            "word": draw_(1 << WORD_BITS, WIDTH, scale=0.01),
            "char": draw_(1 << CHAR_BITS, WIDTH, scale=0.05),
            "attend": draw_(2 * HIDDEN, scale=0.3),
            "out": draw_(2 * HIDDEN, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        for way in ("f", "b"):
            self.p[f"in_{way}"] = draw_(inputs, 3 * HIDDEN, scale=inputs**-0.5)
            self.p[f"base_{way}"] = np.zeros(3 * HIDDEN, np.float32)
            self.p[f"state_{way}"] = draw_(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)

    def inputs(self, text: Text) -> np.ndarray:
        """A vector for each different word, and zeros first for no word."""
        n = len(text.word)
        total = np.zeros((n, WIDTH), np.float32)
        counts = np.bincount(text.chars_of, minlength=n)
        if len(text.chars):
            has = np.flatnonzero(counts)
            total[has] = np.add.reduceat(self.p["char"][text.chars], (np.cumsum(counts) - counts)[has])
        x = np.concatenate([self.p["word"][text.word], total / np.maximum(1, counts)[:, None]], axis=1)
        return np.concatenate([np.zeros((1, 2 * WIDTH), np.float32), x])

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What a word adds to the gates of either direction, once for each different word."""
        return {way: x @ self.p[f"in_{way}"] + self.p[f"base_{way}"] for way in ("f", "b")}

    def run(self, way: str, projected: np.ndarray, windows: np.ndarray, keep: list | None) -> np.ndarray:
        h = np.zeros((len(windows), HIDDEN), np.float32)
        out = np.zeros((WINDOW, len(windows), HIDDEN), np.float32)
        state = self.p[f"state_{way}"]
        for t in range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1):
            word = windows[:, t]
            x, u = projected[word], h @ state
            gates = sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            there = (word > 0)[:, None]
            if keep is not None:
                keep.append((t, h, z, r, n, u[:, 2 * HIDDEN :], there))
            h = np.where(there, new, h)
            out[t] = h
        return out

    def forward(self, projected: dict[str, np.ndarray], windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        steps = {way: [] if keep is not None else None for way in ("f", "b")}
        both = np.concatenate([self.run(way, projected[way], windows, steps[way]) for way in ("f", "b")], axis=2)
        weight = both @ self.p["attend"]
        weight = np.where(windows.T > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (both * weight[:, :, None]).sum(axis=0)
        if keep is not None:
            keep.update(steps=steps, both=both, weight=weight, pooled=pooled)
        return pooled @ self.p["out"] + self.p["bias"][0]

    def backward(self, text: Text, x: np.ndarray, windows: np.ndarray, kept: dict, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the loss, whose derivative by the windows' logits is ``slope``."""
        both, weight = kept["both"], kept["weight"]
        grad = {"out": kept["pooled"].T @ slope, "bias": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * self.p["out"]
        d_weight = (both * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grad["attend"] = np.tensordot(d_score, both, ([0, 1], [0, 1]))
        d_both = weight[:, :, None] * d_pooled + d_score[:, :, None] * self.p["attend"]
        dx = np.zeros_like(x)
        for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            state, inward = self.p[f"state_{way}"], self.p[f"in_{way}"]
            d_state, d_gates = np.zeros_like(state), np.empty((WINDOW, len(windows), 3 * HIDDEN), np.float32)
            dh = np.zeros((len(windows), HIDDEN), np.float32)
            for t, h, z, r, n, u, there in reversed(kept["steps"][way]):
                dh = dh + d_both[t, :, part]
                d_new = np.where(there, dh, 0)
                d_n = d_new * (1 - z) * (1 - n * n)
                d_z = d_new * (h - n) * z * (1 - z)
                d_r = d_n * u * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_state += h.T @ d_u
                d_gates[t] = np.concatenate([d_z, d_r, d_n], axis=1)
                dh = np.where(there, 0, dh) + d_new * z + d_u @ state.T
            d_gate_of = sums_by(windows.T.ravel(), d_gates.reshape(-1, 3 * HIDDEN), len(x))
            d_gate_of[0] = 0
            grad[f"state_{way}"], grad[f"in_{way}"], grad[f"base_{way}"] = d_state, x.T @ d_gate_of, d_gate_of.sum(axis=0)
            dx += d_gate_of @ inward.T
        dx = dx[1:]
        grad["word"] = sums_by(text.word, dx[:, :WIDTH], 1 << WORD_BITS)
        counts = np.maximum(1, np.bincount(text.chars_of, minlength=len(text.word)))
        grad["char"] = sums_by(text.chars, (dx[:, WIDTH:] / counts[:, None])[text.chars_of], 1 << CHAR_BITS)
        return grad

    def logits(self, text: Text) -> np.ndarray:
        projected = self.project(self.inputs(text))
        parts = [self.forward(projected, text.windows[i : i + ROWS]) for i in range(0, len(text.windows), ROWS)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def some_windows(text: Text, rows: np.ndarray) -> tuple[Text, np.ndarray]:
    """Only the words that these windows use, numbered anew."""
    windows = text.windows[rows]
    used = np.unique(windows)
    used = used[used > 0]
    number = np.zeros(len(text.word) + 1, np.int64)
    number[used] = np.arange(1, len(used) + 1)
    wanted = number[text.chars_of + 1]
    has = wanted > 0
    return Text(text.word[used - 1], text.chars[has], wanted[has] - 1, number[windows], text.owner[rows]), rows


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.n = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grad: dict[str, np.ndarray]) -> None:
        self.n += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.n) / (1 - 0.9**self.n)
        for k, g in grad.items():
            rows = np.flatnonzero(g.any(axis=1)) if k in ("word", "char") else slice(None)
            g = g[rows]
            self.m[k][rows] = 0.9 * self.m[k][rows] + 0.1 * g
            self.v[k][rows] = 0.999 * self.v[k][rows] + 0.001 * g * g
            self.p[k][rows] -= scale * self.m[k][rows] / (np.sqrt(self.v[k][rows]) + 1e-7)


def fit(texts: list[str], labels: np.ndarray, settings: Settings) -> Network:
    """Windows of toxic documents count as toxic in the first round, afterwards only the worst of each."""
    net, rng = Network(settings.seed), np.random.default_rng(settings.seed)
    text = read(texts)
    if not len(text.windows):
        return net
    toxic = labels[text.owner] == 1
    adam = Adam(net.p, settings.rate)
    for turn in range(settings.rounds):
        positive, negative = np.flatnonzero(toxic), np.flatnonzero(~toxic)
        if turn:
            logits = net.logits(text)
            order = np.lexsort((-logits, text.owner))
            worst = order[np.diff(text.owner[order], prepend=-1) > 0]
            positive = np.union1d(worst[toxic[worst]], positive[logits[positive] > 2])
            hard = worst[~toxic[worst]]
            extra = rng.permutation(negative)[: 2 * len(positive)]
            negative = np.union1d(hard, extra)
        else:
            negative = rng.permutation(negative)[: 2 * len(positive)]
        rows = np.concatenate([positive, negative])
        size = min(settings.batch, max(32, len(rows) // 8))
        again = -(-settings.steps // (settings.rounds * max(1, len(rows) // size)))
        rows = np.concatenate([rng.permutation(rows) for _ in range(again)])
        adam.rate = settings.rate * (1 - turn / settings.rounds)
        for some in np.array_split(rows, max(1, len(rows) // size)):
            part, _ = some_windows(text, some)
            x, kept = net.inputs(part), {}
            logits = net.forward(net.project(x), part.windows, kept)
            slope = ((sigmoid(logits) - toxic[some]) / len(some)).astype(np.float32)
            adam.step(net.backward(part, x, part.windows, kept, slope))
    return net


def worst_windows(texts: list[str], net: Network) -> np.ndarray:
    """Highest logit of each text's windows; minus infinity without a word."""
    text = read(texts)
    worst = np.full(len(texts), -np.inf)
    if len(text.windows):
        first = np.flatnonzero(np.diff(text.owner, prepend=-1))
        worst[text.owner[first]] = np.maximum.reduceat(net.logits(text), first)
    return worst


def calibrate(logits: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift that turn logits into probabilities: logistic regression by Newton steps.

    The targets lie a little inside 0 and 1, so that separable scores get a
    finite scale and the border lies between the classes.
    """
    n = np.bincount(labels, minlength=2)
    target = np.where(labels == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    x = np.stack([logits, np.ones(len(logits))], axis=1)
    found = np.array([0.1, 0.0])
    for _ in range(100):
        p = sigmoid(x @ found)
        slope = x.T @ (weight * (p - target)) + 1e-4 * found
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        found -= step * min(1.0, 2.0 / np.abs(step * [10, 1]).max())
    return (float(found[0]), float(found[1])) if found[0] > 0 else (1.0, 0.0)


def score_texts(texts: list[str], model: tuple[Network, float, float]) -> np.ndarray:
    """The worst window's probability; 0 without a word."""
    net, scale, shift = model
    worst = worst_windows(texts, net)
    return np.where(np.isfinite(worst), 1 / (1 + np.exp(-np.clip(scale * worst + shift, -60, 60))), 0.0)


def learn(texts: list[str], labels: np.ndarray, share: float, settings: Settings) -> tuple[Network, float, float]:
    """Network, scale and shift; ``share`` is that of toxic documents in all labels."""
    later = np.arange(len(texts)) % round(1 / settings.calibrate) == 0
    if min(np.bincount(labels[later], minlength=2)) < 5:  # too few to set some aside
        later = np.ones(len(texts), bool)
        earlier = later
    else:
        earlier = ~later
    net = fit([t for t, yes in zip(texts, earlier, strict=True) if yes], labels[earlier], settings)
    logits = worst_windows([t for t, yes in zip(texts, later, strict=True) if yes], net)
    seen = np.isfinite(logits)
    y = labels[later][seen]
    if len(np.unique(y)) < 2:
        return net, 1.0, 0.0
    weight = np.where(y == 1, share / (y == 1).mean(), (1 - share) / (y == 0).mean())
    return (net, *calibrate(logits[seen], y, weight))


def train(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, settings: Settings) -> tuple[Network, float, float] | None:
    """The model, or None without labels of both classes; one task learns from the sample, whose size is bounded."""
    known = labelled(labels, "toxic", folds, held_out)
    sample = draw(docs, known, dict(enumerate(settings.per_class)), settings.max_chars)
    share = known.agg(F.avg("y")).first()[0]
    learned = sample.repartition(1).mapInPandas(_learner(share, settings), "model binary").first()
    return pickle.loads(learned["model"]) if learned else None


def _learner(share: float | None, settings: Settings) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(frames)
        sample = pd.concat(held).sort_values("key", ignore_index=True) if held else None
        if sample is not None and sample["y"].nunique() == 2:
            model = learn(sample["text"].tolist(), sample["y"].to_numpy(), share, settings)
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    return run


def _scorer(model) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learned = model.value
        for frame in bounded(frames, "text", BATCH):
            texts = frame["text"].tolist()
            found = score_texts(texts, learned) if learned else np.zeros(len(texts))
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "key": frame["key"].to_numpy(), "score": found})

    return score


def score_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.5, settings: Settings = Settings()
) -> DataFrame:
    """One row per table row: ``doc_id, held_out, score, predicted``.

    Labels of documents whose ``crc32`` of the id leaves ``held_out`` on
    division by ``folds`` teach nothing.  Null texts and texts without a word
    score 0.  Every word of a text lies in a window, however long the text.
    Without labels of both classes nothing can be learned and all score 0.
    Repeated rows and null ids come back as given, an empty table gives none.
    """
    return scored_texts(docs, labels, folds, held_out, threshold, settings).drop("key")


def scored_texts(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.5, settings: Settings = Settings()
) -> DataFrame:
    """:func:`score_toxicity` with a hash of the text, ``key``, that tells texts under one id apart."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, folds, held_out, settings))
    keyed = for_python(docs).withColumn("key", F.xxhash64("text"))
    scored = keyed.mapInPandas(_scorer(model), "doc_id long, key long, score double").withColumn("doc_id", id_back())
    fold_of = F.coalesce(crc_of_id() % folds == held_out, F.lit(False))
    return scored.select("doc_id", "key", fold_of.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the classifier does not reject."""
    bad = scored_texts(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    bad = materialize(bad.distinct(), "toxic")
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(small_side(bad), docs["doc_id"].eqNullSafe(bad["__id"]) & (key == bad["__key"]), "left_anti")
