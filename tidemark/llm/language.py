"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every training document: each task sums up a
matrix of languages by buckets, Spark adds the matrices, and the driver gets
one number per language and bucket.  Its logarithms are broadcast; a batch of
texts is scored by looking up the buckets of all its n-grams at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.features import Batch, class_of, grams
from tidemark.llm.texts import bounded, crc_of_id, for_python, id_back

BITS = 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: Characters in one numpy batch.
BATCH = 500_000
UNKNOWN = "und"


def _grams(batch: Batch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and buckets of each order: letters, and letters with the border of their word."""
    letter = class_of(str.isalpha)[batch.codes]
    codes = np.where(letter, batch.codes, np.uint32(0))
    for n in ORDERS:
        h = grams(codes, n, BITS)
        if n == 1:
            at = np.flatnonzero(letter)
        elif n == 2:
            at = np.flatnonzero(letter[:-1] | letter[1:])
        else:  # none with a border inside
            inner = letter[1 : len(h) + 1].copy()
            for i in range(2, n - 1):
                inner &= letter[i : i + len(h)]
            at = np.flatnonzero(inner)
        yield at, h[at]


def _counter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for frame in bounded(frames, "text", BATCH):
        for lang, rows in frame.groupby("lang"):
            total = sums.setdefault(lang, np.zeros(1 << BITS, np.int64))
            for _, h in _grams(Batch.of(rows["text"].str.lower())):
                total += np.bincount(h, minlength=1 << BITS)
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": total[at]})


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities, languages by buckets, from ``text`` and ``lang`` of all rows.

    Rows without a language teach nothing.  The languages of a corpus are a
    short list; the matrix has 65,536 numbers for each.
    """
    known = docs.where(F.col("lang").isNotNull()).select("lang", F.coalesce("text", F.lit("")).alias("text"))
    counted = known.mapInPandas(_counter, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    counts = np.full((len(langs), 1 << BITS), SMOOTHING)
    counts[counted["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int), counted["bucket"].to_numpy()] += counted["n"].to_numpy()
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def score_texts(texts: list[str], langs: list[str], logs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Most likely language of each text and its posterior probability under equal priors."""
    batch = Batch.of([t.lower() for t in texts])
    sums, letters = np.zeros((len(texts), len(langs))), np.zeros(len(texts), np.int64)
    for n, (at, h) in zip(ORDERS, _grams(batch), strict=True):
        if n == 1:
            letters = batch.totals(at)
        for k in range(len(langs)):
            sums[:, k] += batch.totals(at, logs[k][h])
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = sums.argmax(axis=1)
    odds = 1 / np.exp(sums - sums[np.arange(len(texts)), best][:, None]).sum(axis=1)
    return [langs[k] if n else UNKNOWN for k, n in zip(best, letters, strict=True)], np.where(letters > 0, odds, 0.0)


def _scorer(model) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        langs, logs = model.value
        for frame in bounded(frames, "text", BATCH):
            found, odds = score_texts(frame["text"].tolist(), langs, logs)
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "lang_pred": found, "score": odds})

    return score


def identify(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """One row per table row: ``doc_id, held_out, lang_pred, score``.

    Documents whose ``crc32`` of the id leaves ``held_out`` on division by
    ``folds`` never teach.  A text that is null, empty or has no letter gets
    ``und`` and 0; so does every text when nothing could be learned.  Equal
    scores go to the language that sorts first.  Repeated rows and null ids
    come back as given (a null id is not held out, but teaches nothing either).
    Very long texts are scored whole; an empty table gives no rows.
    """
    teaches = docs.where(crc_of_id() % folds != held_out)
    model = docs.sparkSession.sparkContext.broadcast(train(teaches))
    scored = for_python(docs).mapInPandas(_scorer(model), "doc_id long, lang_pred string, score double").withColumn("doc_id", id_back())
    return scored.select("doc_id", F.coalesce(crc_of_id() % folds == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
