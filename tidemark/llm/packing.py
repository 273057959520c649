"""Packing documents into sequences of a fixed length by exact complements, then best fit.

Only how many pieces there are of each length decides the plan, so the plan is
made from a histogram of at most ``capacity`` numbers and never from rows.
Pieces of one length are numbered, and the plan says for a run of numbers
which sequence and offset it goes to.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import encoder
from tidemark.llm.texts import bounded, for_python, id_back, partitions
from tidemark.session import materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"
BATCH = 8_000_000


@dataclass
class Plan:
    """Runs of equal pieces and where they go; as many runs as lengths and gaps, whatever the number of pieces."""

    capacity: int
    left: np.ndarray
    taken: np.ndarray = field(init=False)
    sequences: int = 0
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.taken = np.zeros_like(self.left)

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        """The next ``count`` pieces of a length, one to a sequence from ``sequence`` on."""
        first = int(self.taken[length])
        self.runs.append((length, first, first + count, sequence, offset))
        self.taken[length] += count
        self.left[length] -= count

    def fill(self, parts: tuple[int, ...]) -> None:
        """As many full sequences of these lengths as there are pieces for."""
        count = min(int(self.left[x]) // n for x, n in Counter(parts).items())
        offset = 0
        for x in parts:
            self.put(x, count, self.sequences, offset)
            offset += x
        self.sequences += count


class Sums:
    """Index from a sum to the single lengths, pairs and triples of lengths that give it, under the counts ``left``.

    Pairs are listed by their sum, the most uneven first.  A triple is a first
    length, largest first, with an entry of the pairs' list for the rest, so
    triples take no memory of their own.  Counts only fall: what is used up
    never comes back, and each list has a place before which all is used up.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        self.lengths = np.flatnonzero(left)[::-1]
        self.pairs = [self._pairs(total) for total in range(len(left))]
        self.pair_at, self.triple_at = [0] * len(left), [0] * len(left)
        self.firsts = self.lengths.tolist()

    def _pairs(self, total: int) -> list[int]:
        """The larger parts of the pairs with this sum."""
        large = self.lengths[(self.lengths < total) & (2 * self.lengths >= total)]
        return large[self.left[total - large] > 0].tolist()

    def free(self, *parts: int) -> bool:
        return all(self.left[x] >= parts.count(x) for x in parts)

    def pair(self, total: int, *held: int) -> tuple[int, int] | None:
        """The first free pair while pieces of the lengths ``held`` are taken."""
        if total < 2:
            return None
        found, at = self.pairs[total], self.pair_at[total]
        while at < len(found) and not self.free(found[at], total - found[at]):
            at += 1
        self.pair_at[total] = at
        for k in range(at, len(found)):
            if self.free(found[k], total - found[k], *held):
                return found[k], total - found[k]
        return None

    def triple(self, total: int, *held: int) -> tuple[int, int, int] | None:
        at = self.triple_at[total]
        while at < len(self.firsts) and not (self.left[self.firsts[at]] and self.pair(total - self.firsts[at], self.firsts[at])):
            at += 1
        self.triple_at[total] = at
        for first in self.firsts[at:]:
            if first < total - 1 and self.free(first, *held) and (pair := self.pair(total - first, first, *held)):
                return (first, *pair)
        return None

    def complement(self, gap: int, *held: int) -> tuple[int, ...] | None:
        """One, two or three free lengths that fill a gap exactly."""
        if gap and self.left[gap] and self.free(gap, *held):
            return (gap,)
        return self.pair(gap, *held) or self.triple(gap, *held)


def make_plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Exact complements from the longest pieces down, best fit for what is left."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    plan = Plan(capacity, left)
    if left[capacity]:
        plan.fill((capacity,))
    sums = Sums(left)
    for length in range(capacity - 1, 0, -1):
        while left[length] and (parts := sums.complement(capacity - length, length)):
            plan.fill((length, *parts))
    open_bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    for length in range(capacity - 1, 0, -1):
        while count := int(left[length]):
            gap = next((g for g in range(length, capacity) if open_bins[g]), None)
            if gap is None:  # new sequences, each with as many pieces of this length as it holds
                deep = min(capacity // length, count)
                wide = count // deep
                for i in range(deep):
                    plan.put(length, wide, plan.sequences, i * length)
                open_bins[capacity - deep * length].append((plan.sequences, plan.sequences + wide))
                plan.sequences += wide
                continue
            first, last = open_bins[gap].pop()
            count = min(count, last - first)
            plan.put(length, count, first, capacity - gap)
            if first + count < last:
                open_bins[gap].append((first + count, last))
            open_bins[gap - length].append((first, first + count))
    return plan


def _cutter(content: bytes, end: int, capacity: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder.encoder(content)
        last = np.array([end], coder.dtype).tobytes()
        for frame in bounded(frames, "text", BATCH):
            rows = []
            for doc_id, raw in zip(frame["doc_id"].tolist(), coder.encode(frame["text"].tolist()), strict=True):
                ids = np.frombuffer(raw + last, coder.dtype).astype("<u4")
                head = len(ids) % capacity or capacity
                edges = [0, *range(head, len(ids) + 1, capacity)]
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """Every document's ids with the end id, cut where longer than ``capacity``; the first piece takes the rest."""
    cut = for_python(docs).mapInPandas(_cutter(encoder.load(tokenizer_path), end_id, capacity), PIECES)
    return materialize(cut.select(id_back(), "piece", "start", "length", "ids_crc32"), "pieces")


def _placer(plan: Plan) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds = {int(x): np.searchsorted(runs[:, 0], [x, x + 1]) for x in np.unique(runs[:, 0])}
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            at = np.zeros(len(frame), np.int64)
            for x in np.unique(length).tolist():
                a, b = bounds[x]
                mine = length == x
                at[mine] = a + np.searchsorted(runs[a:b, 1], rank[mine], side="right") - 1
            frame["sequence_id"] = runs[at, 3] + rank - runs[at, 1]
            frame["offset"] = runs[at, 4]
            yield frame.drop(columns=["rank"])

    return place


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null text is empty and has the end id alone.  Every table row is packed,
    so repeated rows and null ids are packed as often as they are given.  A
    length that a third of all pieces share is numbered in many buckets, each
    from its own start, so no task holds it whole.  An empty table gives no
    rows; other columns are not read.
    """
    cut = pieces(docs, tokenizer_path, end_id, capacity)
    buckets = partitions(docs.sparkSession)
    spread = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = spread.withColumn("at", F.row_number().over(within) - 1).join(starts, ["length", "bucket"])
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    safe = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id")
    columns = ranked.select(safe, "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("at")).alias("rank"))
    placed = columns.mapInPandas(_placer(make_plan(histogram, capacity)), PLACED)
    return placed.withColumn("doc_id", id_back())
