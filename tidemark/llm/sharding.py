"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import partitions, small_side
from tidemark.session import materialize, shared_dir

#: A block is a run of rows that one task wrote; it is permuted as a whole.
BLOCK_BITS = 20
#: A record number of ``monotonically_increasing_id`` has 33 bits, below the partition's number.
RECORD_BITS = 33
#: The matrix is drawn for groups of 1,024 partitions first, then inside each group.
GROUP_BITS = 10
#: Rows that one task sorts in the last permutation, about.
BIN_ROWS = 50_000
#: numpy draws exactly below this many rows.
NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` rows, taken from ``good + bad`` without putting back, are good.

    Beyond numpy's limit the distribution is inverted: its probabilities around
    the mode follow from the exact ratio of neighbours, twelve standard
    deviations to each side.
    """
    total = good + bad
    if total < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, drawn)) if total else 0
    return inverted(rng, good, bad, drawn)


def inverted(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    total = good + bad
    low, high = max(0, drawn - bad), min(drawn, good)
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    share = good / total
    reach = 64 + int(12 * np.sqrt(drawn * share * (1 - share) * (total - drawn) / max(total - 1, 1)))
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1, dtype=np.float64)
    ratio = (good - k[:-1]) * (drawn - k[:-1]) / ((k[:-1] + 1) * (bad - drawn + k[:-1] + 1))
    weight = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
    below = np.cumsum(np.exp(weight - weight.max()))
    return int(k[min(np.searchsorted(below, rng.random() * below[-1], side="right"), len(k) - 1)])


def matrix_row(rng: np.random.Generator, free: list[int], rows: int) -> list[int]:
    """How many of ``rows`` rows go to each shard that has ``free`` places (multivariate hypergeometric)."""
    out, places = [], sum(free)
    for room in free:
        places -= room
        took = hypergeometric(rng, room, places, rows)
        out.append(took)
        rows -= took
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Counts that differ by one at most."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def communication_matrix(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """``block, n, upto``: the rows of a block, and running totals of those that each shard gets.

    ``blocks`` has ``block, n``.  A table drawn row by row, each from the places
    that the rows before it have left, is the matrix of a uniform permutation.
    Rows of one group of blocks draw together first, on the driver (one row
    for each 1,024 partitions of the input), then divide what the group got
    among themselves, in a task for each group; that gives the same law.
    """
    spark = blocks.sparkSession
    grouped = blocks.withColumn("team", F.shiftright("block", RECORD_BITS - BLOCK_BITS + GROUP_BITS))
    teams = grouped.groupBy("team").agg(F.sum("n").alias("n")).orderBy("team").collect()
    free = shard_sizes(sum(t.n for t in teams), shards)
    shares = []
    for t in teams:
        got = matrix_row(np.random.default_rng([seed, 0, t.team]), free, t.n)
        free = [f - g for f, g in zip(free, got)]
        shares.append((t.team, got))

    def divide(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, 1, int(key[0])])
        frame = frame.sort_values("block")
        left, upto = [int(x) for x in frame.share.iloc[0]], []
        for n in frame.n:
            got = matrix_row(rng, left, int(n))
            left = [f - g for f, g in zip(left, got)]
            upto.append(np.cumsum(got))
        return pd.DataFrame({"block": frame.block, "n": frame.n, "upto": upto})

    shared = spark.createDataFrame(shares, "team long, share array<long>")
    drawn = grouped.join(shared, "team").groupBy("team").applyInPandas(divide, "block long, n long, upto array<long>")
    return materialize(drawn, "shard-matrix")


@lru_cache(maxsize=2)
def permutation(seed: int, block: int, rows: int) -> np.ndarray:
    return np.random.default_rng([seed, 2, block]).permutation(rows)


def _placed(rows: DataFrame, matrix: DataFrame, seed: int, bins: int) -> DataFrame:
    """``shard``, the random ``key`` of its order there, and the key's ``bin``, for rows with ``block, row``."""

    @F.pandas_udf("long")
    def place(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for block, row, n in parts:
            out = np.empty(len(block), np.int64)
            for b in block.unique():
                here = (block == b).to_numpy()
                out[here] = permutation(seed, int(b), int(n[here].iloc[0]))[row[here]]
            yield pd.Series(out)

    dealt = rows.join(small_side(matrix), "block").withColumn("place", place("block", "row", "n"))
    key = F.xxhash64(F.lit(seed), F.lit("order"), "block", "row")
    return (
        dealt.withColumn("shard", F.size(F.filter("upto", lambda u: u <= F.col("place"))))
        .withColumn("key", key)
        .withColumn("bin", F.shiftright(F.shiftrightunsigned("key", 32) * F.lit(bins).cast("long"), 32))
        .drop("n", "upto", "place")
    )


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    Every arrangement of the rows in the shards' places is equally likely, and
    shard sizes differ by one at most.  The rows are written once with the
    place they were written to; blocks of at most 2**20 of them are the matrix
    rows (:func:`communication_matrix`).  A block is permuted and cut after
    the counts its row of the matrix has.  The rows then go to their shards
    with a random key each; a shard is cut into bins of that key, and a row's
    slot is its rank.  Every draw depends on the seed and the written place
    alone, so a task that runs again gives the same rows.

    Values are never looked at: nulls, empty and very long texts, equal rows
    and rows with equal ids are rows as any other, and copies are not kept
    together.  Columns named ``shard`` or ``slot`` are replaced; all others
    pass.  With fewer rows than shards the last shards are empty; an empty
    table gives no rows.
    """
    spark, names = docs.sparkSession, [c for c in docs.columns if c not in ("shard", "slot")]
    path = shared_dir(spark, "shard-blocks")
    whole = F.struct(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("__row"))
    docs.select(whole.alias("doc"), F.monotonically_increasing_id().alias("at")).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path).select(
        "doc", F.shiftright("at", BLOCK_BITS).alias("block"), F.col("at").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("row")
    )
    matrix = communication_matrix(rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")), shards, seed)
    total = matrix.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bins = max(1, -(-total // (shards * BIN_ROWS)), -(-partitions(spark) // shards))
    sizes = _placed(rows.drop("doc"), matrix, seed, bins).groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialize(sizes.select("shard", "bin", F.coalesce(before, F.lit(0)).alias("start")), "shard-bins")
    rank = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("key", "block", "row"))
    ranked = _placed(rows, matrix, seed, bins).withColumn("rank", rank).join(small_side(starts), ["shard", "bin"])
    return ranked.select(*[F.col(f"doc.`{c}`") for c in names], "shard", (F.col("start") + F.col("rank") - 1).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 0) -> None:
    """The shards as Parquet folders ``shard=0`` and so on; read in file order, each is a uniform shuffle."""
    out = shuffle_into_shards(docs, shards, seed)
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_shards(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's bytes and one more, null counts as empty; the law is
    that of :func:`shuffle_into_shards`, so nothing is said about one more shard.
    """
    dealt = shuffle_into_shards(docs.select("doc_id", "text"), shards, seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
