"""Connected components of links by alternating stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

ROUNDS = 60


def _pointed(edges: DataFrame) -> DataFrame:
    """Each node of ``u -> v`` with the smallest ``v``; combined before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of the pairs ``a, b``.

    A round lets every node point its larger neighbours, then all smaller ones
    and itself, to the smallest it sees.  Only grouped minima and joins are
    used, so a node with very many links is one row after the partial
    aggregate, and Spark splits it in the join.  Each round is written, which
    cuts the lineage; the number of rounds grows with the logarithm of the
    longest chain.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = materialize(links.select(high.alias("u"), low.alias("v")).where("u <> v").distinct(), "star")
    before = None
    for _ in range(ROUNDS):
        if (now := _state(edges)) == before:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = _pointed(both.unionByName(both.select("u", F.col("u").alias("v"))))
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "star")
        least = _pointed(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialize(small, "star")
    else:
        raise RuntimeError(f"links are not joined after {ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return _pointed(edges).select(F.col("u").alias("node"), F.col("m").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two sums over them, which stay as they are once nothing changes."""
    sums = [F.sum(F.pmod(F.xxhash64(F.lit(i), "u", "v"), F.lit(1 << 40))) for i in range(2)]
    return tuple(edges.agg(F.count(F.lit(1)), *sums).first())
