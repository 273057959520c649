"""Bounded samples of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import crc_of_id


def labelled(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """``doc_id, y`` of labelled rows outside the held-out fold; of several labels the largest counts."""
    known = labels.where(F.col(label).isNotNull() & (crc_of_id() % folds != held_out))
    return known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))


def draw(docs: DataFrame, known: DataFrame, per_class: dict[int, int], max_chars: int) -> DataFrame:
    """``text, y, key`` of at most ``per_class[y]`` labelled documents of each class, in the order of a hash of the id.

    The ids come from all labels; only they and their number bound what is
    read further, so the small side of the join is broadcast.  Of several rows
    under an id the largest text counts, so there is one row for each id.
    Texts above ``max_chars`` are not learned from (they are scored like all
    others).
    """
    key = F.xxhash64("doc_id")
    picked = [known.where(F.col("y") == y).withColumn("key", key).orderBy("key", "doc_id").limit(n) for y, n in per_class.items()]
    ids = picked[0]
    for more in picked[1:]:
        ids = ids.unionByName(more)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= max_chars)
    joined = texts.join(F.broadcast(ids), "doc_id")
    return joined.groupBy("doc_id", "y", "key").agg(F.max("text").alias("text")).select("text", "y", "key")


def prior_shift(known: DataFrame, drawn: dict[int, int]) -> float:
    """What to add to a logit learned on the sample so that it fits the classes' shares in all labels."""
    import math

    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(drawn.get(y) and n.get(y) for y in (0, 1)):
        return 0.0
    return math.log(n[1] / n[0]) - math.log(drawn[1] / drawn[0])
