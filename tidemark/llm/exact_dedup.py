"""Exact duplicates by 128-bit content hash, with the bytes compared inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import only_texts, small_side
from tidemark.session import materialize


def digest128(text: Column) -> Column:
    return F.md5(text)


def digest256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(
    docs: DataFrame,
    digest: Callable[[Column], Column] = digest128,
    second: Callable[[Column], Column] = digest256,
) -> DataFrame:
    """Groups of at least two rows with identical text: ``d, s, keep_id, group_size, texts[, text]``.

    Rows are grouped by digest first; texts are then shuffled once by digest to
    find those whose digest repeats, and only these are grouped by the text
    itself, which compares bytes.  Both aggregates combine before the shuffle: a group that
    holds a third of the table arrives as one row per task.  ``texts`` counts
    the different texts behind one pair of digests, and ``text`` is kept only
    where it is above one.
    """
    rows = only_texts(docs).withColumn("d", digest(F.col("text")))
    repeated = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d")
    exact = (
        rows.join(repeated, "d", "left_semi")
        .groupBy("d", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .withColumn("s", second(F.col("text")))
        .withColumn("texts", F.count(F.lit(1)).over(Window.partitionBy("d", "s")))
    )
    kept_text = F.when(F.col("texts") > 1, F.col("text")).alias("text")
    return materialize(exact.select("d", "s", "keep_id", "group_size", "texts", kept_text), "exact-groups")


def exact_duplicates(
    docs: DataFrame,
    digest: Callable[[Column], Column] = digest128,
    second: Callable[[Column], Column] = digest256,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_rows``.

    Texts are equal when their bytes are; null counts as empty.  Of equal texts
    the largest ``doc_id`` stays (a null id only where no other exists).
    ``group_size`` counts table rows.  Rows that repeat both id and text are
    one document: it comes back once, with their number in ``n_rows``.  One id
    with two texts is two documents.  Other columns are not read.  An empty
    table gives no rows.
    """
    groups = exact_groups(docs, digest, second)
    rows = only_texts(docs)
    marked = rows.select(
        "doc_id",
        digest(F.col("text")).alias("d"),
        second(F.col("text")).alias("s"),
        digest256(F.col("text")).alias("text_sha256"),
    )
    # more texts than digests: told apart by the texts themselves
    clashes = groups.where("texts > 1")
    clash = not clashes.isEmpty()
    plain = marked.join(clashes.select("d", "s").distinct(), ["d", "s"], "left_anti") if clash else marked
    once = plain.groupBy("doc_id", "d", "s", "text_sha256").agg(F.count(F.lit(1)).alias("n_rows"))
    found = once.join(groups.where("texts = 1").select("d", "s", "keep_id", "group_size"), ["d", "s"], "left")
    out = _decided(found)
    if clash:
        texts = rows.withColumn("d", digest(F.col("text"))).groupBy("doc_id", "d", "text").agg(F.count(F.lit(1)).alias("n_rows"))
        split = texts.join(clashes.select("d", "text", "keep_id", "group_size"), ["d", "text"])
        out = out.unionByName(_decided(split.withColumn("text_sha256", digest256(F.col("text")))))
    return out


def _decided(rows: DataFrame) -> DataFrame:
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce(F.col("group_size"), F.col("n_rows")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
        "n_rows",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_duplicates` keeps.

    Only documents to drop, and documents whose rows repeat, are joined back;
    a document without a copy passes untouched.  Of rows that repeat id and
    text, one stays.
    """
    key = digest256(F.coalesce(F.col("text"), F.lit("")))
    decided = exact_duplicates(docs).where("group_size > 1").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("kept").alias("__kept"), F.col("n_rows").alias("__n")
    )
    decided = materialize(decided, "exact-decided")

    def matching(rows: DataFrame):
        return docs["doc_id"].eqNullSafe(rows["__id"]) & (key == rows["__sha"])

    drop_or_repeat = decided.where("not __kept or __n > 1")
    out = docs.join(small_side(drop_or_repeat), matching(drop_or_repeat), "left_anti")
    repeated = decided.where("__kept and __n > 1")
    if not repeated.isEmpty():
        out = out.unionByName(docs.join(repeated, matching(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))
    return out


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256,
       count(*) OVER (PARTITION BY body, doc_id) AS n_rows
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""
