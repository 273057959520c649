"""Benchmark decontamination on a positional inverted index, in DataFrame operations only.

One pass over the documents stores the postings (term, document, position) of
every benchmark term, as Parquet.  Their counts say which terms of a benchmark
window are rare.  Lists of the rarest terms are shifted by the term's place in
the window and intersected, which leaves few candidate places; these are
intersected with the lists of all other terms of the window, so that what
remains are exact occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import small_side
from tidemark.session import materialize

#: Words of a window (60 at most); a shorter item is one window.
WINDOW = 10
#: How many of a window's rarest terms find its candidates.
RAREST = 3
#: Every character outside of words (fixed value of the word pattern).
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str = "text") -> Column:
    """Lower-cased (A-Z) words in order; none for null."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, BETWEEN), lambda w: w != "")


def item_words(benchmark: DataFrame) -> DataFrame:
    """``item, at, word``: repeated rows of an item are one, and every text under an id is an item of that id."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    known = items.withColumn("item", F.sha2(F.concat_ws(" ", F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text"), 256))
    return known.select("item_id", "item", F.posexplode(words()).alias("at", "word"))


def windows(terms: DataFrame, size: int) -> DataFrame:
    """``item, window, length, at, term``: a row for each word of each window of each item."""
    lengths = terms.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    placed = terms.join(lengths, "item")
    length = F.least(F.col("n"), F.lit(size))
    first = F.greatest(F.lit(0), F.col("at") - length + 1)
    last = F.least(F.col("at").cast("long"), F.col("n") - length)
    starts = placed.select("item_id", "item", "term", "at", length.alias("length"), F.explode(F.sequence(first.cast("long"), last)).alias("start"))
    window = F.xxhash64("item", "start")
    return starts.select("item_id", "item", window.alias("window"), "length", (F.col("at") - F.col("start")).alias("at"), "term")


class Index:
    """Postings of the benchmark's terms in the documents, and the number of words of each document."""

    def __init__(self, docs: DataFrame, terms: DataFrame):
        """``terms`` has ``word`` and its number ``term``.

        A word beyond the last stands for the end of a document, so that its
        position is the number of words and every document leaves a row.
        """
        end = docs.sparkSession.createDataFrame([("", -1)], "word string, term long")
        wanted = terms.unionByName(end)
        wanted = small_side(wanted)
        read = docs.select("doc_id", F.posexplode(F.concat(words(), F.array(F.lit("")))).alias("pos", "word"))
        stored = materialize(read.join(wanted, "word").select("doc_id", "pos", "term"), "postings")
        self.postings = stored.where("term >= 0")
        self.lengths = stored.where("term = -1").select("doc_id", F.col("pos").cast("long").alias("n_words"))

    def frequencies(self) -> DataFrame:
        return self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def occurrences(index: Index, wanted: DataFrame, slack: int = 0, rarest: int = RAREST) -> DataFrame:
    """Where windows occur: ``doc_id, pos, window``, distinct.

    ``wanted`` has a row for each word of each window.  With ``slack`` 0 the
    words must follow each other as in the window (an exact phrase).  Otherwise
    each word may stand up to ``slack`` words off its place, and ``pos`` is the
    place that the rarest word points to (a proximity match).
    """
    # a term that no document has rules its windows out
    ranked = wanted.join(index.frequencies(), "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    by_window = Window.partitionBy("window")
    ranked = ranked.withColumn("least", F.min("df").over(by_window)).where("least > 0")
    ranked = ranked.withColumn("rank", F.row_number().over(by_window.orderBy("df", "at")))
    ranked = materialize(ranked.select("window", "length", "at", "term", "rank"), "ranked-terms")
    if slack:
        return _near(index, ranked, slack)
    few = ranked.where(F.col("rank") <= rarest).select("window", "length", "at", "term", "rank")
    rare = few.select("term").distinct()
    lists = index.postings.join(small_side(rare), "term", "left_semi")
    shifted = lists.join(small_side(few), "term").select("doc_id", (F.col("pos") - F.col("at")).alias("pos"), "window", "length", "at")
    # the intersection: as many of the rarest terms point to a place as were asked; a bit for each
    pointed = F.expr("bit_count(bit_or(shiftleft(1L, cast(at as int))))").alias("met")
    met = shifted.where("pos >= 0").groupBy("doc_id", "pos", "window", "length").agg(pointed)
    candidates = met.where(F.col("met") == F.least(F.lit(rarest), F.col("length"))).select("doc_id", "pos", "window", "length")
    candidates = materialize(candidates, "candidates")
    done = candidates.where(F.col("length") <= rarest)
    open_ = candidates.where(F.col("length") > rarest)
    more = ranked.where(F.col("rank") > rarest).select("window", "at", "term")
    asked = open_.join(small_side(more), "window").select("doc_id", (F.col("pos") + F.col("at")).alias("at_pos"), "term", "pos", "window", "length")
    here = _places(index, candidates)
    found = asked.join(here, (asked["doc_id"].eqNullSafe(here["__doc"])) & (asked["at_pos"] == here["__pos"]) & (asked["term"] == here["__term"]))
    whole = found.groupBy("doc_id", "pos", "window", "length").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") == F.col("length") - rarest)
    return whole.select("doc_id", "pos", "window").unionByName(done.select("doc_id", "pos", "window"))


def _places(index: Index, candidates: DataFrame) -> DataFrame:
    """Postings of the documents that hold a candidate; several rows of one id are one document's places."""
    docs = candidates.select("doc_id").distinct()
    postings = index.postings
    near = small_side(docs)
    kept = postings.join(near, postings["doc_id"].eqNullSafe(near["doc_id"]), "left_semi")
    return kept.select(F.col("doc_id").alias("__doc"), F.col("pos").alias("__pos"), F.col("term").alias("__term")).distinct()


def _near(index: Index, ranked: DataFrame, slack: int) -> DataFrame:
    first = ranked.where("rank = 1").select("window", "length", "at", "term")
    anchors = index.postings.join(small_side(first), "term").select("doc_id", (F.col("pos") - F.col("at")).alias("pos"), "window", "length")
    asked = anchors.join(small_side(ranked.select("window", "at", "term")), "window")
    off = F.explode(F.sequence(F.lit(-slack), F.lit(slack)))
    asked = asked.select("doc_id", "pos", "window", "length", "at", "term", off.alias("off"))
    here = _places(index, anchors)
    at = asked["pos"] + asked["at"] + asked["off"]
    found = asked.join(here, asked["doc_id"].eqNullSafe(here["__doc"]) & (at == here["__pos"]) & (asked["term"] == here["__term"]))
    met = found.select("doc_id", "pos", "window", "length", "at").distinct().groupBy("doc_id", "pos", "window", "length").agg(F.count(F.lit(1)).alias("met"))
    return met.where("met = length").select("doc_id", "pos", "window")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = 0) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A null text has no words; neither has an item without a word any window.
    Rows of ``docs`` that repeat a ``doc_id`` give one row: ``n_words`` is that
    of the longest, hits are places of any of them; null ids are one id.
    Repeated items count once.  A document can be of any length, since it is
    read as one row for each word; an empty table of documents gives no rows,
    an empty benchmark no hits.  Other columns are not read.
    """
    read = materialize(item_words(benchmark), "benchmark-words")
    terms = read.select("word").distinct().withColumn("term", F.xxhash64("word").bitwiseAND((1 << 62) - 1))
    index = Index(docs.select("doc_id", "text"), terms)
    wanted = materialize(windows(read.withColumn("term", F.xxhash64("word").bitwiseAND((1 << 62) - 1)), window), "benchmark-windows")
    found = materialize(occurrences(index, wanted, slack), "occurrences")
    spans = small_side(wanted.select("window", "item_id", "length").distinct())
    hit = found.join(spans, "window")
    covered = hit.select("doc_id", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("length").cast("int") - 1)).alias("at"))
    n_hit = covered.groupBy("doc_id", "at").agg(F.lit(1).alias("one")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_hit"))
    listed = hit.select("doc_id", F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item")).distinct().groupBy("doc_id")
    items = listed.agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    both = n_hit.join(items, n_hit["doc_id"].eqNullSafe(items["doc_id"])).select(n_hit["doc_id"].alias("__id"), "n_hit", "n_items", "items")
    lengths = index.lengths.groupBy("doc_id").agg(F.max("n_words").alias("n_words"))
    out = lengths.join(both, lengths["doc_id"].eqNullSafe(both["__id"]), "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose id has no hit."""
    drop = materialize(contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("__id")), "contaminated")
    return docs.join(small_side(drop), docs["doc_id"].eqNullSafe(drop["__id"]), "left_anti")


SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
sizes AS (SELECT DISTINCT least(len(ws), 10) AS size FROM b WHERE len(ws) > 0),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size,
         unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2), lambda i: array_to_string(ws[i:i + least(len(ws), 10) - 1], ' '))) AS g
  FROM b WHERE len(ws) > 0),
dw AS (
  SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS p0,
         unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS g
  FROM w, sizes WHERE len(ws) >= size),
hit AS (SELECT doc_id, item_id, p0, size FROM dw JOIN bw USING (size, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(p0, p0 + size)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
