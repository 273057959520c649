"""Documents whose sets of word n-grams are similar, by rare-first prefix filtering.

The n-grams of a set are ordered by how many classes of equal sets have them,
rarest first.  Two sets of Jaccard similarity ``t`` share an n-gram among the
first ``n - ceil(t n) + 1`` of each, so only these prefixes are joined.  Sizes,
the places of the shared n-grams and their number bound the overlap (length and
positional filter), sizes of both sets within ranges of the hash bound it again (suffix
filter), and the pairs left are verified on the whole sets, once each.

The counts are exact: every n-gram of every class is dealt by its value once,
and only those that several classes have go on.  What a class has alone comes
first in its order, so it is known by number.

Groups of copies never become all pairs.  Equal sets are one class, known by
its smallest id.  Of the classes that share a prefix n-gram the one with the
fewest n-grams of its own leads: a text that others were copied from has few,
each copy has its edits.  Each class is compared with the lead that it shares
most with, then with the other leads that it is not joined to yet.  What that
links is one component.  At the end only classes outside the largest component
of an n-gram's group are compared with the rest of the group, and only with
those whose length and place leave room for the overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.sizing import fits_broadcast
from tidemark.llm.components import components
from tidemark.llm.features import WIDE, WIDE_2, Batch, words
from tidemark.llm.texts import bounded, for_python, id_back, small_side
from tidemark.session import materialize

WORDS = 5
#: Similarity as a fraction.
ABOVE, OF = 3, 4
RANGES = 16
#: Lengths of one band differ by less than this factor.
BAND = 1.1
BATCH = 500_000

FOUND = "n long, doc_id long, s1 long, s2 long, ranges array<int>"
SETS = "rep long, twin long, grams array<long>"


def scramble(h: np.ndarray, odd: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * odd
    return h ^ (h >> np.uint64(29))


def sets(texts: list[str], size: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's distinct word n-grams; A-Z count as a-z."""
    batch = Batch.of(texts)
    codes = batch.codes.copy()
    codes[(codes >= 65) & (codes <= 90)] += np.uint32(32)
    seen = words(codes, (codes != 32) & ~((codes >= 9) & (codes <= 13)))
    mixed = np.zeros(max(0, len(seen.hash) - size + 1), np.uint64)
    for i in range(size):
        mixed += scramble(seen.hash[i : i + len(mixed)] + np.uint64(i), WIDE)
    mixed = scramble(mixed, WIDE_2)
    edges = np.searchsorted(seen.at, batch.starts).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        if b - a >= size:
            yield np.unique(mixed[a : b - size + 1])
        elif b > a:  # too short: the whole sequence
            whole = sum(scramble(seen.hash[a + i : a + i + 1] + np.uint64(i), WIDE) for i in range(b - a))
            yield scramble(whole + np.uint64(size - (b - a)), WIDE_2)
        else:
            yield np.zeros(0, np.uint64)


def sums(found: list[np.ndarray], odd: np.uint64, change: np.uint64 = np.uint64(0)) -> list[int]:
    """One number for each set, the same for equal sets."""
    return [int(scramble(g ^ change, odd).sum(dtype=np.uint64).astype(np.int64)) for g in found]


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in bounded(frames, "text", BATCH):
        found = list(sets(frame["text"].tolist()))
        yield pd.DataFrame(
            {
                "n": [len(g) for g in found],
                "doc_id": frame["doc_id"].to_numpy(),
                "s1": sums(found, WIDE),
                "s2": sums(found, WIDE_2, WIDE_2),
                "ranges": [np.bincount((g >> np.uint64(60)).astype(np.int64), minlength=RANGES).astype(np.int32) for g in found],
            }
        )


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in bounded(frames, "text", BATCH):
        found = list(sets(frame["text"].tolist()))
        grams = pd.Series([g.view(np.int64) for g in found], dtype=object)
        twin = np.where(frame["several"].to_numpy(bool), np.array(sums(found, WIDE), np.int64), 0)
        yield pd.DataFrame({"rep": frame["doc_id"].to_numpy(), "twin": twin, "grams": grams})


def _whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in bounded(frames, "text", BATCH):
        found = [g.view(np.int64) for g in sets(frame["text"].tolist())]
        yield frame[["doc_id", "as_a", "as_b"]].assign(grams=pd.Series(found, dtype=object, index=frame.index))


def similar_size(a: str, b: str) -> Column:
    return OF * F.least(a, b) >= ABOVE * F.greatest(a, b)


def may_overlap(n_a: str, at_a: str, n_b: str, at_b: str) -> Column:
    """From the first shared n-gram on, both sets still hold the overlap that the similarity asks for."""
    return (ABOVE + OF) * F.least(F.col(n_a) - F.col(at_a), F.col(n_b) - F.col(at_b)) >= ABOVE * (F.col(n_a) + F.col(n_b))


def n_of(packed: str) -> Column:
    return F.shiftright(packed, 32)


def at_of(packed: str) -> Column:
    return F.col(packed).bitwiseAND((1 << 32) - 1)


def band_of(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(BAND))).cast("int")


def ordered(pairs: DataFrame) -> DataFrame:
    """The pairs alone, smaller end first, so that a pair is known whichever way it was found."""
    return pairs.select(F.least("rep", "first").alias("rep"), F.greatest("rep", "first").alias("first"))


class Join:
    """The steps over one table of documents."""

    def __init__(self, docs: DataFrame):
        self.docs = for_python(docs)

    def scan(self) -> None:
        self.seen = materialize(self.docs.mapInPandas(_scan, FOUND), "ngram-scan")
        classes = self.seen.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.first("ranges").alias("ranges"))
        self.classes = materialize(classes, "ngram-classes")

    def common(self) -> DataFrame:
        """``rep, twin, gram, classes``: the n-grams that at least two classes have; ``twin`` tells texts of one id apart, else 0."""
        first, last = (f(F.struct("s1", "s2", "n")) for f in (F.min, F.max))
        ids = self.seen.where("n > 0").groupBy("doc_id").agg((first != last).alias("several"))
        reps = ids.join(self.classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        reps = materialize(reps, "ngram-reps")
        self.named = self.classes.join(reps.withColumnRenamed("doc_id", "rep"), "rep")
        self.named = self.named.select("rep", F.when(F.col("several"), F.col("s1")).otherwise(0).alias("twin"), "n")
        whole = self.docs.join(small_side(reps), "doc_id").mapInPandas(_sets, SETS)
        rows = whole.select("rep", "twin", F.explode("grams").alias("gram"))
        return rows.withColumn("classes", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("classes > 1")

    def share(self) -> None:
        """Prefix n-grams that at least two classes have, each with the lead of its group.

        From here on an n-gram is one number: its count's logarithm, then 48
        bits of its hash.  Where two of a text fall together, the places after
        them come out lower, which lets more pairs pass and never fewer.
        """
        rank = F.shiftleft(F.floor(512 * F.log2("classes")), 48)
        rows = self.common().select("rep", "twin", rank.bitwiseOR(F.shiftrightunsigned("gram", 16)).alias("gram"))
        sets_ = rows.groupBy("rep", "twin").agg(F.sort_array(F.collect_set("gram")).alias("common"), F.count(F.lit(1)).alias("rows"))
        sets_ = sets_.join(self.named, ["rep", "twin"]).withColumn("own", F.greatest(F.col("n") - F.col("rows"), F.lit(0)))
        prefix = F.col("n") - F.ceil(ABOVE * F.col("n") / OF) + 1
        sets_ = sets_.withColumn("room", (prefix - F.col("own")).cast("int")).where("room > 0")
        rows = sets_.select("rep", "n", "own", F.posexplode(F.slice("common", F.lit(1), F.col("room"))).alias("place", "gram"))
        packed = F.shiftleft("n", 32).bitwiseOR(F.col("own") + F.col("place")).alias("n_at")
        rows = materialize(rows.select("gram", "rep", "own", packed), "ngram-prefixes")
        # combined before the shuffle, so a group of any size has its lead without lying in one task
        lead = F.min_by(F.struct("rep", "n_at"), F.struct("own", "rep")).alias("lead")
        leads = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("rows"), lead).where("rows > 1")
        leads = leads.select("gram", F.col("lead.rep").alias("first"), F.col("lead.n_at").alias("first_n_at"))
        self.shared = materialize(rows.join(leads, "gram"), "ngram-shared")

    @staticmethod
    def pairs(rows: DataFrame) -> DataFrame:
        """``rep, first, shared``: pairs of rows that pass the length and positional filters, and how many n-grams say so."""
        split = rows.where("first <> rep").select(
            "rep", "first", n_of("n_at").alias("n_b"), at_of("n_at").alias("at_b"), n_of("first_n_at").alias("n_a"), at_of("first_n_at").alias("at_a")
        )
        passed = split.where(similar_size("n_a", "n_b") & may_overlap("n_a", "at_a", "n_b", "at_b"))
        return passed.groupBy("rep", "first").agg(F.count(F.lit(1)).alias("shared"))

    def star_pairs(self) -> DataFrame:
        """Every class with the leads of its groups."""
        return materialize(self.pairs(self.shared), "ngram-star")

    @staticmethod
    def best(star: DataFrame) -> DataFrame:
        """For each class the lead that it shares most n-grams with, the smallest of several."""
        return star.groupBy("rep").agg(F.max_by("first", F.struct("shared", -F.col("first"))).alias("first"))

    def cross_pairs(self, joined: DataFrame) -> DataFrame:
        """Pairs that share a prefix n-gram and are not in one component yet.

        One of the two is outside the largest component of the n-gram's group.
        Its length and place say which lengths the other may have.
        """
        rows = self.shared.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        rows = rows.select("gram", "rep", n_of("n_at").alias("n"), at_of("n_at").alias("at"), F.coalesce("component", "rep").alias("part"))
        sizes = rows.groupBy("gram", "part").agg(F.count(F.lit(1)).alias("rows"))
        largest = F.max_by("part", F.struct("rows", "part")).alias("main")
        mixed = sizes.groupBy("gram").agg(F.count(F.lit(1)).alias("parts"), largest).where("parts > 1").select("gram", "main")
        rows = materialize(rows.join(mixed, "gram").withColumn("inside", F.col("part") == F.col("main")).drop("main"), "ngram-cross")
        low, high = F.floor((ABOVE * F.col("n") + OF - 1) / OF), F.floor((OF * F.col("n") - (ABOVE + OF) * F.col("at")) / ABOVE)
        outside = rows.where(~F.col("inside")).drop("inside").withColumn("low", low).withColumn("high", high).where("low <= high")
        outside = outside.select("gram", "rep", "n", "at", "part", F.explode(F.sequence(band_of(F.col("low")), band_of(F.col("high")))).alias("band"))
        other = rows.withColumnsRenamed({"rep": "first", "n": "first_n", "at": "first_at", "part": "first_part"})
        other = other.withColumn("band", band_of(F.col("first_n")))
        apart = (F.col("first_part") != F.col("part")) & (F.col("inside") | (F.col("first") < F.col("rep")))
        fits = similar_size("n", "first_n") & may_overlap("n", "at", "first_n", "first_at")
        there, here = other.alias("there"), outside.alias("here")
        same = (F.col("here.gram") == F.col("there.gram")) & (F.col("here.band") == F.col("there.band"))
        return here.join(there, same & apart & fits).select("rep", "first").distinct()

    @staticmethod
    def apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
        """Pairs that are not in one component yet."""
        of = joined.withColumnsRenamed({"node": "rep", "component": "part"})
        both = pairs.join(of, "rep", "left").join(of.withColumnsRenamed({"rep": "first", "part": "first_part"}), "first", "left")
        return both.where(F.coalesce("part", "rep") != F.coalesce("first_part", "first")).select("rep", "first")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Links ``a < b`` among the pairs: suffix filter first, then the overlap of the whole sets."""
        pairs = pairs.select(F.least("rep", "first").alias("a"), F.greatest("rep", "first").alias("b"))
        ranges = self.classes.select("rep", "ranges", "n")

        def side(name: str) -> DataFrame:
            return ranges.select(F.col("rep").alias(name), F.col("ranges").alias(f"ranges_{name}"), F.col("n").alias(f"n_{name}"))

        close = pairs.join(side("a"), "a").join(side("b"), "b")
        apart = F.aggregate(F.zip_with("ranges_a", "ranges_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda x, y: x + y)
        # sets that differ in more elements than this cannot be similar
        most = (OF - ABOVE) * (F.col("n_a") + F.col("n_b")) / (ABOVE + OF)
        close = materialize(close.where(apart <= most).select("a", "b").distinct(), "ngram-close")
        as_a = close.select(F.col("a").alias("doc_id"), F.lit(True).alias("as_a"), F.lit(False).alias("as_b"))
        as_b = close.select(F.col("b").alias("doc_id"), F.lit(False).alias("as_a"), F.lit(True).alias("as_b"))
        ids = as_a.unionByName(as_b).groupBy("doc_id").agg(F.bool_or("as_a").alias("as_a"), F.bool_or("as_b").alias("as_b"))
        ids = materialize(ids, "ngram-ends")
        wanted = self.docs.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "doc_id")
        whole = wanted.mapInPandas(_whole, "doc_id long, as_a boolean, as_b boolean, grams array<long>")
        whole = materialize(whole, "ngram-sets")
        both = close.join(whole.where("as_b").select(F.col("doc_id").alias("b"), F.col("grams").alias("grams_b")), "b")
        both = both.join(whole.where("as_a").select(F.col("doc_id").alias("a"), F.col("grams").alias("grams_a")), "a")
        shared = F.size(F.array_intersect("grams_a", "grams_b"))
        union = F.size("grams_a") + F.size("grams_b") - F.col("shared")
        links = both.select("a", "b", "grams_a", "grams_b", shared.alias("shared")).where(OF * F.col("shared") >= ABOVE * union)
        return materialize(links.select("a", "b").distinct(), "ngram-links")


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per table row: ``doc_id, n_shingles, component_id``.

    A document's set holds its distinct 5-word shingles, with fewer words the
    whole sequence; documents link at a Jaccard similarity of 0.75 or more, and
    ``component_id`` is the smallest id reachable by links.  Null and empty
    texts, and texts of white space, have an empty set and link with nothing.
    Rows that share an id are one node: an id with several texts is reached
    through each of them, and null ids count as one id.  A very long text is
    one large set in one task.  Other columns are not read; an empty table
    gives no rows.
    """
    join = Join(docs)
    join.scan()
    join.share()
    classed = join.seen.where("n > 0").join(join.classes.select("s1", "s2", "n", "rep"), ["s1", "s2", "n"]).select("doc_id", "n", "rep")
    several = classed.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("doc_id")
    same_id = classed.join(several, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    star = join.star_pairs()
    tried = materialize(ordered(join.best(star)).distinct(), "ngram-best")
    links = join.verify(tried).unionByName(same_id)
    joined = materialize(components(links), "ngram-joined")
    for candidates in (lambda: star, lambda: join.cross_pairs(joined)):
        rest = join.apart(ordered(candidates()), joined).distinct().join(tried, ["rep", "first"], "left_anti")
        rest = materialize(rest, "ngram-rest")
        if rest.isEmpty():
            continue
        more = join.verify(rest)
        tried = tried.unionByName(rest)
        if not more.isEmpty():
            links = links.unionByName(more)
            joined = materialize(components(links), "ngram-joined")
    reached = classed.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    reached = reached.select("doc_id", "n", F.coalesce("component", "rep").alias("component_id"))
    alone = join.seen.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return reached.unionByName(alone).select(id_back(), F.col("n").alias("n_shingles"), id_back("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without those that a smaller id of their component stands for.

    Null and empty texts stay, and so do rows whose id is null.  All rows of an
    id stay or go together.  Other columns pass through, whatever their names;
    an empty table gives no rows.
    """
    drop = similar_documents(docs).where("component_id < doc_id or component_id is null and doc_id is not null")
    drop = materialize(drop.select(F.col("doc_id").alias("__id")).distinct(), "ngram-drop")
    return docs.join(small_side(drop), docs["doc_id"] == drop["__id"], "left_anti")


SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""
