"""Repeated phrases: windows of words that an earlier document has, found by Aho-Corasick automata.

1. Of each window's word 6-grams the one with the smallest hash stands for the
   window, so equal windows have the same mark, wherever they stand.  About a
   quarter of the positions bear a mark.
2. A mark that two documents have recurs; the smallest of them owns it.  Only
   windows under recurring marks are looked at further.
3. The owner's windows under its marks are compiled into an automaton, one for
   each owner, with a letter for each word.  The runs of windows of all other
   documents under these marks are streamed through it, which locates every
   occurrence.  An owner with very many such runs gets several copies of its
   automaton, each for a part of them.
4. A window that bears a mark but does not occur in the mark's owner can only
   repeat another such window, and only if a third document has the mark.
   These few are grouped by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sizing import fits_broadcast
from tidemark.llm.features import WIDE, WIDE_2, Batch, words
from tidemark.llm.texts import bounded, for_python, id_back, partitions
from tidemark.session import materialize, shared_dir

WINDOW = 13
#: Words of a mark.
MARK = 6
BATCH = 500_000
#: Runs that one copy of an automaton is given.
RUNS = 5_000
#: Different words of one automaton: each takes a character of its own.
LETTERS = 1_000_000
NOBODY = np.iinfo(np.int64).max

PARTS = "kind int, doc_id long, key long, owner long, start long, n_words long, body binary, kept_sha256 string"
FOUND = "doc_id long, key long, first long, last long, h1 long, h2 long"
#: Rows of documents, of windows under their own marks, under marks of an owner, and under marks that two documents have.
DOCUMENT, OWNED, RUN, RUN_OF_TWO = 0, 1, 2, 3


def scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * WIDE
    return h ^ (h >> np.uint64(29))


def marks(batch: Batch, window: int = WINDOW) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and the mark of every window of each text."""
    codes = batch.codes
    seen = words(codes, (codes != 32) & ~((codes >= 9) & (codes <= 13)))
    grams = np.zeros(max(0, len(seen.hash) - MARK + 1), np.uint64)
    for i in range(MARK):
        grams += scramble(seen.hash[i : i + len(grams)] + np.uint64(i))
    least = (scramble(grams) ^ WIDE_2).view(np.int64)
    reach, size = 1, window - MARK + 1
    while reach < size:  # the smallest of ever more grams in a row
        step = min(reach, size - reach)
        least = np.minimum(least[: max(0, len(least) - step)], least[step:])
        reach += step
    for a, b in pairwise(np.searchsorted(seen.at, batch.starts).tolist()):
        yield b - a, least[a : b - window + 1] if b - a >= window else least[:0]


def _marker(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in bounded(frames, "text", BATCH):
        found = [np.unique(m) for _, m in marks(Batch.of(frame["text"]))]
        yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "mark": pd.Series(found, dtype=object)})


def recurring(docs: DataFrame) -> DataFrame:
    """``doc_id, marks, owners, twos``: the marks of each document that another has too; twos: just one other."""
    seen = docs.mapInPandas(_marker, "doc_id long, mark array<long>").select("doc_id", F.explode("mark").alias("mark"))
    ends = [F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), (F.count(F.lit(1)) == 2).alias("two")]
    owners = seen.groupBy("mark").agg(*ends).where("owner < last").drop("last")
    shared = seen.join(owners, "mark")
    # a document's own marks: no more than it has words
    return shared.groupBy("doc_id").agg(*[F.collect_list(c).alias(f"{c}s") for c in ("mark", "owner", "two")])


def _parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each document, and one for each run of its windows under the same owner's marks."""
    for frame in bounded(frames, "text", BATCH):
        rows = []
        found = marks(Batch.of(frame["text"]))
        for doc_id, key, text, known, owners, twos, (n, of_windows) in zip(
            frame["doc_id"].tolist(), frame["key"].tolist(), frame["text"], frame["marks"], frame["owners"], frame["twos"], found, strict=True
        ):
            said = text.encode("utf-8", "surrogatepass").split()
            owner, two = np.full(len(of_windows), NOBODY), np.zeros(len(of_windows), bool)
            if known is not None and len(known) and len(of_windows):
                order = np.argsort(known)
                known, owners, twos = (np.asarray(x)[order] for x in (known, owners, twos))
                at = np.minimum(np.searchsorted(known, of_windows), len(known) - 1)
                owner = np.where(known[at] == of_windows, owners[at], NOBODY)
                two = (owner < doc_id) & twos[at].astype(bool)
            body = b" ".join(said)
            # what only later documents repeat stays whole
            whole = not ((owner < doc_id).any() if len(owner) else False)
            sha = hashlib.sha256(body).hexdigest() if whole else None
            rows.append((DOCUMENT, doc_id, key, 0, 0, n, None if whole else body, sha))
            change = (owner[1:] != owner[:-1]) | (two[1:] != two[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(owner)]
            for a, b in pairwise(cuts):
                if b > a and (o := int(owner[a])) != NOBODY:
                    kind = OWNED if o == doc_id else RUN_OF_TWO if two[a] else RUN
                    rows.append((kind, doc_id, key, o, a, 0, b" ".join(said[a : b + WINDOW - 1]), None))
        yield pd.DataFrame(rows, columns=["kind", "doc_id", "key", "owner", "start", "n_words", "body", "kept_sha256"])


class Automaton:
    """All windows of some texts, a letter for each of their words."""

    def __init__(self) -> None:
        import ahocorasick

        self.letters: dict[bytes, str] = {}
        self.built = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.ready = False

    def add(self, said: list[bytes], begin: int = 0) -> int:
        """Windows from word ``begin`` on, as far as the letters reach; gives the start of the first one left."""
        known: list[str] = []
        for word in islice(said, begin, None):
            if word not in self.letters:
                if len(self.letters) >= LETTERS:
                    break
                self.letters[word] = chr(len(self.letters) + 2)
            known.append(self.letters[word])
        text = "".join(known)
        for i in range(len(text) - WINDOW + 1):
            self.built.add_word(text[i : i + WINDOW], 1)
        return begin + len(text) - WINDOW + 1

    def starts(self, said: list[bytes]) -> list[int]:
        """Where one of the windows begins."""
        if not self.ready:
            self.built.make_automaton()
            self.ready = True
        get = self.letters.get
        return [end - WINDOW + 1 for end, _ in self.built.iter("".join([get(w, "\x01") for w in said]))]


def _locate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows sorted by owner, its own first: places that are found, and digests of windows that are not."""
    now, compiled = None, []
    for frame in frames:
        rows = []
        for kind, doc_id, key, owner, salt, start, body in zip(
            *(frame[c].tolist() for c in ("kind", "doc_id", "key", "owner", "salt", "start", "body")), strict=True
        ):
            if (owner, salt) != now:
                now, compiled = (owner, salt), []
            said = body.split(b" ")
            if kind == OWNED:
                if not compiled or len(compiled[-1].letters) + len(said) > LETTERS:
                    compiled.append(Automaton())
                begin = compiled[-1].add(said)
                while begin + WINDOW <= len(said):  # more different words than letters: the next has WINDOW - 1 words again
                    compiled.append(Automaton())
                    begin = compiled[-1].add(said, begin)
                continue
            there = np.zeros(len(said) - WINDOW + 1, bool)
            for one in compiled:
                there[one.starts(said)] = True
            edges = np.flatnonzero(np.diff(there, prepend=False, append=False)).tolist()
            rows += [(doc_id, key, start + a, start + b + WINDOW - 2, 0, 0) for a, b in zip(edges[::2], edges[1::2], strict=True)]
            for i in np.flatnonzero(~there).tolist() if kind == RUN else []:
                digest = hashlib.blake2b(b" ".join(said[i : i + WINDOW]), digest_size=16).digest()
                h1, h2 = np.frombuffer(digest, "<i8").tolist()
                rows.append((doc_id, key, start + i, -1, h1, h2))
        yield pd.DataFrame(rows, columns=["doc_id", "key", "first", "last", "h1", "h2"])


def located(parts: DataFrame, runs: int = RUNS) -> DataFrame:
    """``doc_id, key, first, last``: word positions that a window of an earlier document covers."""
    own, other = parts.where(F.col("kind") == OWNED), parts.where(F.col("kind") > OWNED)
    fans = other.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / runs).cast("int").alias("fan")).where("fan > 1")
    fans = materialize(fans, "phrase-fans")
    fans = F.broadcast(fans) if fits_broadcast(fans) else fans
    columns = ["kind", "doc_id", "key", "owner", "salt", "start", "body"]
    fan = F.coalesce("fan", F.lit(1))
    many = own.join(fans, "owner", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), fan - 1))).select(*columns)
    some = other.join(fans, "owner", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id", "key", "start"), fan).cast("int")).select(*columns)
    n = partitions(parts.sparkSession)
    dealt = many.unionByName(some).repartition(n, "owner", "salt").sortWithinPartitions("owner", "salt", "kind")
    found = materialize(dealt.mapInPandas(_locate, FOUND), "phrase-places")
    sure, left = found.where("last >= 0").select("doc_id", "key", "first", "last"), found.where("last < 0")
    earliest = left.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    more = left.join(earliest, ["h1", "h2"]).where("low < doc_id")
    return sure.unionByName(more.select("doc_id", "key", "first", (F.col("first") + WINDOW - 1).alias("last")))


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        removed, shas = [], []
        for body, firsts, lasts in zip(frame["body"], frame["firsts"], frame["lasts"], strict=True):
            said = body.split(b" ")
            step = np.zeros(len(said) + 1, np.int64)
            if firsts is not None:
                np.add.at(step, np.asarray(firsts, np.int64), 1)
                np.add.at(step, np.asarray(lasts, np.int64) + 1, -1)
            keep = np.cumsum(step[:-1]) == 0
            shas.append(hashlib.sha256(b" ".join([w for w, yes in zip(said, keep.tolist(), strict=True) if yes])).hexdigest())
            removed.append(int((~keep).sum()))
        yield pd.DataFrame({"doc_id": frame["doc_id"], "n_words": frame["n_words"], "n_removed": removed, "kept_sha256": shas})


def remove_repeats(docs: DataFrame, runs: int = RUNS) -> DataFrame:
    """One row per table row: ``doc_id, n_words, n_removed, kept_sha256``.

    A word goes if a window of 13 words covers it that also begins in a
    document with a smaller id; windows are those of the input.  Null and empty
    texts have no words, and no window with fewer than 13.  Rows that share an
    id never remove anything from each other; null ids count as the smallest.
    A very long text is one row; what it shares is streamed run by run.  Other
    columns are not read, and an empty table gives no rows.
    """
    texts = for_python(docs)
    with_marks = texts.withColumn("key", F.xxhash64("text")).join(recurring(texts), "doc_id", "left")
    path = shared_dir(docs.sparkSession, "phrase-parts")
    with_marks.mapInPandas(_parts, PARTS).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    parts = docs.sparkSession.read.schema(PARTS).parquet(path)
    rows = parts.where(F.col("kind") == DOCUMENT).select("doc_id", "key", "n_words", "body", "kept_sha256")
    covers = located(parts, runs).groupBy("doc_id", "key").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    touched = rows.where("body is not null").join(covers, ["doc_id", "key"], "left").select("doc_id", "n_words", "body", "firsts", "lasts")
    cut = touched.mapInPandas(_cut, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    whole = rows.where("body is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256")
    return whole.unionByName(cut).withColumn("doc_id", id_back())


SQL = """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS p0,
         unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS g FROM w WHERE len(ws) >= 13),
firsts AS (SELECT g, min(doc_id) AS m FROM g GROUP BY g),
hit AS (SELECT DISTINCT doc_id, unnest(range(p0, p0 + 13)) AS p FROM g JOIN firsts USING (g) WHERE m < doc_id),
said AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS body
  FROM said ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
