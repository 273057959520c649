"""Spelling variants: words one edit apart, found by joins of a frontier of states with a trie's edges."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sizing import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast, measure
from tidemark.session import materialize

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Whole runs of letters with enough of them for a word.
RUN = re.compile("[A-Za-zÀ-ÿ]{5,}")
#: A run whose crc32 this divides loses one letter.
MISSPELT = 97
MIN_LETTERS, MIN_COUNT = 5, 3
#: Node ids are 64-bit polynomials of a prefix; a clash makes states that the last check drops.
BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
SIGN = 1 << 63


def _words(misspelt: int):
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: Counter = Counter()
            for doc, text in zip(frame.doc_id, frame.text):
                head = zlib.crc32(f"{doc}:".encode())
                for run, times in Counter(RUN.findall(text)).items():
                    run = run.lower() if run.isascii() else run.translate(LOWER)
                    crc = zlib.crc32(run.encode(), head)
                    if crc % misspelt == 0:
                        at = crc % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= MIN_LETTERS:
                        counts[run] += times
            yield pd.DataFrame({"word": pd.Series(list(counts), dtype=object), "n": pd.Series(list(counts.values()), dtype="int64")})

    return count


def word_counts(docs: DataFrame, misspelt: int = MISSPELT) -> DataFrame:
    """``word, n`` for every word of at least five letters, counted over all texts.

    A run of letters whose crc32 with its document's id is divisible by
    ``misspelt`` loses one letter first.  Counts are combined per batch and
    before the shuffle, so a frequent word is a few rows from each task.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInPandas(_words(misspelt), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _nodes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The trie nodes of each string from the first depth that a search can reach.

    A search enters at the half of its word that is taken as intact; that
    half of a string one letter shorter begins one letter earlier.
    """
    for frame in frames:
        key, depth, node, letter, entry, text = [], [], [], [], [], []
        for k, back, word in zip(frame.key, frame.back, frame.word):
            size = len(word)
            mine, others = entry_depth(size, back), entry_depth(size - 1, back)
            h = int(back) + 1
            for d, c in enumerate(word):
                if d >= others:
                    key.append(k)
                    depth.append(d)
                    node.append(h - SIGN)
                    letter.append(ord(c))
                    entry.append(d == mine)
                    text.append(None)
                h = (h * BASE + ord(c) + 1) & MASK
            key.append(k)
            depth.append(size)
            node.append(h - SIGN)
            letter.append(-1)
            entry.append(False)
            text.append(word)
        yield pd.DataFrame({"key": key, "depth": depth, "node": node, "letter": letter, "entry": entry, "word": pd.Series(text, dtype=object)})


def entry_depth(size: int, back: bool) -> int:
    """Letters of the half that a search takes as intact: the first, or read backwards the second."""
    return size - size // 2 if back else size // 2


def _tries(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Path-compressed tries of the words, forwards and backwards, as ``edges`` and ``starts``.

    ``edges`` has ``parent, label, node, end, end_n, onward``: a node where
    words branch, end or are entered, the letters to the next such node, the
    word that ends there with its count, and the letters that labels after it
    begin with.  ``starts`` has the state each word
    begins with: ``word, n, back, node, depth``.  A node's id is a hash of its
    prefix, so tries are made by grouping and no task sees a whole one.
    """
    ways = [F.struct(F.lit(back).alias("back"), word.alias("word")) for back, word in ((False, F.col("word")), (True, F.reverse("word")))]
    both = words.select("n", F.explode(F.array(*ways)).alias("s"))
    strings = materialize(both.select("n", "s.back", "s.word", F.monotonically_increasing_id().alias("key")), "spelling-strings")
    shape = "key long, depth int, node long, letter int, entry boolean, word string"
    rows = materialize(strings.select("key", "back", "word").mapInPandas(_nodes, shape), "spelling-nodes")
    kept = rows.groupBy("node").agg(F.min("letter").alias("low"), F.max("letter").alias("high"), F.max("entry").alias("entry"))
    kept = kept.where("low <> high or low < 0 or entry").select("node")
    path = F.sort_array(F.collect_list(F.struct("depth", "node", "entry")))
    paths = rows.join(kept, "node").groupBy("key").agg(path.alias("path"), F.max("word").alias("word"))
    paths = materialize(paths.join(strings.select("key", "n", "back"), "key"), "spelling-paths")
    step = F.explode(F.expr("transform(sequence(2, size(path)), i -> struct(path[i - 2] as a, path[i - 1] as b, i = size(path) as last))"))
    steps = paths.where("size(path) > 1").select("word", "n", step.alias("s"))
    label = F.col("word").substr(F.col("s.a.depth") + 1, F.col("s.b.depth") - F.col("s.a.depth"))
    edges = steps.select(F.col("s.a.node").alias("parent"), label.alias("label"), F.col("s.b.node").alias("node"), F.when(F.col("s.last"), F.col("word")).alias("end"), F.when(F.col("s.last"), F.col("n")).alias("end_n"))
    edges = edges.groupBy("parent", "label", "node").agg(F.max("end").alias("end"), F.max("end_n").alias("end_n"))
    first = F.expr("filter(path, p -> p.entry)[0]")
    starts = paths.select("word", "n", "back", first["node"].alias("node"), first["depth"].alias("depth"))
    edges = materialize(edges, "spelling-edges")
    onward = edges.groupBy(F.col("parent").alias("node")).agg(F.array_join(F.collect_set(F.substring("label", 1, 1)), "").alias("onward"))
    return materialize(edges.join(onward, "node", "left"), "spelling-edges"), starts


def _moved(met: DataFrame) -> DataFrame:
    """States after one edge, for each way its label fits the rest of the word.

    A label that the rest begins with is passed.  Else the one edit of a state
    without edits lies in it: a letter is replaced by a larger one, or a
    letter is inserted.  The other direction of each pair is its mirror.  A
    state goes on only if the letter after it is one of the node's.
    """
    size, depth = F.length("label"), F.col("depth")
    read = met.withColumn("size", size).withColumn("same", F.col("word").substr(depth + 1, size))
    fresh, long = F.col("edits") == 0, F.length("same") >= F.col("size")
    one = lambda text: (F.col("size") == 1) | (F.levenshtein(text, F.col("label"), 1) == 1)

    def goes_on(after: Column) -> Column:
        next_ = F.col("word").substr(after + 1, F.lit(1))
        return F.when(next_ == "", F.col("end").isNotNull()).otherwise(F.instr("onward", next_) > 0)

    after = depth + F.col("size")
    fits = F.col("same") == F.col("label")
    replaced = fresh & ~fits & long & (F.col("same") < F.col("label")) & goes_on(after) & one(F.col("same"))
    shorter = F.col("word").substr(depth + 1, F.col("size") - 1)
    inserted = fresh & ~fits & (F.length("same") >= F.col("size") - 1) & goes_on(after - 1) & one(shorter)
    judged = read.select("*", fits.alias("fits"), F.coalesce(replaced, F.lit(False)).alias("replaced"), F.coalesce(inserted, F.lit(False)).alias("inserted"))
    judged = judged.where("fits or replaced or inserted")
    state = lambda at, edits: F.struct(at.cast("int").alias("depth"), edits.cast("int").alias("edits"))
    instead, more = state(after, F.lit(1)), state(after - 1, F.lit(1))
    ways = F.when(F.col("fits"), F.array(state(after, F.col("edits"))))
    ways = ways.when(F.col("replaced") & F.col("inserted"), F.array(instead, more)).when(F.col("replaced"), F.array(instead)).otherwise(F.array(more))
    out = judged.select("word", "n", "back", "node", "end", "end_n", F.explode(ways).alias("s"))
    return out.select("word", "n", "back", "node", "end", "end_n", "s.depth", "s.edits")


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs ``word, n, other, other_n`` of words one edit apart, each pair once.

    A frontier of states (word, letters read, node, edits) is joined with the
    edges level by level.  One half of the shorter word is the same in both,
    so a state begins at the node of its word's first half, or in the trie of
    reversed words at that of its second half, and the edit comes after.  A
    pair that both find counts where the first halves are equal.  States with
    an edit that have read their whole word at a word's end are pairs; these
    are checked once more, since node ids are hashes.
    """
    edges, starts = _tries(words)
    frontier = materialize(starts.withColumn("edits", F.lit(0)), "spelling-frontier")
    found = []
    while (size := measure(frontier)).rows:
        # a letter of the label must fit where the edit is behind the state
        letter = F.col("word").substr(F.col("depth") + 1, F.lit(1))
        goes = (F.col("edits") == 0) | (letter == F.substring("label", 1, 1))
        states = frontier.withColumnRenamed("node", "parent")
        few = size.rows <= BROADCAST_ROWS and size.bytes <= BROADCAST_BYTES
        met = (F.broadcast(states) if few else states).join(edges, "parent").where(goes)
        moved = materialize(_moved(met), "spelling-moved")
        read = (F.col("edits") == 1) & (F.col("depth") == F.length("word"))
        found.append(moved.where(read & F.col("end").isNotNull()))
        frontier = moved.where(~read).drop("end", "end_n")
    if not found:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    ends = found[0]
    for more in found[1:]:
        ends = ends.unionByName(more)
    ends = ends.where(F.levenshtein("word", "end", 1) == 1)
    half = F.floor(F.length("word") / 2).cast("int")
    turned = ends.where("back").withColumn("word", F.reverse("word")).withColumn("end", F.reverse("end"))
    turned = turned.where(F.col("word").substr(F.lit(1), half) != F.col("end").substr(F.lit(1), half))
    pairs = ends.where("not back").unionByName(turned)
    return pairs.select("word", "n", F.col("end").alias("other"), F.col("end_n").alias("other_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: forms followed to the last one, each round twice as far as the one before.

    Counts at least double with each form, so the largest count bounds the
    steps, and the rounds are its logarithm's logarithm.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    steps = (forms.agg(F.coalesce(F.max("form_n"), F.lit(1))).first()[0]).bit_length()
    few = fits_broadcast(reached)
    for _ in range(steps.bit_length()):
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = reached.join(F.broadcast(ahead) if few else ahead, "root", "left")
        reached = materialize(further.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return reached


def spelling_variants(docs: DataFrame, min_count: int = MIN_COUNT, misspelt: int = MISSPELT) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are the runs of letters of all texts, A-Z lowered, of at least five
    letters and ``min_count`` occurrences.  ``form`` is the word one edit away
    with the largest count (ties: the smallest in code-point order) if that is
    at least twice the word's own; counts double along forms, so following
    them ends, at ``root``.  A null text has no words, a null ``doc_id``
    counts as an empty one; rows that repeat are counted as often as they
    stand there; other columns are not read.  A word may be as long as its
    text: tries are compressed, so the number of levels is that of branches on
    a path, not that of letters.  Without words the result is empty.
    """
    words = materialize(word_counts(docs.select("doc_id", "text"), misspelt).where(F.col("n") >= min_count), "spelling-words")
    sides = F.array(
        F.struct(F.col("word"), F.col("other").alias("form"), F.col("other_n").alias("form_n")),
        F.struct(F.col("other").alias("word"), F.col("word").alias("form"), F.col("n").alias("form_n")),
    )
    near = near_pairs(words).select(F.explode(sides).alias("s")).select("s.*")
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form")))
    near = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    much = -F.col("best.minus") >= 2 * F.col("n")
    decided = materialize(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(much, F.col("best.form")).alias("form"), F.when(much, -F.col("best.minus")).alias("form_n")),
        "spelling-forms",
    )
    rooted = decided.join(_roots(decided.where("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Near words by deleting one letter from both sides; crc32 is spelled out, table and all.
SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda x: list_reduce(range(8),
        lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, x)) AS crc_table),
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents),
counted AS (SELECT id, run, count(*) AS n, hex(encode(id || run)) AS bytes FROM runs WHERE length(run) >= 5 GROUP BY id, run),
hashed AS (
    SELECT run, n, xor(list_reduce(
        list_transform(range(length(bytes) // 2), lambda i: ('0x' || substr(bytes, CAST(2 * i + 1 AS INT), 2))::BIGINT),
        lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
    FROM counted, crc),
spelt AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) + 2 AS INT)) ELSE run END AS word, n
    FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
    SELECT word, n, i, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i + 2 AS INT)) AS short
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS form, b.n AS form_n FROM cut a JOIN cut b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, w.word, w.n FROM cut a JOIN words w ON a.short = w.word
    UNION SELECT w.word, a.word, a.n FROM cut a JOIN words w ON a.short = w.word),
ranked AS (
    SELECT word, form, form_n, count(*) OVER (PARTITION BY word) AS n_near,
           row_number() OVER (PARTITION BY word ORDER BY form_n DESC, encode(form)) AS place
    FROM near),
decided AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
           CASE WHEN r.form_n >= 2 * w.n THEN r.form END AS form, CASE WHEN r.form_n >= 2 * w.n THEN r.form_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chain AS (
    SELECT word, word AS at FROM decided
    UNION ALL SELECT c.word, d.form FROM chain c JOIN decided d ON d.word = c.at WHERE d.form IS NOT NULL)
SELECT d.word, d.form, c.at AS root, d.n, d.n_near, d.form_n
FROM decided d JOIN chain c ON c.word = d.word JOIN decided l ON l.word = c.at AND l.form IS NULL
"""
