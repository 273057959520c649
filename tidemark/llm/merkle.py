"""Merkle manifest of a table: trees of digests per group, proofs by pointer jumping."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import crc_of_id, partitions, small_side
from tidemark.session import materialize

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Consecutive nodes that make one of the next level.
RUN = 8
RECORD_BITS = 33
#: The tree over the groups' roots; the trees of groups count from 0.
TOP = -1
#: A stated part of the documents is tampered with.
TAMPERED = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Manifest(NamedTuple):
    """``proofs`` (a row per leaf), ``nodes`` (inner nodes of all trees) and the root's digest."""

    proofs: DataFrame
    nodes: DataFrame
    root: str | None


def as_hex(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of the values in order: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    texts = [c.cast("string") for c in fields.values()]
    return digest_of(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def _numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their place from 0 in each group, and ``left``, the group's rows.

    Rows are written in ranges of (group, order), so that neither a hot group
    nor all rows are in one task; a row's place is its place in its file and
    the rows in the ranges before.  ``order`` must tell all rows apart.
    """
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    sorted_ = rows.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    written = materialize(sorted_.withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    written = written.withColumn("part", F.shiftright("at", RECORD_BITS))
    parts = written.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy(group)
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col(group).alias("g"), F.col("part").alias("p"), "first", F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(whole).alias("left"))
    parts = materialize(parts, "merkle-parts")
    joined = written.join(small_side(parts), F.col(group).eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
    return joined.withColumn("idx", F.col("start") + F.col("at") - F.col("first")).drop("g", "p", "at", "part", "first", "start")


def _levels(leaves: DataFrame, group: str) -> list[DataFrame]:
    """Inner nodes ``group, level, idx, left, kids, digest``, a frame per level.

    ``left`` is the number of nodes that the level has in the group.  Each
    node is an aggregate of at most eight; a level is written before the next.
    """
    below, levels = leaves.select(group, "idx", "left", "digest"), []
    most = leaves.agg(F.coalesce(F.max("left"), F.lit(0))).first()[0]
    while most > 1:
        kids = F.sort_array(F.collect_list(F.struct("idx", "digest")))["digest"].alias("kids")
        runs = below.where("left > 1").groupBy(group, F.floor(F.col("idx") / RUN).alias("idx"), F.ceil(F.col("left") / RUN).alias("left")).agg(kids)
        digest = digest_of(F.array_join(F.transform("kids", as_hex), ""))
        nodes = runs.withColumn("level", F.lit(len(levels) + 1)).withColumn("digest", digest)
        levels.append(materialize(nodes, "merkle-level"))
        below = levels[-1].select(group, "idx", "left", "digest")
        most = -(-most // RUN)
    return levels


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _pointed(children: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each child with the node above it (``up_tree, up_level, up_idx``) and the segment towards it.

    A segment is an array with a struct for each level: the child's place in
    its run, and the run.  A group's root is a leaf of the top tree.  What has
    nothing above it has a null pointer and an empty segment.
    """
    ends = (F.col("left") == 1) & (F.col("tree") != TOP)
    number = F.when(ends, F.col("tree")).otherwise(F.col("idx"))
    child = children.select(
        "*",
        F.when(ends, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("to_tree"),
        F.when(ends, F.lit(1)).otherwise(F.col("level") + 1).cast("int").alias("to_level"),
        F.floor(number / RUN).alias("to_idx"),
        (number % RUN).cast("int").alias("place"),
    )
    above = nodes.select(F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("idx").alias("up_idx"), "kids")
    same = (F.col("to_tree") == F.col("up_tree")) & (F.col("to_level") == F.col("up_level")) & (F.col("to_idx") == F.col("up_idx"))
    met = child.join(small_side(above), same, "left")
    step = F.struct("place", "kids")
    return met.withColumn("path", F.when(F.col("kids").isNull(), F.array().cast("array<struct<place:int,kids:array<binary>>>")).otherwise(F.array(step))).drop(
        "to_tree", "to_level", "to_idx", "place", "kids"
    )


def _jumped(rows: DataFrame, upper: DataFrame) -> DataFrame:
    """Pointers of the nodes pointed at are taken over, and their segments appended."""
    further = upper.select(
        F.col("tree").alias("a_tree"), F.col("level").alias("a_level"), F.col("idx").alias("a_idx"),
        F.col("up_tree").alias("b_tree"), F.col("up_level").alias("b_level"), F.col("up_idx").alias("b_idx"), F.col("path").alias("more"),
    )
    same = (F.col("up_tree") == F.col("a_tree")) & (F.col("up_level") == F.col("a_level")) & (F.col("up_idx") == F.col("a_idx"))
    met = rows.join(small_side(further), same, "left")
    met = met.withColumn("path", F.when(F.col("more").isNull(), F.col("path")).otherwise(F.concat("path", "more")))
    return met.drop("up_tree", "up_level", "up_idx", "a_tree", "a_level", "a_idx", "more").withColumnsRenamed({"b_tree": "up_tree", "b_level": "up_level", "b_idx": "up_idx"})


def manifest(leaves: DataFrame) -> Manifest:
    """Trees over ``leaves`` (``grp, id, digest`` and any other columns) and a proof for every leaf.

    ``proofs`` has the columns of ``leaves``, ``idx``, ``subroot`` and
    ``path``.  Leaves of a group stand in order of ``id`` (nulls first; equal
    ids by digest), groups in order of ``grp`` (null first, by bytes); eight
    consecutive nodes make one above them until one is left.  Proofs double
    their reach: a node's segment leads to its parent first, then a self-join
    over the pointers appends the segment of the node it leads to, until every
    leaf has reached the root.  Inner nodes (a seventh of the leaves) are
    written each round, those far enough above the leaves; the leaves' joins
    stay in one plan.  Equal rows are leaves of their own.  Without leaves
    there is no root.
    """
    fixed = materialize(leaves.withColumn("nth", F.monotonically_increasing_id()), "merkle-leaves")
    placed = _numbered(fixed, "grp", ["id", "digest", "nth"]).drop("nth")
    placed = materialize(placed, "merkle-placed")
    levels = _levels(placed, "grp")
    ends = [f.where("left = 1").select("grp", "digest") for f in (placed, *levels)]
    groups = _numbered(_union(ends).withColumn("all", F.lit(0)), "all", ["grp"])
    groups = materialize(groups, "merkle-groups")
    tops = _levels(groups, "all")
    last = (tops[-1] if tops else groups).select("digest").take(1)
    root = bytes(last[0].digest).hex() if last else None

    ranks = groups.select(F.col("grp").alias("g"), F.col("idx").alias("tree"), as_hex("digest").alias("subroot"))
    with_rank = lambda rows: rows.join(small_side(ranks), F.col("grp").eqNullSafe(F.col("g"))).drop("g")
    shape = ["tree", "level", "idx", "left", "kids", "digest"]
    inner = [with_rank(f).select(*shape) for f in levels] + [f.withColumn("tree", F.lit(TOP).cast("long")).select(*shape) for f in tops]
    out = with_rank(placed).withColumn("level", F.lit(0))
    if not inner:
        empty = F.array().cast("array<struct<place:int,kids:array<binary>>>")
        return Manifest(out.withColumn("path", empty).drop("left", "tree", "level"), groups.limit(0), root)
    nodes = materialize(_union(inner), "merkle-nodes")
    height = len(levels) + len(tops)
    # how far a node may be above a leaf
    above = F.when(F.col("tree") == TOP, len(levels) + F.col("level")).otherwise(F.col("level"))
    upper = materialize(_pointed(nodes.drop("digest", "kids"), nodes), "merkle-jumps")
    out, reach = _pointed(out, nodes), 1
    while reach < height:
        out = _jumped(out, upper)
        reach *= 2
        if reach < height:
            upper = materialize(_jumped(upper.where(above >= reach), upper), "merkle-jumps")
    return Manifest(out.drop("left", "tree", "level", "up_tree", "up_level", "up_idx"), nodes, root)


def siblings(path: Column) -> Column:
    """Hex digests that a proof needs beside the leaf, level by level, left to right."""
    others = F.transform(path, lambda s: F.filter(s["kids"], lambda k, i: i != s["place"]))
    return F.transform(F.flatten(others), as_hex)


def folded(digest: Column, path: Column) -> Column:
    """The root's digest that a leaf and its siblings give."""

    def step(acc: Column, s: Column) -> Column:
        run = F.transform(s["kids"], lambda k, i: F.when(i == s["place"], as_hex(acc)).otherwise(as_hex(k)))
        return digest_of(F.array_join(run, ""))

    return F.aggregate(path, digest, step)


def verified_manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the digest of five fields, each with its length, so that null,
    empty text and values that run together all differ; ``lang`` is the group.
    Where 3 divides the crc32 of the decimal id the text is tampered with (its
    A-Z lowered; a null text or id, or a text without them, is left as it is),
    and the proof must then fail.  Rows that repeat are leaves of their own
    with different proofs.  Other columns are not read.  An empty table gives
    no rows.
    """
    text = F.when(crc_of_id() % TAMPERED == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    fields = {c: F.col(c) for c in FIELDS}
    leaves = docs.select(
        F.col("lang").alias("grp"), F.col("doc_id").alias("id"), leaf_digest(fields).alias("digest"), leaf_digest(fields | {"text": text}).alias("claimed")
    )
    made = manifest(leaves)
    path = F.col("path")
    return made.proofs.select(
        F.col("id").alias("doc_id"),
        as_hex("digest").alias("leaf"),
        "subroot",
        F.lit(made.root).cast("string").alias("root"),
        F.sha2(F.array_join(siblings(path), "").cast("binary"), 256).alias("proof_sha256"),
        as_hex(folded(F.col("claimed"), path)).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(levels: int = 9) -> str:
    """The trees level by level, ``levels`` of them: enough for 8 ** 9 leaves."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
    leaf = "sha256(" + " || ".join(field.format(c) for c in FIELDS) + ")"
    out = f"""
WITH crc AS (
    SELECT list_transform(range(256), lambda x: list_reduce(range(8),
        lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, x)) AS crc_table),
hashed AS (
    SELECT d.*, xor(list_reduce(
        list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS INT), 1)) AS BIGINT)),
        lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
    FROM documents d, crc),
tampered AS (
    SELECT * REPLACE (CASE WHEN h % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS text) FROM hashed),
claims AS (SELECT doc_id, {leaf} AS claimed FROM tampered),
l0 AS (
    SELECT doc_id, lang, {leaf} AS h, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
    FROM documents)"""
    # a node of one level has the number of its run as ``up``; a tree that is done stays as it is
    for prefix, key in (("l", "lang"), ("t", "0")):
        if prefix == "t":
            out += f""",
t0 AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM l{levels})"""
        for k in range(levels):
            by = "lang, i // 8" if prefix == "l" else "i // 8"
            first = "lang, " if prefix == "l" else ""
            out += f""",
{prefix}{k + 1} AS (
    SELECT {first}i // 8 AS i, any_value((n + 7) // 8) AS n, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
    FROM {prefix}{k} GROUP BY {by})"""
    out += """,
p0 AS (
    SELECT l.doc_id, l.lang, l.i, l.h AS leaf, c.claimed AS f, '' AS s FROM l0 l JOIN claims c ON c.doc_id = l.doc_id)"""
    step = 0
    for prefix in ("l", "t"):
        same = "r.lang IS NOT DISTINCT FROM p.lang AND " if prefix == "l" else ""
        for k in range(levels):
            at = f"p.i // CAST(8 ** {k} AS BIGINT)" if prefix == "l" else f"p.g // CAST(8 ** {k} AS BIGINT)"
            if prefix == "t" and k == 0:
                out += f""",
p{step + 1} AS (SELECT p.*, t.i AS g, l.h AS subroot FROM p{step} p JOIN t0 t ON t.lang IS NOT DISTINCT FROM p.lang JOIN l{levels} l ON l.lang IS NOT DISTINCT FROM p.lang)"""
                step += 1
            group = "lang, i // 8" if prefix == "l" else "i // 8"
            lang = "lang, " if prefix == "l" else ""
            out += f""",
r{step} AS (SELECT {lang}i // 8 AS run, any_value(n) AS n, list(h ORDER BY i) AS kids FROM {prefix}{k} GROUP BY {group}),
p{step + 1} AS (
    SELECT p.* REPLACE (
        CASE WHEN r.n = 1 THEN p.f ELSE sha256(array_to_string(list_transform(r.kids, lambda x, j: CASE WHEN j = {at} % 8 + 1 THEN p.f ELSE x END), '')) END AS f,
        CASE WHEN r.n = 1 THEN p.s ELSE p.s || array_to_string(list_filter(r.kids, lambda x, j: j <> {at} % 8 + 1), '') END AS s)
    FROM p{step} p JOIN r{step} r ON {same}r.run = {at} // 8)"""
            step += 1
    return out + f"""
SELECT p.doc_id, p.leaf, p.subroot, t.h AS root, sha256(p.s) AS proof_sha256, p.f AS folded_root, p.f = t.h AS verified
FROM p{step} p, t{levels} t
"""


SQL = _sql()
