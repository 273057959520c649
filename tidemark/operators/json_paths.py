"""Paths and types inside JSON text, however deep, and how they differ from the known ones."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

MALFORMED = "malformed"
#: Levels taken apart in the first pass; texts that go deeper need further ones, each of twice as many up to the most.
LEVELS, MOST_LEVELS = 4, 16


def _kind(shape: Column) -> Column:
    """The plain name of a VARIANT value's type; 7.0 is a decimal without places there, and a double here."""
    return (
        F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").when(shape == "VOID", "null")
        .when(shape.rlike(r"^DECIMAL\((19|[23]\d),0\)"), "decimal").when(shape.startswith("DECIMAL"), "double").otherwise(F.lower(shape))
    )


def _leaves(values: DataFrame, levels: int) -> DataFrame:
    """``values`` with ``v`` taken apart ``levels`` times: a row for each innermost value, its steps in ``_s1`` and on.

    A value with anything inside is counted by its first innermost one:
    ``_own`` is the level of the outermost value that a row stands for.
    """
    for level in range(1, levels + 1):
        inside = values.lateralJoin(values.sparkSession.tvf.variant_explode_outer(F.col("v").outer()).toDF("_at", "_name", "_value"))
        step = F.when(F.col("_at").isNull(), None).when(F.col("_name").isNull(), "[]").otherwise(F.concat(F.lit("."), "_name"))
        values = inside.withColumns(
            {f"_s{level}": step, "_own": F.when(F.col("_at") > 0, level).otherwise(F.col("_own")), "v": F.coalesce("_value", "v")}
        ).drop("_at", "_name", "_value")
    return values


def json_paths(df: DataFrame, column: str) -> DataFrame:
    """``path, type, n_values`` for every path in a column of JSON text.

    The text is parsed to VARIANT and taken apart to ``LEVELS`` levels in one
    pass, deeper texts in further ones, until no object or array is left.
    Innermost values are counted by their steps before the shuffle, so a path
    that all rows have is one row from each task; what they lie in follows
    from these counts, which are written once.  ``$`` is the whole text,
    ``.name`` a field, ``[]`` any element.  A path has a row for each type it
    occurs with, null among them; text that is not JSON counts as
    ``malformed`` at ``$``, null text not at all.
    """
    values = df.where(F.col(column).isNotNull()).select(F.lit("$").alias("path"), F.lit(0).alias("_own"), F.try_parse_json(column).alias("v"))
    counted = []
    for levels in (min(LEVELS << i, MOST_LEVELS) for i in count()):
        steps = [f"_s{i}" for i in range(1, levels + 1)]
        leaves = _leaves(values, levels).withColumn("_shape", F.schema_of_variant("v"))
        groups = materialize(leaves.groupBy("path", *steps, "_own", "_shape").agg(F.count(F.lit(1)).alias("_n")), "json-paths")
        counted.append(_paths(groups, steps))
        nested = (F.col(steps[-1]).isNotNull()) & F.col("_shape").rlike("^(OBJECT|ARRAY)")
        if groups.where(nested).isEmpty():
            return reduce(DataFrame.unionByName, counted).groupBy("path", "type").agg(F.sum("n_values").alias("n_values"))
        # a value that is left was counted with its type above; only what is inside is new
        values = leaves.where(nested).select(F.concat("path", *[F.coalesce(s, F.lit("")) for s in steps]).alias("path"), F.lit(1).alias("_own"), "v")


def _paths(groups: DataFrame, steps: list[str]) -> DataFrame:
    """``path, type, n_values`` of innermost values and of all that they are the first in."""
    shaped = groups.select("path", "_own", "_n", "_shape", F.array_compact(F.array(*steps)).alias("_steps"))
    depth = F.size("_steps")
    levels = F.when(F.col("_own") <= depth, F.sequence("_own", depth))
    each = shaped.withColumn("_level", F.explode(levels))
    after = F.get("_steps", F.col("_level"))
    kind = (
        F.when(after == "[]", "array").when(after.isNotNull(), "object")
        .otherwise(F.coalesce(_kind(F.col("_shape")), F.lit(MALFORMED)))
    )
    path = F.concat("path", F.array_join(F.slice("_steps", 1, F.col("_level")), ""))
    return each.groupBy(path.alias("path"), kind.alias("type")).agg(F.sum("_n").alias("n_values"))


def json_path_drift(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """``change, path, source_types, target_type, n_values``: paths added, removed and retyped.

    ``known`` has ``path, type``.  A path is retyped if it occurs with any
    other type than the known one; nulls have no type and change nothing, and
    a path that is null everywhere is not added.  ``source_types`` are joined
    by ``|``.
    """
    typed = json_paths(df, column).where("type <> 'null'").groupBy("path")
    found = typed.agg(F.array_join(F.array_sort(F.collect_set("type")), "|").alias("source_types"), F.sum("n_values").alias("n_values"))
    both = found.join(known.select("path", F.col("type").alias("target_type")), "path", "full")
    change = F.when(F.col("target_type").isNull(), "added").when(F.col("source_types").isNull(), "removed").when(F.col("source_types") != F.col("target_type"), "retyped")
    return both.select(change.alias("change"), "path", "source_types", "target_type", "n_values").where("change IS NOT NULL")
