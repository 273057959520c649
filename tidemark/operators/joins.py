"""Joins against lookup tables, key sets and generated table lists."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import all_of, any_null, differs
from tidemark.functions.sizing import fits_broadcast


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    lookup_fits: bool | None = None,
) -> DataFrame:
    """Join a large table with a table that has at most one row per key.

    ``how`` is inner, left, left_semi or left_anti.  A lookup that passes the
    size check is broadcast.  A larger one is joined in one shuffle that reads
    each side once, so a chain of joins grows by one scan with each: rows with
    a null key match nothing and are spread by their content, and Spark splits
    the partition of a hot key while it runs (adaptive skew join).
    """
    if lookup_fits is None:
        lookup_fits = fits_broadcast(lookup)
    if lookup_fits:
        return rows.join(F.broadcast(lookup), on, how)
    content = [f.name for f in rows.schema if not _holds_map(f.dataType)]
    spread = F.when(any_null(on), F.xxhash64(*content)).otherwise(F.lit(0).cast("bigint"))
    left = rows.withColumn("_spread", spread)
    return left.join(lookup.withColumn("_spread", F.lit(0).cast("bigint")), [*on, "_spread"], how).drop("_spread")


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def new_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target does not hold yet."""
    return lookup_join(source, target.select(*keys).distinct(), keys, "left_anti")


def rows_with_keys(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs in another query's result (an IN list without collecting it)."""
    return lookup_join(df, wanted.select(*keys).distinct(), keys, "left_semi")


def changed_rows(source: DataFrame, current: DataFrame, keys: list[str], compare: list[str], null_safe: bool = True) -> DataFrame:
    """Source rows that match a current row on the keys and differ in a compared column.

    ``current`` has one row per key.
    """
    old = current.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in compare])
    joined = lookup_join(source, old, keys, "inner")
    changed = differs(F.struct(*compare), F.struct(*[F.col(f"_old_{c}").alias(c) for c in compare]))
    if not null_safe:
        changed = F.lit(False)
        for c in compare:
            changed = changed | differs(F.col(c), F.col(f"_old_{c}"), null_safe=False)
    return joined.where(changed).select(*source.columns)


def multi_key_condition(left: DataFrame, right: DataFrame, pairs: Iterable[tuple[str, str]]) -> Column:
    """``left.a = right.x AND left.b = right.y ...`` from mapped column pairs."""
    return all_of([left[a] == right[b] for a, b in pairs])


@dataclass(frozen=True)
class JoinStep:
    """One joined table of a generated join: key pairs and the columns it adds."""

    table: DataFrame
    on: tuple[tuple[str, str], ...]
    columns: dict[str, str] = field(default_factory=dict)
    how: str = "left"


def generated_join(driving: DataFrame, columns: dict[str, str], steps: list[JoinStep]) -> DataFrame:
    """Join a driving table with the listed tables and project.

    ``columns`` and each step's ``columns`` map an output name to a SQL
    expression over that table.  Each joined table holds one row per key.  A
    later step may join on an output column of an earlier one.
    """
    out = driving.withColumns({name: F.expr(text) for name, text in columns.items()})
    produced = list(columns)
    for i, step in enumerate(steps):
        if not step.on:
            raise ValueError("a joined table needs at least one join key")
        right = step.table.select(
            *[F.col(r).alias(f"_k{i}_{n}") for n, (_, r) in enumerate(step.on)],
            *[F.expr(text).alias(name) for name, text in step.columns.items()],
        )
        keyed = out.withColumns({f"_k{i}_{n}": F.col(left) for n, (left, _) in enumerate(step.on)})
        names = [f"_k{i}_{n}" for n in range(len(step.on))]
        out = lookup_join(keyed, right, names, step.how).drop(*names)
        produced += list(step.columns)
    return out.select(*produced)
