"""Joins and unions assembled from dimension and fact mapping rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.project import union_all_by_name
from tidemark.spec import DIRECT, as_flag


def load_rows(rows: DataFrame, target: str) -> dict[str, list[Row]]:
    """Mapping rows of one target table by source table, the driving table first."""
    found = rows.where(rows.Target_Table == target).orderBy("ID").collect()
    by_table: dict[str, list[Row]] = {}
    for r in sorted(found, key=lambda r: not as_flag(r.Is_Driving_Table)):
        by_table.setdefault(r.Source_Table, []).append(r)
    return by_table


def _columns(rows: list[Row], taken: set[str]) -> list[Column]:
    out = []
    for r in rows:
        if r.Target_Column in taken:
            continue
        taken.add(r.Target_Column)
        direct = (r.Transformation or DIRECT).lower() == DIRECT
        out.append((F.col(r.Source_Column) if direct else F.expr(r.Transformation)).alias(r.Target_Column))
    return out


def _join_rows(rows: list[Row]) -> list[Row]:
    return [r for r in rows if as_flag(r.Is_Join_Key) and r.Join_Table]


def _hidden(table: str, column: str) -> str:
    return f"_{table}_{column}"


def joined(tables: dict[str, DataFrame], mapping: dict[str, list[Row]], how: str = "inner") -> DataFrame:
    """Join the mapped tables and project the target columns, each once.

    A table joins on its key rows, which name the column of an earlier table
    that each key equals; a table without such a row is an error.  Every
    joined table holds one row per key.
    """
    needed = {(r.Join_Table, r.Join_Table_Column) for rows in mapping.values() for r in _join_rows(rows)}
    taken: set[str] = set()
    out = None
    for table, rows in mapping.items():
        keys = _join_rows(rows)
        own = {c for t, c in needed if t == table} | {r.Source_Column for r in keys}
        frame = tables[table].select(
            *_columns(rows, taken), *[F.col(c).alias(_hidden(table, c)) for c in sorted(own)]
        )
        if out is None:
            out = frame
            continue
        if not keys:
            raise ValueError(f"{table} has no join key")
        pairs = {_hidden(table, r.Source_Column): _hidden(r.Join_Table, r.Join_Table_Column) for r in keys}
        kept = {name: f"{name}_kept" for name in pairs}
        frame = frame.withColumns({copy: F.col(name) for name, copy in kept.items()})
        out = out.withColumns({name: F.col(left) for name, left in pairs.items()})
        out = lookup_join(out, frame, list(pairs), how).drop(*pairs)
        out = out.withColumnsRenamed({copy: name for name, copy in kept.items()})
    return out.select(*[c for c in out.columns if c in taken])


def unioned(tables: dict[str, DataFrame], mapping: dict[str, list[Row]]) -> DataFrame:
    """UNION ALL of the mapped tables by target name; missing columns become null."""
    return union_all_by_name(tables[t].select(*_columns(rows, set())) for t, rows in mapping.items())


def assemble(tables: dict[str, DataFrame], mapping: dict[str, list[Row]]) -> DataFrame:
    """The driving and JOIN tables joined, then the UNION tables appended."""
    is_union = {t: any((r.Join_Type or "").upper() == "UNION" for r in rows) for t, rows in mapping.items()}
    parts = [joined(tables, {t: rows for t, rows in mapping.items() if not is_union[t]})]
    parts += [unioned(tables, {t: rows}) for t, rows in mapping.items() if is_union[t]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
