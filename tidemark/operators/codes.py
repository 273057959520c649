"""Code tables: sorted distinct values numbered from zero."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.keys import number_rows
from tidemark.session import materialize


def code_table(df: DataFrame, column: str, code: str) -> DataFrame:
    """One row per distinct non-null value with its position in sort order.

    The distinct values are written to the shared folder, so ``df`` is read
    once for them.
    """
    values = materialize(df.select(column).where(F.col(column).isNotNull()).distinct(), "code-values")
    return number_rows(values, [column], code, after=-1)


def encode(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add a code column per category column; rows with a null category drop out.

    Every code table numbers the values of the whole input, so codes depend
    neither on the order of the columns nor on nulls in other columns.
    """
    tables = {column: code_table(df, column, code) for column, code in columns.items()}
    for column, table in tables.items():
        df = lookup_join(df, table, [column], "inner")
    return df
