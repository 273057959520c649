"""Size checks that decide whether one side of a join may be broadcast."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_BYTES = 16


class Size(NamedTuple):
    rows: int
    bytes: int


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of the variable-width values plus a flat charge per column."""
    parts = [F.lit(FIXED_BYTES * len(df.columns))]
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(col), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(col.cast("string")), F.lit(0)))
    return reduce(lambda x, y: x + y, parts)


def measure(df: DataFrame) -> Size:
    """Rows and approximate bytes of ``df``: one distributed aggregate, one row back."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b"),
    ).first()
    return Size(row["n"], row["b"])


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    size = measure(df)
    return size.rows <= max_rows and size.bytes <= max_bytes
