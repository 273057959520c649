"""Row checksums and hash keys built from one canonical row text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "\u001f"
NULL_TOKEN = "-"


def as_text(df: DataFrame, name: str) -> Column:
    """The column as text, independent of the session time zone."""
    return text_of(F.col(name), df.schema[name].dataType, name)


def text_of(col: Column, dtype: T.DataType, name: str = "value") -> Column:
    """Canonical text of a value, part by part: timestamps in microseconds, elements with their lengths."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, T.ArrayType):
        parts = F.transform(col, lambda x: token(text_of(x, dtype.elementType, name)))
        return F.concat(F.lit("["), F.array_join(parts, SEPARATOR), F.lit("]"))
    if isinstance(dtype, T.StructType):
        parts = [token(text_of(col[f.name], f.dataType, f"{name}.{f.name}")) for f in dtype]
        return F.when(col.isNotNull(), F.concat(F.lit("{"), F.concat_ws(SEPARATOR, *parts), F.lit("}")))
    if isinstance(dtype, T.MapType):
        raise TypeError(f"{name}: a map has no canonical order; convert it before hashing")
    return col.cast("string")


def token(text: Column) -> Column:
    """A text with its length before it; null has a token of its own."""
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(NULL_TOKEN))


def row_text(df: DataFrame, columns: Iterable[str]) -> Column:
    """One text per row that differs whenever any column differs.

    Every value carries its length, so moving characters between neighbouring
    columns changes the text, and null differs from the empty string.
    """
    return F.concat_ws(SEPARATOR, *[token(as_text(df, name)) for name in columns])


def row_checksum(df: DataFrame, columns: Iterable[str] | None = None, exclude: Iterable[str] = ()) -> Column:
    """SHA-256 over the row text of ``columns`` (default: all but ``exclude``)."""
    skipped = set(exclude)
    chosen = [c for c in (columns or df.columns) if c not in skipped]
    return F.sha2(row_text(df, chosen), 256)


def hash_key(df: DataFrame, columns: Iterable[str]) -> Column:
    """MD5 over the row text of the business keys."""
    return F.md5(row_text(df, columns))


def register_hash_key(spark: SparkSession, name: str, keys: int | list[str]) -> None:
    """Make the hash key callable from SQL: a temporary function of so many text arguments, or of the given types.

    A timestamp must be declared as one, so that its key is that of
    :func:`hash_key`.  It expands to built-in functions, so no Python runs per
    row.
    """
    types = ["string"] * keys if isinstance(keys, int) else [k.lower() for k in keys]
    arguments = [f"k{i}" for i in range(len(types))]
    as_text_ = {"timestamp": "cast(unix_micros({}) as string)", "binary": "hex({})"}
    texts = [as_text_.get(t, "cast({} as string)").format(a) for a, t in zip(arguments, types)]
    tokens = [f"coalesce(concat(length({x}), ':', {x}), '{NULL_TOKEN}')" for x in texts]
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({', '.join(f'{a} {t}' for a, t in zip(arguments, types))}) "
        f"RETURNS STRING RETURN md5(concat_ws('{SEPARATOR}', {', '.join(tokens)}))"
    )
