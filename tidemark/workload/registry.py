"""Named queries over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with equivalent SQL if there is any."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)").alias(column)


def sql_text(columns: list[str]) -> str:
    """SQL for the canonical row text."""
    tokens = [f"coalesce(length(CAST({c} AS VARCHAR))||':'||CAST({c} AS VARCHAR),'-')" for c in columns]
    return f"concat_ws(chr(31), {', '.join(tokens)})"


def sql_checksum(columns: list[str]) -> str:
    return f"sha256({sql_text(columns)})"


def sql_hash_key(columns: list[str]) -> str:
    return f"md5({sql_text(columns)})"
