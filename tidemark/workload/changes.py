"""A target and two change batches cut from the orders and lineitem tables by date.

The target holds the orders before 2000.  Batch one holds those since 1999
with open orders re-priced, so it inserts (2000 on), updates (open, 1999) and
repeats (not open, 1999) rows, and leaves older ones alone.  Batch two holds
those since July 1999 at the original price, which takes the re-priced orders
back to their first state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workload.registry import money, ntz, read

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
RUN_TS = "2024-06-01 12:00:00"


def all_orders(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").withColumn("o_totalprice", money("o_totalprice")).select(*ORDER_COLUMNS)


def _repriced(orders: DataFrame) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 100).otherwise(F.col("o_totalprice"))
    return orders.withColumn("o_totalprice", price.cast("decimal(18,2)"))


def target_orders(spark: SparkSession, d: str) -> DataFrame:
    return all_orders(spark, d).where(F.col("o_orderdate") < ntz("2000-01-01"))


def batch_one(spark: SparkSession, d: str) -> DataFrame:
    return _repriced(all_orders(spark, d).where(F.col("o_orderdate") >= ntz("1999-01-01")))


def batch_two(spark: SparkSession, d: str) -> DataFrame:
    return all_orders(spark, d).where(F.col("o_orderdate") >= ntz("1999-07-01"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem")
    return rows.withColumns({c: money(c) for c in ("l_quantity", "l_extendedprice")}).select(*LINE_COLUMNS)


def target_lines(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).where(F.col("l_shipdate") < ntz("2000-01-01"))


def batch_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).where(F.col("l_shipdate") >= ntz("1999-01-01"))
    more = F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return rows.withColumn("l_quantity", more.cast("decimal(18,2)"))


ORDERS_SQL = """
all_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders),
t0 AS (SELECT * FROM all_orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
s1 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 100 ELSE o_totalprice END AS DECIMAL(18,2)) AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM all_orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
s2 AS (SELECT * FROM all_orders WHERE o_orderdate >= TIMESTAMP '1999-07-01')
"""

_LINE_ORDER = ", ".join(f"{c} DESC" for c in ["l_shipdate", *LINE_COLUMNS[2:]])

LINES_SQL = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem),
later AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity + 1 ELSE l_quantity END AS DECIMAL(18,2)) AS l_quantity,
         l_extendedprice, l_returnflag, l_linestatus, l_shipdate
  FROM lines WHERE l_shipdate >= TIMESTAMP '1999-01-01'),
t0 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
    FROM lines WHERE l_shipdate < TIMESTAMP '2000-01-01') WHERE rn = 1),
s1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
    FROM later) WHERE rn = 1)
"""


def merge_sql(
    ctes: str,
    keys: list[str],
    columns: list[str],
    changed: str,
    immutable: tuple[str, ...] = (),
    stamps: dict[str, str] | None = None,
    target: str = "t0",
    source: str = "s1",
) -> str:
    """A full-outer-join merge; ``changed`` is a condition over t and s."""
    k = keys[0]
    update = f"(t.{k} IS NOT NULL AND s.{k} IS NOT NULL AND ({changed}))"
    action = f"CASE WHEN t.{k} IS NULL THEN 'I' WHEN s.{k} IS NULL THEN 'K' WHEN {changed} THEN 'U' ELSE 'N' END"
    out = [f"coalesce(t.{c}, s.{c}) AS {c}" for c in keys]
    for c in columns:
        take = f"t.{k} IS NULL" if c in immutable else f"t.{k} IS NULL OR {update}"
        out.append(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}")
    for c, value in (stamps or {}).items():
        out.append(f"CASE WHEN t.{k} IS NULL OR {update} THEN {value} END AS {c}")
    on = " AND ".join(f"t.{c} = s.{c}" for c in keys)
    return f"WITH {ctes} SELECT {', '.join(out)}, {action} AS _action FROM {target} t FULL OUTER JOIN {source} s ON {on}"


def distinct_sql(columns: list[str], plain: bool = False) -> str:
    test = "t.{0} <> s.{0}" if plain else "t.{0} IS DISTINCT FROM s.{0}"
    return " OR ".join(test.format(c) for c in columns)
