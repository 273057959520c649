"""Slowly changing dimension and surrogate key queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import keys, scd2, windows
from tidemark.operators.scd2 import ACTION, Scd2Spec
from tidemark.workload.changes import ORDERS_SQL, batch_one, batch_two, target_orders
from tidemark.workload.registry import query, read, sql_checksum, sql_hash_key

TRACKED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDER_DIM = Scd2Spec(keys=("o_orderkey",), tracked=tuple(TRACKED))


def _dated(batch, day: str):
    return batch.withColumn(ORDER_DIM.start, F.lit(day).cast("date"))


def first_dimension(spark, d):
    """The dimension as the first load wrote it; the next load reads that table."""
    dim = scd2.apply(None, _dated(target_orders(spark, d), "2024-01-01"), ORDER_DIM).drop(ACTION)
    return scd2.written(dim, ORDER_DIM, "order-dim")


def _second(spark, d):
    return scd2.apply(first_dimension(spark, d), _dated(batch_one(spark, d), "2024-02-01"), ORDER_DIM)


def _three_batches(spark, d, compat: bool):
    first = first_dimension(spark, d)
    second = scd2.apply(first, _dated(batch_one(spark, d), "2024-02-01"), ORDER_DIM, compat)
    dim = scd2.written(second.drop(ACTION), ORDER_DIM, "order-dim")
    return scd2.apply(dim, _dated(batch_two(spark, d), "2024-03-01"), ORDER_DIM, compat).drop(ACTION)


_COLS = ", ".join(["o_orderkey", *TRACKED])
_HASHED = f"{sql_hash_key(['o_orderkey'])} AS \"Hash_Join_key\", {sql_checksum(['o_orderkey', *TRACKED])} AS checksum"


def _load_sql(step: int, dim: str, batch: str, day: str, compat: bool = False) -> str:
    """CTEs that load ``batch`` into ``dim`` and leave it in ``dim{step}``."""
    if compat:
        unknown = f"NOT EXISTS (SELECT 1 FROM {dim} x WHERE x.o_orderkey = b.o_orderkey AND x.checksum = b.checksum)"
    else:
        unknown = (
            f"NOT EXISTS (SELECT 1 FROM {dim} x WHERE x.o_orderkey = b.o_orderkey "
            'AND x.checksum = b.checksum AND x."Current_Record" = \'Y\')'
        )
    return f"""
    b{step} AS (SELECT {_COLS}, {_HASHED} FROM {batch}),
    upd{step} AS (
      SELECT c.sk, c."Hash_Join_key", {", ".join("c." + x for x in ["o_orderkey", *TRACKED])}, c."Effective_Start_Date",
             CASE WHEN c."Current_Record" = 'Y' AND b.checksum <> c.checksum
                  THEN greatest(DATE '{day}' - 1, c."Effective_Start_Date") ELSE c."Effective_End_Date" END AS "Effective_End_Date",
             CASE WHEN c."Current_Record" = 'Y' AND b.checksum <> c.checksum THEN 'N' ELSE c."Current_Record" END AS "Current_Record",
             c.checksum,
             CASE WHEN c."Current_Record" = 'Y' AND b.checksum <> c.checksum THEN 'closed' ELSE 'kept' END AS _action
      FROM {dim} c LEFT JOIN b{step} b ON c.o_orderkey = b.o_orderkey),
    ins{step} AS (
      SELECT b.*, o_orderkey IN (SELECT o_orderkey FROM {dim}) AS seen FROM b{step} b WHERE {unknown}),
    new{step} AS (
      SELECT (SELECT max(sk) FROM {dim}) + row_number() OVER (ORDER BY o_orderkey) AS sk, "Hash_Join_key", {_COLS},
             CASE WHEN seen THEN DATE '{day}' ELSE DATE '1900-01-01' END AS "Effective_Start_Date",
             CAST(NULL AS DATE) AS "Effective_End_Date", 'Y' AS "Current_Record", checksum,
             CASE WHEN seen THEN 'new_version' ELSE 'new_key' END AS _action
      FROM ins{step}),
    all{step} AS (SELECT * FROM upd{step} UNION ALL SELECT * FROM new{step}),
    dim{step} AS (SELECT * EXCLUDE (_action) FROM all{step})
    """


_DIM0 = f"""
dim0 AS (
  SELECT 1000 + row_number() OVER (ORDER BY o_orderkey) AS sk, {sql_hash_key(['o_orderkey'])} AS "Hash_Join_key", {_COLS},
         DATE '1900-01-01' AS "Effective_Start_Date", CAST(NULL AS DATE) AS "Effective_End_Date",
         'Y' AS "Current_Record", {sql_checksum(['o_orderkey', *TRACKED])} AS checksum
  FROM t0)
"""
_STEP1 = f"WITH {ORDERS_SQL}, {_DIM0}, {_load_sql(1, 'dim0', 's1', '2024-02-01')}"


@query(f"{_STEP1}, {_load_sql(2, 'dim1', 's2', '2024-03-01')} SELECT * FROM dim2")
def scd2_apply(spark, d):
    return _three_batches(spark, d, compat=False)


@query(
    f"WITH {ORDERS_SQL}, {_DIM0}, {_load_sql(1, 'dim0', 's1', '2024-02-01', True)}, "
    f"{_load_sql(2, 'dim1', 's2', '2024-03-01', True)} SELECT * FROM dim2"
)
def scd2_apply_compat(spark, d):
    return _three_batches(spark, d, compat=True)


@query(f"{_STEP1} SELECT * FROM all1 WHERE _action = 'closed'")
def scd2_close(spark, d):
    return _second(spark, d).where(F.col(ACTION) == "closed")


@query(f"{_STEP1} SELECT * FROM all1 WHERE _action = 'new_key'")
def scd2_new_keys(spark, d):
    return _second(spark, d).where(F.col(ACTION) == "new_key")


@query(f"{_STEP1} SELECT * FROM all1 WHERE _action = 'new_version'")
def scd2_new_versions(spark, d):
    return _second(spark, d).where(F.col(ACTION) == "new_version")


CUSTOMER_HISTORY = Scd2Spec(
    keys=("o_custkey",), tracked=("o_orderpriority", "o_orderstatus"), open_end="9999-12-31"
)


def _order_versions(spark, d):
    """One version per customer and order date: the order with the highest key."""
    orders = read(spark, d, "orders").withColumn(CUSTOMER_HISTORY.start, F.to_date("o_orderdate"))
    unique = windows.top_one(orders, ["o_custkey", CUSTOMER_HISTORY.start], [F.col("o_orderkey").desc()])
    return unique.select("o_custkey", "o_orderpriority", "o_orderstatus", CUSTOMER_HISTORY.start)


_REBUILD_COLS = ["o_custkey", "o_orderpriority", "o_orderstatus"]
_REBUILD = f"""
WITH versions AS (
  SELECT o_custkey, o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS start FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1),
hashed AS (
  SELECT *, {sql_hash_key(["o_custkey"])} AS "Hash_Join_key", {sql_checksum(_REBUILD_COLS)} AS checksum FROM versions),
marked AS (SELECT *, lag(checksum) OVER (PARTITION BY o_custkey ORDER BY start) AS before FROM hashed),
kept AS (
  SELECT "Hash_Join_key", {", ".join(_REBUILD_COLS)}, checksum,
         CASE WHEN before IS NULL THEN DATE '1900-01-01' ELSE start END AS start
  FROM marked WHERE before IS NULL OR before <> checksum),
ended AS (SELECT *, lead(start) OVER (PARTITION BY o_custkey ORDER BY start) AS nxt FROM kept)
SELECT "Hash_Join_key", {", ".join(_REBUILD_COLS)}, start AS "Effective_Start_Date",
       CASE WHEN nxt IS NULL THEN DATE '9999-12-31' ELSE nxt - 1 END AS "Effective_End_Date",
       CASE WHEN nxt IS NULL THEN 'Y' ELSE 'N' END AS "Current_Record", checksum
FROM ended
"""


@query(_REBUILD)
def scd2_rebuild(spark, d):
    dates = read(spark, d, "orders").select(F.to_date("o_orderdate").alias(CUSTOMER_HISTORY.start))
    return scd2.rebuild(_order_versions(spark, d), CUSTOMER_HISTORY, dates)


@query(_REBUILD)
def scd2_merge_history(spark, d):
    # every second year arrives late, older than versions already loaded
    versions = _order_versions(spark, d)
    early = F.year(CUSTOMER_HISTORY.start).isin(1995, 1997, 1999, 2001)
    start = F.col(CUSTOMER_HISTORY.start)
    loaded = scd2.prepare(versions.where(early), CUSTOMER_HISTORY).withColumn(CUSTOMER_HISTORY.start, start)
    return scd2.merge_history(loaded, versions.where(~early), CUSTOMER_HISTORY)


@query("""
SELECT c_custkey, c_name, 1000 + row_number() OVER (ORDER BY c_name) AS customer_sk FROM customer
""")
def surrogate_key(spark, d):
    customers = read(spark, d, "customer").select("c_custkey", "c_name")
    return keys.surrogate_key(customers, ["c_name"], "customer_sk")


@query("""
SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events
""")
def lead_next(spark, d):
    events = read(spark, d, "events").select("event_id", "user_id", "ts")
    return windows.neighbour(events, ["user_id"], ["ts", "event_id"], "ts", "next_ts")
