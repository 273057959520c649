"""Upsert, update, delete and latest-flag queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_key as hash_key_of
from tidemark.functions.hashing import register_hash_key
from tidemark.functions.hashing import row_checksum as checksum_of
from tidemark.operators import latest, upsert
from tidemark.operators.upsert import ACTION
from tidemark.session import materialize, shared_dir
from tidemark.sinks.buckets import BucketedTable
from tidemark.sinks.files import write_parquet
from tidemark.sinks.tables import load_staged, merge_partitions
from tidemark.workload.changes import (
    LINE_COLUMNS, LINES_SQL, ORDER_COLUMNS, ORDERS_SQL, RUN_TS, all_orders, batch_lines, batch_one,
    distinct_sql, merge_sql, target_lines, target_orders,
)
from tidemark.workload.registry import money, ntz, query, read, sql_checksum, sql_hash_key

KEY = ["o_orderkey"]
REST = ORDER_COLUMNS[1:]


@query(merge_sql(ORDERS_SQL, KEY, REST, distinct_sql(REST), stamps={"last_modified": f"TIMESTAMP '{RUN_TS}'"}))
def upsert_columns(spark, d):
    return upsert.upsert_columns(
        target_orders(spark, d), batch_one(spark, d), KEY, run_ts=ntz(RUN_TS), modified="last_modified"
    )


@query(f"SELECT * EXCLUDE (_action) FROM ({merge_sql(ORDERS_SQL, KEY, REST, distinct_sql(REST), stamps={'last_modified': f'TIMESTAMP {chr(39)}{RUN_TS}{chr(39)}'})})")
def upsert_bucketed(spark, d):
    """The same merge into a table in hash buckets of the key, of which only the touched ones are rewritten."""
    table = BucketedTable(spark, shared_dir(spark, "orders-bucketed"), KEY, buckets=32)
    table.upsert(target_orders(spark, d).withColumn("last_modified", F.lit(None).cast("timestamp_ntz")))
    table.upsert(batch_one(spark, d), stamp={"last_modified": ntz(RUN_TS)})
    return table.read()


_NULLED_SQL = ORDERS_SQL + """,
t1 AS (SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM t0)
"""


def _nulled(spark, d):
    return target_orders(spark, d).withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))


@query(merge_sql(_NULLED_SQL, KEY, REST, distinct_sql(REST), target="t1"))
def upsert_columns_null_safe(spark, d):
    return upsert.upsert_columns(_nulled(spark, d), batch_one(spark, d), KEY)


@query(merge_sql(_NULLED_SQL, KEY, REST, distinct_sql(REST, plain=True), target="t1"))
def upsert_columns_plain(spark, d):
    return upsert.upsert_columns(_nulled(spark, d), batch_one(spark, d), KEY, null_safe=False)


_CHECKED_SQL = ORDERS_SQL + f""",
t1 AS (SELECT *, {sql_checksum(ORDER_COLUMNS)} AS checksum FROM t0),
b1 AS (SELECT *, {sql_checksum(ORDER_COLUMNS)} AS checksum FROM s1)
"""


def checked(df):
    return df.withColumn("checksum", checksum_of(df))


@query(merge_sql(_CHECKED_SQL, KEY, [*REST, "checksum"], distinct_sql(["checksum"]), target="t1", source="b1"))
def upsert_checksum(spark, d):
    batch = materialize(checked(batch_one(spark, d)), "checked-batch")
    return upsert.upsert_checksum(checked(target_orders(spark, d)), batch, KEY)


@query(merge_sql(ORDERS_SQL, KEY, REST, distinct_sql(REST)).replace("SELECT coalesce", "SELECT CAST(year(coalesce(t.o_orderdate, s.o_orderdate)) AS INTEGER) AS order_year, coalesce", 1))
def upsert_partitioned(spark, d):
    path = shared_dir(spark, "orders-by-year")
    year = F.year("o_orderdate")
    write_parquet(target_orders(spark, d).withColumn("order_year", year), path, partition_by=["order_year"])
    batch = batch_one(spark, d).withColumn("order_year", year)
    actions = merge_partitions(spark, path, batch, KEY, ["order_year"]).select("o_orderkey", ACTION)
    kept = spark.read.parquet(path).join(actions, KEY, "left")
    return kept.withColumn(ACTION, F.coalesce(ACTION, F.lit("K")))


@query(merge_sql(ORDERS_SQL, KEY, REST, "TRUE"))
def upsert_overwrite(spark, d):
    return upsert.upsert_overwrite(target_orders(spark, d), batch_one(spark, d), KEY)


LINE_KEY = LINE_COLUMNS[:2]
LINE_REST = LINE_COLUMNS[2:]


@query(
    merge_sql(
        LINES_SQL, LINE_KEY, LINE_REST,
        distinct_sql([c for c in LINE_REST if c != "l_suppkey"]), immutable=("l_suppkey",),
    )
)
def upsert_fact(spark, d):
    order = [F.col("l_shipdate").desc()]
    target = materialize(upsert.dedupe_batch(target_lines(spark, d), LINE_KEY, order), "lines-table")
    source = materialize(upsert.dedupe_batch(batch_lines(spark, d), LINE_KEY, order), "lines-batch")
    return upsert.upsert_fact(target, source, LINE_KEY, ["l_suppkey"])


@query(
    merge_sql(
        """
        t0 AS (SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value
               FROM events WHERE ts < TIMESTAMP '2024-01-20'),
        s1 AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'fixed' ELSE event_type END AS event_type,
                      CAST(value AS DECIMAL(18,2)) AS value
               FROM events WHERE ts >= TIMESTAMP '2024-01-15')
        """,
        ["user_id", "event_id"], ["event_type", "value"], "TRUE",
    )
)
def upsert_star(spark, d):
    events = read(spark, d, "events").withColumn("value", money("value"))
    columns = ["user_id", "event_id", "event_type", "value"]
    target = events.where(F.col("ts") < ntz("2024-01-20")).select(*columns)
    fixed = F.when(F.col("event_type") == "error", "fixed").otherwise(F.col("event_type"))
    source = events.where(F.col("ts") >= ntz("2024-01-15")).withColumn("event_type", fixed).select(*columns)
    return upsert.upsert_overwrite(target, source, ["user_id", "event_id"])


@query(f"""
WITH {ORDERS_SQL}
SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       t.o_orderdate, t.o_orderpriority,
       CAST(CASE WHEN s.o_orderkey IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_latest
FROM t0 t LEFT JOIN s1 s ON t.o_orderkey = s.o_orderkey
""")
def update_matched(spark, d):
    target = target_orders(spark, d).withColumn("is_latest", F.lit(1))
    source = batch_one(spark, d).select("o_orderkey", "o_totalprice")
    return upsert.snapshot(upsert.update_matched(target, source, KEY, {"is_latest": F.lit(0)}))


@query(f"""
WITH {ORDERS_SQL}
SELECT count(*) FILTER (t.o_orderkey IS NULL) AS num_inserted_rows,
       count(*) FILTER (t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL AND ({distinct_sql(REST)})) AS num_updated_rows,
       count(*) FILTER (t.o_orderkey IS NOT NULL AND s.o_orderkey IS NOT NULL AND NOT ({distinct_sql(REST)})) AS num_unchanged_rows,
       count(*) FILTER (s.o_orderkey IS NULL) AS num_kept_rows
FROM t0 t FULL OUTER JOIN s1 s ON t.o_orderkey = s.o_orderkey
""")
def merge_metrics(spark, d):
    merged = upsert.upsert_columns(target_orders(spark, d), batch_one(spark, d), KEY)
    path = shared_dir(spark, "merge-metrics")
    write_parquet(merged, path)
    return upsert.merge_counts(spark.read.parquet(path))


@query(f"WITH {ORDERS_SQL} SELECT *, 'I' AS _action FROM all_orders")
def upsert_bootstrap(spark, d):
    return upsert.upsert_columns(None, all_orders(spark, d), KEY)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CAST(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) + 10
                 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS o_totalprice,
       o_orderdate,
       CASE WHEN o_orderstatus = 'P' THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def table_update(spark, d):
    orders = read(spark, d, "orders").withColumn("o_totalprice", money("o_totalprice"))
    raised = (F.col("o_totalprice") + 10).cast("decimal(18,2)")
    return upsert.table_update(
        orders, F.col("o_orderstatus") == "P", {"o_totalprice": raised, "o_orderpriority": F.lit("1-URGENT")}
    )


@query("""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE NOT coalesce(o_orderpriority = '5-LOW', FALSE)
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def table_delete(spark, d):
    left = upsert.table_delete(read(spark, d, "orders"), F.col("o_orderpriority") == "5-LOW")
    closed = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    kept = upsert.delete_keys(left, closed.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"])
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""
SELECT c_custkey, c_name, c_nationkey,
       CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN CAST(c_acctbal AS DECIMAL(18,2)) + 1
                 ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS c_acctbal,
       c_mktsegment AS bu
FROM customer
""")
def replace_by_bu(spark, d):
    customers = read(spark, d, "customer").withColumn("c_acctbal", money("c_acctbal"))
    customers = customers.withColumnRenamed("c_mktsegment", "bu")
    batch = customers.where(F.col("bu").isin("BUILDING", "MACHINERY"))
    batch = batch.withColumn("c_acctbal", (F.col("c_acctbal") + 1).cast("decimal(18,2)"))
    path = shared_dir(spark, "customer_stg_h")
    load_staged(customers, path, "customer_stg_h", "bu")
    load_staged(batch, path, "customer_stg_h", "bu")
    return spark.read.parquet(path)


@query("""
SELECT c_custkey, CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS INTEGER) AS reloaded,
       c_mktsegment AS bu
FROM customer
""")
def replace_by_bu_frames(spark, d):
    target = read(spark, d, "customer").select("c_custkey", F.lit(0).alias("reloaded"), F.col("c_mktsegment").alias("bu"))
    batch = target.where(F.col("bu").isin("BUILDING", "MACHINERY")).withColumn("reloaded", F.lit(1))
    return upsert.replace_by_keys(target, batch, ["bu"])


_EVENT_SPLIT = "2024-01-22"


def _events(spark, d):
    events = read(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return events.where(F.col("ts") < ntz(_EVENT_SPLIT)), events.where(F.col("ts") >= ntz(_EVENT_SPLIT))


@query(f"""
SELECT user_id, event_id, event_type, ts,
       CAST(CASE WHEN event_id = max(event_id) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS INTEGER) AS "IsLatest"
FROM events
""")
def latest_flag(spark, d):
    first, second = _events(spark, d)
    empty = spark.createDataFrame([], first.withColumn("IsLatest", F.lit(1)).schema)
    target = materialize(latest.latest_flag(empty, first, "user_id", "event_id"), "latest-events")
    return latest.latest_flag(target, second, "user_id", "event_id")


_PARTS = f"""
first_part AS (SELECT user_id, event_id, event_type, ts FROM events WHERE ts < TIMESTAMP '{_EVENT_SPLIT}'),
second_part AS (SELECT user_id, event_id, event_type, ts FROM events WHERE ts >= TIMESTAMP '{_EVENT_SPLIT}'),
flagged AS (
  SELECT *, event_id = max(event_id) OVER (PARTITION BY user_id) AS top FROM first_part),
target AS (
  SELECT user_id, event_id, event_type, ts, CAST(top AS INTEGER) AS "IsLatest",
         CASE WHEN top THEN TIMESTAMP '9999-12-31' ELSE ts END AS trans_proc_end_ts
  FROM flagged),
pool AS (
  SELECT user_id, event_id, event_type, ts FROM target
  WHERE "IsLatest" = 1 AND user_id IN (SELECT user_id FROM second_part)
  UNION ALL SELECT * FROM second_part)
"""


def _flagged_target(first, spark):
    shape = first.withColumns({"IsLatest": F.lit(1), "trans_proc_end_ts": F.col("ts")}).schema
    loaded = latest.latest_flag_end_ts(spark.createDataFrame([], shape), first, "user_id", "event_id", "ts")
    return materialize(loaded, "flagged-events")


@query(f"""
WITH {_PARTS},
final AS (
  SELECT *, event_id = max(event_id) OVER (PARTITION BY user_id) AS top FROM pool)
SELECT user_id, event_id, event_type, ts, CAST(top AS INTEGER) AS "IsLatest",
       CASE WHEN top THEN TIMESTAMP '9999-12-31' ELSE ts END AS trans_proc_end_ts
FROM final
UNION ALL
SELECT * FROM target WHERE (user_id, event_id) NOT IN (SELECT user_id, event_id FROM final)
""")
def latest_flag_end_ts(spark, d):
    first, second = _events(spark, d)
    return latest.latest_flag_end_ts(_flagged_target(first, spark), second, "user_id", "event_id", "ts")


@query(f"""
WITH {_PARTS},
final AS (
  SELECT *, event_id = max(event_id) OVER (PARTITION BY user_id) AS top,
         lead(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM pool)
SELECT user_id, event_id, event_type, ts, CAST(top AS INTEGER) AS "IsLatest",
       CASE WHEN top THEN TIMESTAMP '9999-12-31' ELSE nxt END AS trans_proc_end_ts
FROM final
UNION ALL
SELECT * FROM target WHERE (user_id, event_id) NOT IN (SELECT user_id, event_id FROM final)
""")
def latest_flag_successor_end(spark, d):
    first, second = _events(spark, d)
    return latest.latest_flag_end_ts(
        _flagged_target(first, spark), second, "user_id", "event_id", "ts", end_from="successor"
    )


@query(f"""
SELECT o_orderkey, {sql_checksum(ORDER_COLUMNS)} AS checksum
FROM (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
             CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority FROM orders)
""")
def row_checksum(spark, d):
    orders = read(spark, d, "orders").withColumn("o_totalprice", money("o_totalprice"))
    orders = orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))).select(*ORDER_COLUMNS)
    return orders.select("o_orderkey", checksum_of(orders).alias("checksum"))


@query(f"""
SELECT l_orderkey, l_linenumber, l_shipdate, {sql_hash_key(["l_orderkey", "l_linenumber", "l_shipdate"])} AS hash_join_key
FROM lineitem
""")
def hash_key(spark, d):
    lines = read(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_shipdate"]
    return lines.select(*keys, hash_key_of(lines, keys).alias("hash_join_key"))


@query(f"""
SELECT l_orderkey, l_linenumber, {sql_hash_key(["l_orderkey", "l_linenumber"])} AS hash_join_key FROM lineitem
""")
def hash_key_in_sql(spark, d):
    register_hash_key(spark, "line_hash_key", 2)
    text = "SELECT l_orderkey, l_linenumber, line_hash_key(l_orderkey, l_linenumber) AS hash_join_key FROM {lines}"
    return spark.sql(text, lines=read(spark, d, "lineitem"))
