"""Run-history queries; the events table stands in for batch history.

One user is one batch or pipeline, the event id is the attempt, and an error
event is a failed attempt, a signup a running one, all others succeeded.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import project, upsert
from tidemark.plans import history, watermark
from tidemark.workload.changes import ORDERS_SQL, RUN_TS, batch_one, distinct_sql, merge_sql, target_orders
from tidemark.workload.registry import ntz, query, read

_STATUS = "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'SUCCESS' END"
_RUNS = f"runs AS (SELECT user_id, event_id, ts, props, {_STATUS} AS status FROM events)"


def _runs(spark, d):
    kind = F.col("event_type")
    status = F.when(kind == "error", "FAILED").when(kind == "signup", "RUNNING").otherwise("SUCCESS")
    return read(spark, d, "events").select("user_id", "event_id", "ts", "props", status.alias("status"))


@query(f"""
WITH {_RUNS}
SELECT user_id, event_id, status FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM runs) WHERE r = 1
""")
def latest_attempt(spark, d):
    return history.latest_attempt(_runs(spark, d), "user_id", "event_id").select("user_id", "event_id", "status")


@query(f"""
WITH {_RUNS},
newest AS (SELECT status, arg_max(user_id, (ts, user_id)) AS user_id FROM runs GROUP BY status)
SELECT status, user_id, event_id FROM (
  SELECT *, rank() OVER (PARTITION BY status ORDER BY event_id DESC) AS r
  FROM runs WHERE (status, user_id) IN (SELECT status, user_id FROM newest)) WHERE r = 1
""")
def latest_batch_attempt(spark, d):
    # one pipeline per status, one batch per user
    latest = history.latest_attempt(_runs(spark, d), "status", "event_id", batch="user_id", begun="ts")
    return latest.select("status", "user_id", "event_id")


@query(f"""
WITH {_RUNS}
SELECT coalesce(bool_and(status = 'SUCCESS'), FALSE) AS all_success FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM runs) WHERE r = 1
""")
def all_success_gate(spark, d):
    return history.all_success(history.latest_attempt(_runs(spark, d), "user_id", "event_id"), "status")


@query(f"""
SELECT user_id, max(ts) - INTERVAL 10 HOUR AS window_begin, TIMESTAMP '{RUN_TS}' AS window_end FROM events GROUP BY user_id
""")
def next_window(spark, d):
    return history.next_window(read(spark, d, "events"), "user_id", "ts", ntz(RUN_TS))


@query("SELECT user_id, max(event_id) + 1 AS next_attempt FROM events GROUP BY user_id")
def next_attempt(spark, d):
    return history.next_attempt(read(spark, d, "events"), "user_id", "event_id")


@query(f"""
WITH {_RUNS},
last_run AS (
  SELECT user_id, status AS last_status FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM runs) WHERE rn = 1)
SELECT c.c_custkey AS user_id, f.last_status
FROM customer c LEFT JOIN last_run f ON c.c_custkey = f.user_id
WHERE f.last_status IS NULL OR f.last_status IN ('FAILED', 'RUNNING')
""")
def pending_tables(spark, d):
    tables = read(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return history.pending_tables(tables, _runs(spark, d), ["user_id"], "status", [F.col("ts").desc(), F.col("event_id").desc()])


@query(f"""
WITH {_RUNS}
SELECT user_id, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' ELSE 'SUCCESS' END AS job_status,
       arg_max(props, event_id) FILTER (status = 'FAILED') AS error_message, count(*) AS batches
FROM runs GROUP BY user_id
""")
def job_rollup(spark, d):
    return history.job_rollup(_runs(spark, d), "user_id", "status", "event_id", "props")


_MERGED = merge_sql(ORDERS_SQL, ["o_orderkey"], ["o_totalprice"], distinct_sql(["o_totalprice", "o_orderpriority"]))


@query(f"""
SELECT 'orders' AS "TableName", count(*) FILTER (_action <> 'I') AS "InitialTargetRecCount",
       count(*) AS "FinalTargetRecCount", count(*) FILTER (_action = 'I') AS "TargetInsertRecCount",
       count(*) FILTER (_action = 'U') AS "TargetUpdateRecCount", CAST(95 AS BIGINT) AS "TimeTakenInSecs"
FROM ({_MERGED})
""")
def process_audit(spark, d):
    merged = upsert.upsert_columns(target_orders(spark, d), batch_one(spark, d), ["o_orderkey"])
    return history.process_audit(merged, "orders", ntz("2024-06-01 12:00:00"), ntz("2024-06-01 12:01:35"))


@query(f"""
WITH {_RUNS},
per_batch AS (
  SELECT status, user_id, arg_min(ts, event_id) AS window_begin, max(ts) AS last_begin FROM runs GROUP BY 1, 2)
SELECT status, user_id, window_begin FROM (
  SELECT *, row_number() OVER (PARTITION BY status ORDER BY last_begin DESC, user_id DESC) AS rn FROM per_batch)
WHERE rn = 1
""")
def upstream_window(spark, d):
    return history.upstream_window(_runs(spark, d), "status", "user_id", "ts", "event_id")


@query("""
SELECT CAST(to_json({'c_mktsegment': c_mktsegment, 'c_nationkey': c_nationkey}) AS VARCHAR) AS json
FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer)
""")
def metadata_json(spark, d):
    return project.rows_as_json(project.distinct_values(read(spark, d, "customer"), ["c_mktsegment", "c_nationkey"]))


@query("""
SELECT 'events' AS "TableName", strftime(max(ts), '%Y-%m-%d %H:%M:%S.%g') AS "WatermarkValue" FROM events
UNION ALL SELECT 'orders', '1900-01-01 00:00:00.000'
""")
def watermark_advance(spark, d):
    control = spark.createDataFrame(
        [("events", "1900-01-01 00:00:00.000"), ("orders", "1900-01-01 00:00:00.000")],
        "TableName string, WatermarkValue string",
    )
    return watermark.advance(control, read(spark, d, "events"), "events", "ts")
