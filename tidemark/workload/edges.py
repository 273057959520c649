"""Queries on data with null keys, null partitions, drift and repeated loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_key as hash_key_of
from tidemark.functions.hashing import register_hash_key
from tidemark.operators import codes, upsert
from tidemark.operators.scd2 import ACTION, Scd2Spec
from tidemark.operators.upsert import replace_by_keys
from tidemark.plans import medallion
from tidemark.session import materialize, shared_dir
from tidemark.sinks.files import write_parquet
from tidemark.sinks.tables import load_staged, merge_partitions, read_partitioned
from tidemark.spec import MAPPING_TABLE, SYNC_TABLE, ColumnMap, SyncRow
from tidemark.workload.changes import ORDER_COLUMNS, ORDERS_SQL, RUN_TS, all_orders, batch_one, distinct_sql, merge_sql, target_orders
from tidemark.workload.layers import BRONZE_MAP
from tidemark.workload.registry import ntz, query, read

KEY = ["o_orderkey"]
REST = ORDER_COLUMNS[1:]
_KEY_SQL = "coalesce(t.o_orderkey, s.o_orderkey) % 10"
_PART_SQL = f"SELECT CASE WHEN {_KEY_SQL} = 0 THEN NULL ELSE lpad(CAST({_KEY_SQL} AS VARCHAR), 2, '0') END AS part, coalesce"


@query(merge_sql(ORDERS_SQL, KEY, REST, distinct_sql(REST)).replace("SELECT coalesce", _PART_SQL, 1))
def upsert_partitioned_nulls(spark, d):
    """Partitions named 01 to 09 and the null partition, all of them touched by the batch."""
    path = shared_dir(spark, "orders-by-part")
    last = F.col("o_orderkey") % 10
    part = F.when(last != 0, F.lpad(last.cast("string"), 2, "0"))
    write_parquet(target_orders(spark, d).withColumn("part", part), path, partition_by=["part"])
    batch = batch_one(spark, d).withColumn("part", part)
    actions = merge_partitions(spark, path, batch, KEY, ["part"]).select("o_orderkey", ACTION)
    kept = read_partitioned(spark, path, batch, ["part"]).join(actions, KEY, "left")
    return kept.withColumn(ACTION, F.coalesce(ACTION, F.lit("K")))


_BU_SQL = """
WITH t AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS bu FROM customer)
SELECT * FROM t WHERE bu IS NULL OR bu <> 'AUTOMOBILE'
UNION ALL
SELECT c_custkey, c_name || ' v2', bu FROM t WHERE c_custkey % 2 = 0 AND (bu IS NULL OR bu = 'AUTOMOBILE')
"""


def _bu_rows(spark, d):
    rows = read(spark, d, "customer").select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("bu"))
    batch = rows.where("c_custkey % 2 = 0 AND (bu IS NULL OR bu = 'AUTOMOBILE')")
    return rows, batch.withColumn("c_name", F.concat("c_name", F.lit(" v2")))


@query(_BU_SQL)
def replace_by_bu_nulls(spark, d):
    """Rows without a BU replace nothing; as folders."""
    path = shared_dir(spark, "bu-nulls")
    rows, batch = _bu_rows(spark, d)
    write_parquet(rows, path, partition_by=["bu"])
    load_staged(batch, path, "customer_stg_h", "bu")
    return read_partitioned(spark, path, batch, ["bu"])


@query(_BU_SQL)
def replace_by_bu_nulls_frames(spark, d):
    """The same on frames."""
    rows, batch = _bu_rows(spark, d)
    return replace_by_keys(rows, batch, ["bu"])


_PLACES = Scd2Spec(keys=("nation", "segment"), tracked=("newest",))
_PLACE_SQL = "SELECT nullif(c_nationkey, 3) AS nation, nullif(c_mktsegment, 'BUILDING') AS segment, max(c_custkey) AS newest FROM customer"


def _places(spark, d, day: str):
    customers = read(spark, d, "customer")
    return customers.select(
        F.nullif("c_nationkey", F.lit(3)).alias("nation"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.col("c_custkey").alias("newest"), F.lit(day).cast("date").alias(_PLACES.start), ntz("2024-01-01").alias("changed"),
    )


_PLACE_DIM_SQL = f"""
WITH v1 AS ({_PLACE_SQL} WHERE c_custkey % 2 = 0 GROUP BY ALL), v2 AS ({_PLACE_SQL} GROUP BY ALL),
d1 AS (SELECT 1000 + row_number() OVER (ORDER BY nation NULLS FIRST, segment NULLS FIRST) AS sk, * FROM v1),
both_ AS (
  SELECT d1.sk, v2.*, d1.newest AS old
  FROM v2 LEFT JOIN d1 ON d1.nation IS NOT DISTINCT FROM v2.nation AND d1.segment IS NOT DISTINCT FROM v2.segment),
fresh AS (SELECT * FROM both_ WHERE old IS DISTINCT FROM newest)
SELECT sk, nation, segment, old AS newest, DATE '1900-01-01' AS "Effective_Start_Date",
       CASE WHEN old <> newest THEN DATE '2024-01-31' END AS "Effective_End_Date",
       CASE WHEN old <> newest THEN 'N' ELSE 'Y' END AS "Current_Record"
FROM both_ WHERE old IS NOT NULL
UNION ALL
SELECT (SELECT max(sk) FROM d1) + row_number() OVER (ORDER BY nation NULLS FIRST, segment NULLS FIRST), nation, segment, newest,
       CASE WHEN old IS NULL THEN DATE '1900-01-01' ELSE DATE '2024-02-01' END, NULL, 'Y'
FROM fresh
"""


@query(_PLACE_DIM_SQL)
def gold_dim_null_keys(spark, d):
    """Two loads of a dimension, stored apart, whose key is partly or wholly null: one row per key and version."""
    path = shared_dir(spark, "place-dim")
    since = ntz("1900-01-01")
    medallion.load_dimension(spark, _places(spark, d, "2024-01-01").where("newest % 2 = 0"), path, _PLACES, "changed", since)
    dim = medallion.load_dimension(spark, _places(spark, d, "2024-02-01"), path, _PLACES, "changed", since)
    return dim.select("sk", "nation", "segment", "newest", _PLACES.start, _PLACES.end, _PLACES.current)


@query(_PLACE_DIM_SQL)
def gold_dim_after_crash(spark, d):
    """As above, but between the loads one with other rows dies after it wrote everything and before it was published."""
    store = medallion.DimensionStore(spark, shared_dir(spark, "place-dim-crash"), _PLACES)

    def one_each(places):
        return upsert.dedupe_batch(places.withColumn("key", hash_key_of(places, _PLACES.keys)), ["key"], [F.col("newest").desc()]).drop("key")

    store.load(one_each(_places(spark, d, "2024-01-01").where("newest % 2 = 0")))
    store.stage(one_each(_places(spark, d, "2024-01-15").withColumn("newest", F.col("newest") + 1000)))
    store.load(one_each(_places(spark, d, "2024-02-01")))
    return store.read().select("sk", "nation", "segment", "newest", _PLACES.start, _PLACES.end, _PLACES.current)


@query("""
WITH c AS (
  SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg,
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey ELSE c_nationkey + 7 END AS nat FROM customer)
SELECT c_custkey, s.code AS segment_code, n.code AS nation_code
FROM c JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT seg AS v FROM c WHERE seg IS NOT NULL)) s ON seg = s.v
JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT nat AS v FROM c)) n ON nat = n.v
""")
def code_table_encode_nulls(spark, d):
    """Nations that occur only beside a null segment still count in the nation codes."""
    building = F.col("c_mktsegment") == "BUILDING"
    rows = read(spark, d, "customer").select(
        "c_custkey", F.when(~building, F.col("c_mktsegment")).alias("seg"),
        F.when(building, F.col("c_nationkey")).otherwise(F.col("c_nationkey") + 7).alias("nat"),
    )
    return codes.encode(rows, {"seg": "segment_code", "nat": "nation_code"}).select("c_custkey", "segment_code", "nation_code")


@query("""
SELECT event_id, md5(concat_ws(chr(31), length(CAST(event_id AS VARCHAR)) || ':' || CAST(event_id AS VARCHAR),
       length(CAST(epoch_us(ts) AS VARCHAR)) || ':' || CAST(epoch_us(ts) AS VARCHAR))) AS event_key, TRUE AS same
FROM events
""")
def hash_key_in_sql_ts(spark, d):
    """A key with a timestamp is the same from SQL and from the DataFrame function."""
    register_hash_key(spark, "event_hash_key", ["bigint", "timestamp"])
    events = read(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    keyed = events.withColumn("from_frame", hash_key_of(events, ["event_id", "ts"]))
    out = spark.sql("SELECT event_id, event_hash_key(event_id, ts) AS event_key, from_frame FROM {rows}", rows=keyed)
    return out.select("event_id", "event_key", (F.col("event_key") == F.col("from_frame")).alias("same"))


@query(f"""
WITH {ORDERS_SQL}
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS price,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS changed_at, o_orderpriority, 'source1' AS "DataSourceID",
       TIMESTAMP '{RUN_TS}' AS "LastmodifiedDate", 'I' AS _action
FROM all_orders
""")
def bronze_full_nulls(spark, d):
    """A full load takes rows without a change date."""
    dated = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
    row = SyncRow("orders", change_column="o_orderdate", source_name="source1")
    return medallion.bronze_load(all_orders(spark, d).withColumn("o_orderdate", dated), None, row, BRONZE_MAP, ntz(RUN_TS)).merged


@query("""
SELECT * FROM (VALUES ('added', 'o_orderpriority', 'string', NULL), ('removed', 'legacy', NULL, 'int'),
                      ('retyped', 'price', 'decimal(18,2)', 'string')) v(change, column_name, source_type, target_type)
WHERE EXISTS (SELECT 1 FROM orders)
""")
def bronze_drift(spark, d):
    """What is loaded against the columns of a target that was written earlier."""
    row = SyncRow("orders", change_column="o_orderdate", source_name="source1", load_type="I")
    before = medallion.bronze_load(target_orders(spark, d).drop("o_orderpriority"), None, row, BRONZE_MAP, ntz("2024-01-01"))
    target = upsert.snapshot(before.merged).withColumn("price", F.col("price").cast("string")).withColumn("legacy", F.lit(1))
    drift = medallion.bronze_load(batch_one(spark, d), materialize(target, "bronze-orders"), row, BRONZE_MAP, ntz(RUN_TS)).drift
    return spark.createDataFrame(drift, "change string, column_name string, source_type string, target_type string")


@query(f"""
WITH {ORDERS_SQL}
SELECT 'orders' AS "TableName", strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%g') AS "WatermarkValue",
       (SELECT count(*) FROM t0 FULL JOIN s1 USING (o_orderkey)) AS rows_loaded,
       1::BIGINT AS mapping_rows FROM s1
UNION ALL SELECT 'customer', '1900-01-01 00:00:00.000', (SELECT count(*) FROM t0 FULL JOIN s1 USING (o_orderkey)), 1 FROM s1 LIMIT 2
""".replace("FROM s1 LIMIT 2", "WHERE EXISTS (SELECT 1 FROM s1)"))
def bronze_watermark(spark, d):
    """The control rows after two whole loads: only the loaded table's mark moves, to the highest change written."""
    path = shared_dir(spark, "bronze-run")
    start = "1900-01-01 00:00:00.000"
    marks = [(t, start, "Y", "o_orderdate", "dbo", "source1", None, "bronze", t, "N", "I", "DB") for t in ("orders", "customer")]
    control = spark.createDataFrame(marks, SYNC_TABLE)
    mapped = spark.createDataFrame([], MAPPING_TABLE)
    mapping = [*BRONZE_MAP[:4], ColumnMap("o_orderdate", "changed_at")]
    first = SyncRow("orders", change_column="o_orderdate", source_name="source1")
    control, _, _ = medallion.run_bronze(spark, target_orders(spark, d), path, first, mapping, control, mapped, ntz("2024-01-01"), ("dbo", "bronze"))
    control = materialize(control, "control")
    later = SyncRow("orders", watermark=datetime(1999, 1, 1), change_column="o_orderdate", source_name="source1", load_type="I")
    control, new, _ = medallion.run_bronze(spark, batch_one(spark, d), path, later, mapping, control, mapped, ntz(RUN_TS), ("dbo", "bronze"))
    loaded = medallion.SnapshotTable(spark, path).read().agg(F.count(F.lit(1)).alias("rows_loaded"))
    counts = loaded.crossJoin(new.agg(F.count(F.lit(1)).alias("mapping_rows")))
    return control.select("TableName", "WatermarkValue").crossJoin(F.broadcast(counts))
