"""Source and sink queries: each writes a whole table to the shared folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import json_paths, project
from tidemark.plans import consolidate as raw_zone
from tidemark.session import materialize, shared_dir
from tidemark.sinks import files as file_sinks
from tidemark.sinks import tables as table_sinks
from tidemark.sources import files, manifest, payload
from tidemark.streaming.evolving import RESCUED, EvolvingTable
from tidemark.streaming.ingest import StreamTables, file_stream, ingest
from tidemark.workload.registry import money, ntz, query, read

NTZ_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
CUSTOMERS_SQL = "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer"
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders"


def _customers(spark, d):
    return read(spark, d, "customer").withColumn("c_acctbal", money("c_acctbal"))


def _orders(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


# -- sources ----------------------------------------------------------------


@query(ORDERS_SQL)
def scan_table(spark, d):
    name = f"orders_{uuid.uuid4().hex}"
    read(spark, d, "orders").createOrReplaceTempView(name)
    return files.scan_table(spark, name).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_parquet(spark, d):
    """An explicit list of folders, the later ones with a further column."""
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    paths = [f"{shared_dir(spark, 'lines')}/{flag}" for flag in ("low", "high")]
    file_sinks.write_parquet(lines.where("l_quantity <= 45"), paths[0])
    file_sinks.write_parquet(lines.where("l_quantity > 45 OR l_quantity IS NULL").withColumn("more", F.lit(1)), paths[1])
    return files.scan_parquet(spark, *paths, merge_schema=True).drop("more")


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def scan_sql_on_file(spark, d):
    text = "SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY o_orderstatus"
    return files.scan_sql_on_files(spark, text, orders=f"{d}/orders.parquet")


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-03-01'")
def scan_query_watermark(spark, d):
    name = f"orders_{uuid.uuid4().hex}"
    read(spark, d, "orders").createOrReplaceTempView(name)
    stored = f"SELECT o_orderkey, o_custkey, o_orderdate FROM {name}"
    return files.scan_stored_query(spark, stored, "o_orderdate", ntz("1998-03-01"))


@query("SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-16'")
def scan_new_files(spark, d):
    events = read(spark, d, "events").select("event_id", "ts", "event_type")
    path = shared_dir(spark, "events-arriving")
    table_sinks.append_rows(events.where(F.col("ts") < ntz("2024-01-16")), path)
    first = files.scan_new_files(spark, path, 0)
    log = files.file_log(first)
    last = files.last_modified_ms(log)
    table_sinks.append_rows(events.where(F.col("ts") >= ntz("2024-01-16")), path)
    return files.scan_new_files(spark, path, last).select("event_id", "ts", "event_type")


def _bu_tree(spark, d, label: str) -> str:
    """``<root>/bu=<segment>/tbl=customer/year=2024/month=<m>``: a folder per market segment, files deeper below."""
    root = shared_dir(spark, label)
    _drop_files(_customers(spark, d), root)
    return root


def _drop_files(customers, root: str) -> None:
    named = customers.withColumnRenamed("c_mktsegment", "bu")
    deep = {"tbl": F.lit("customer"), "year": F.lit(2024), "month": F.col("c_custkey") % 3}
    file_sinks.write_parquet(named.withColumns(deep), root, mode="append", partition_by=["bu", "tbl", "year", "month"])


@query('SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment AS "BU" FROM customer')
def scan_bu_tree(spark, d):
    rows = files.scan_bu_tree(spark, _bu_tree(spark, d, "raw-tree"), "tbl=customer")
    return rows.drop("file_path", "modified_ms")


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' v2' ELSE c_name END AS c_name, c_nationkey,
       CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment AS "BU"
FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_custkey % 2 = 0
""")
def bu_consolidate(spark, d):
    """Two loads: the second brings half of one BU again, whose history is replaced; older files are not read twice.

    The files of the second come late, with a time before all that the log
    has, and an unreadable file lies among those of the first.
    """
    root = _bu_tree(spark, d, "raw-consolidate")
    _broken_file(spark, root, "AUTOMOBILE")
    first = raw_zone.consolidate(spark, root, "tbl=customer")
    table, log = materialize(raw_zone.load_table(None, first.rows, "customer_stg_h"), "staged"), materialize(first.log, "file-log")
    again = _customers(spark, d).where("c_mktsegment = 'BUILDING' AND c_custkey % 2 = 0")
    _drop_files(again.withColumn("c_name", F.concat("c_name", F.lit(" v2"))), root)
    for file in manifest.unseen(manifest.list_files(spark, root, "*.parquet"), log, retry_failed=False).collect():
        place = _place(spark, file.PATH)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(place, 1_000_000, -1)
    second = raw_zone.consolidate(spark, root, "tbl=customer", log)
    return raw_zone.load_table(table, second.rows, "customer_stg_h")


def _place(spark, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _broken_file(spark, root: str, bu: str) -> None:
    """A Parquet file of one BU that ends in its middle."""
    place = _place(spark, f"{root}/bu={bu}/tbl=customer/year=2024/month=0/broken.parquet")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(b"PAR1" + bytes(200)))
    out.close()


@query("""
SELECT c_mktsegment AS "BU", 'PASSED' AS "MESSAGE", TRUE AS timed, TRUE AS named, CAST(count(DISTINCT c_custkey % 3) AS BIGINT) AS files
FROM customer GROUP BY c_mktsegment
UNION ALL
SELECT DISTINCT 'BUILDING', 'FAILED', TRUE, TRUE, CAST(1 AS BIGINT) FROM customer
""")
def file_log(spark, d):
    """Outcome per file: one file of one BU cannot be read, all others load."""
    root = _bu_tree(spark, d, "raw-log")
    _broken_file(spark, root, "BUILDING")
    log = raw_zone.consolidate(spark, root, "tbl=customer").log.withColumn("BU", files.folder_below(F.col("PATH"), root))
    named = F.col("ID").rlike("^[A-Za-z0-9_]+$") & F.col("ID").endswith("parquet") & F.col("PATH").contains("month=")
    timed = (F.col("MODIFICATIONTIME") > 0) & (F.col("LENGTH") > 0)
    ended = F.when(F.col("MESSAGE").rlike("^FAILED: .*broken"), "FAILED").otherwise(F.col("MESSAGE"))
    rows = log.select("BU", ended.alias("MESSAGE"), "PATH", timed.alias("timed"), named.alias("named"))
    return rows.groupBy("BU", "MESSAGE", "timed", "named").agg(F.count_distinct("PATH").alias("files"))


@query("SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-16'")
def scan_unseen_files(spark, d):
    """Files that a log of (path, time, length) lacks; they come late, older than the last file of the log."""
    events = read(spark, d, "events").select("event_id", "ts", "event_type")
    path = shared_dir(spark, "events-late")
    table_sinks.append_rows(events.where(F.col("ts") < ntz("2024-01-16")), path)
    log = manifest.load_files(spark, manifest.list_files(spark, path, "*.parquet"), lambda paths: spark.read.parquet(*paths)).log
    table_sinks.append_rows(events.where(F.col("ts") >= ntz("2024-01-16")), path)
    late = manifest.unseen(manifest.list_files(spark, path, "*.parquet"), log)
    for file in late.collect():
        place = _place(spark, file.PATH)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(place, 1_000_000, -1)
    late = manifest.unseen(manifest.list_files(spark, path, "*.parquet"), log)
    return manifest.load_files(spark, late, lambda paths: spark.read.parquet(*paths)).rows.select("event_id", "ts", "event_type")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, d):
    path = shared_dir(spark, "customer-csv")
    file_sinks.write_csv(read(spark, d, "customer"), path)
    out = files.scan_csv(spark, path)
    return out.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(CUSTOMERS_SQL)
def scan_csv_schema(spark, d):
    path = shared_dir(spark, "customer-csv")
    customers = _customers(spark, d)
    file_sinks.write_csv(customers, path)
    return files.scan_csv(spark, path, customers.schema)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_json(spark, d):
    path = shared_dir(spark, "events-json")
    file_sinks.write_json(read(spark, d, "events"), path, **NTZ_JSON)
    return files.scan_json(spark, path, EVENT_SCHEMA, **NTZ_JSON)


@query("SELECT event_id, event_type FROM events")
def scan_text(spark, d):
    path = shared_dir(spark, "events-text")
    file_sinks.write_json(read(spark, d, "events"), path)
    line = F.col("value")
    return files.scan_text(spark, path).select(
        F.get_json_object(line, "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object(line, "$.event_type").alias("event_type"),
    )


@query("""
SELECT event_id, ts, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE ts >= TIMESTAMP '2024-01-12'
""")
def json_payload_rows(spark, d):
    events = read(spark, d, "events")
    return payload.payload_rows(
        events, "props", "k bigint", keep=["event_id", "ts"], change_column="ts", since=ntz("2024-01-12")
    )


@query("SELECT user_id, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_payload_entries(spark, d):
    # one document per event with its entry enclosed in an array; no change column, so no filter
    events = read(spark, d, "events")
    wrapped = events.select(
        "user_id", "event_id", F.concat(F.lit('{"count":1,"entries":['), "props", F.lit("]}")).alias("body")
    )
    return payload.payload_rows(
        wrapped, "body", "count int, entries array<struct<k: bigint>>", keep=["user_id", "event_id"],
        entries="entries", since=ntz("2024-01-12"),
    )


# -- sinks ------------------------------------------------------------------


@query("""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderstatus FROM orders
""")
def sink_overwrite(spark, d):
    table = table_sinks.SnapshotTable(spark, shared_dir(spark, "orders-snapshots"))
    orders = _orders(spark, d)
    table.overwrite(orders)
    table.overwrite(table.read().drop("o_orderstatus"), merge_schema=True)
    return table.read()


@query("""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderstatus FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
""")
def sink_append(spark, d):
    path = shared_dir(spark, "orders-appended")
    orders = _orders(spark, d)
    table_sinks.append_rows(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"), path)
    table_sinks.append_rows(orders.where("o_orderstatus <> 'F'"), path)
    return table_sinks.read_appended(spark, path)


@query(ORDERS_SQL)
def sink_parquet(spark, d):
    path = shared_dir(spark, "orders-parquet")
    file_sinks.write_parquet(_orders(spark, d), path, files=4, codec="zstd")
    return files.scan_parquet(spark, path)


@query(CUSTOMERS_SQL)
def sink_csv(spark, d):
    path = shared_dir(spark, "customer-out")
    customers = _customers(spark, d)
    file_sinks.write_csv(customers, path, files=2, sep="|")
    return files.scan_csv(spark, path, customers.schema, sep="|")


@query(ORDERS_SQL)
def sink_json(spark, d):
    path = shared_dir(spark, "orders-json")
    orders = _orders(spark, d)
    file_sinks.write_json(orders, path)
    return files.scan_json(spark, path, orders.schema)


@query("""
SELECT event_id, event_type, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
FROM events
""")
def sink_json_dated(spark, d):
    path = shared_dir(spark, "events-dated")
    file_sinks.write_json_by_date(read(spark, d, "events"), path, "ts")
    return files.scan_json(
        spark, path, "event_id bigint, event_type string, year int, month int, day int"
    )


@query(ORDERS_SQL)
def sink_sorted(spark, d):
    path = shared_dir(spark, "orders-sorted")
    file_sinks.write_sorted(_orders(spark, d), path, ["o_custkey", "o_orderkey"])
    return files.scan_parquet(spark, path)


@query("""
SELECT CAST(user_id AS VARCHAR) AS "ID", count(*) AS n, NULL::VARCHAR AS kind FROM events GROUP BY user_id
UNION ALL SELECT event_type, count(*), 'type' FROM events GROUP BY event_type
""")
def append_log(spark, d):
    """Two appends, the second with a column more."""
    path = shared_dir(spark, "log")
    events = read(spark, d, "events")
    table_sinks.append_rows(events.groupBy(F.col("user_id").cast("string").alias("ID")).agg(F.count(F.lit(1)).alias("n")), path)
    by_type = events.groupBy(F.col("event_type").alias("ID")).agg(F.count(F.lit(1)).alias("n"))
    table_sinks.append_rows(by_type.withColumn("kind", F.lit("type")), path)
    return table_sinks.read_appended(spark, path)


@query("SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS note, c_mktsegment FROM customer")
def ddl_roundtrip(spark, d):
    name = f"customer_{uuid.uuid4().hex}"
    columns = "c_custkey BIGINT, c_name STRING, c_mktsegment STRING"
    table_sinks.create_table(spark, name, columns, ["c_mktsegment"], shared_dir(spark, "customer-table"))
    rows = read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    gone = f"gone_{uuid.uuid4().hex}"
    table_sinks.create_table(spark, gone, columns)
    rows.write.insertInto(gone)
    table_sinks.truncate_table(spark, gone)
    spark.table(gone).write.insertInto(name)  # none
    table_sinks.drop_table(spark, gone)
    rows.write.insertInto(name)
    table_sinks.add_columns(spark, name, "note STRING")
    if files.table_exists(spark, gone):
        raise RuntimeError(f"{gone} was not dropped")
    return spark.table(name)


@query("SELECT c_mktsegment, count(*) AS row_count FROM customer GROUP BY c_mktsegment")
def table_partitions(spark, d):
    name = f"customer_{uuid.uuid4().hex}"
    columns = "c_custkey BIGINT, c_mktsegment STRING"
    table_sinks.create_table(spark, name, columns, ["c_mktsegment"], shared_dir(spark, "customer-parts"))
    read(spark, d, "customer").select("c_custkey", "c_mktsegment").write.insertInto(name)
    return table_sinks.describe(spark, name)


@query(ORDERS_SQL)
def ctas(spark, d):
    name = f"orders_{uuid.uuid4().hex}"
    return table_sinks.create_table_as(_orders(spark, d), name, shared_dir(spark, "orders-ctas"))


# -- drift ------------------------------------------------------------------


def _arrived_json(spark, d):
    """Events as untyped JSON files, types inferred on read."""
    path = shared_dir(spark, "events-untyped")
    file_sinks.write_json(read(spark, d, "events"), path, **NTZ_JSON)
    return files.scan_json(spark, path)


def _known_schema(spark, d):
    known = read(spark, d, "events").drop("value", "props")
    return known.withColumns({"user_id": F.col("user_id").cast("string"), "legacy": F.lit("x")}).schema


@query("""
SELECT 'added' AS change, 'value' AS column_name, 'double' AS source_type, NULL::VARCHAR AS target_type, count(value) AS non_null_rows FROM events
UNION ALL SELECT 'added', 'props', 'string', NULL, count(props) FROM events
UNION ALL SELECT 'removed', 'legacy', NULL, 'string', NULL
UNION ALL SELECT 'retyped', 'user_id', 'bigint', 'string', NULL
UNION ALL SELECT 'retyped', 'ts', 'string', 'timestamp_ntz', NULL
""")
def schema_drift(spark, d):
    return project.drift_report(_arrived_json(spark, d), _known_schema(spark, d))


@query("""
SELECT 'c_nationkey' AS column_name, count(c_nationkey) AS rows_with_key FROM customer
UNION ALL SELECT 'c_mktsegment', count(nullif(c_mktsegment, 'BUILDING')) FROM customer
""")
def json_key_drift(spark, d):
    """Whole rows as JSON, two of their keys known, one key not in every row."""
    rows = read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    return project.json_drift(project.rows_as_json(rows), "json", known=["c_custkey", "c_name"])


@query("""
WITH o AS (SELECT *, o_orderdate >= TIMESTAMP '1998-01-01' AS late FROM orders),
found AS (
  SELECT '$.info.priority' AS path, 'string' AS type, NULL AS known FROM o WHERE late
  UNION ALL SELECT unnest(['$.tags', '$.tags[]', '$.tags[].of']), unnest(['array', 'object', 'string']), NULL FROM o WHERE late
  UNION ALL SELECT '$.info.total', CASE WHEN late THEN 'string' ELSE 'double' END, 'double' FROM o)
SELECT CASE WHEN known IS NULL THEN 'added' ELSE 'retyped' END AS change, path, string_agg(DISTINCT type, '|' ORDER BY type) AS source_types,
       known AS target_type, count(*) AS n_values
FROM found GROUP BY path, known
UNION ALL SELECT 'removed', '$.info.gone', NULL, 'bigint', NULL
""")
def json_path_drift(spark, d):
    """Nested JSON whose later rows have a further key, a further list and a key of another type."""
    late = F.col("o_orderdate") >= ntz("1998-01-01")
    total = F.col("o_totalprice").cast("double")
    early_info = F.struct(F.col("o_orderstatus").alias("status"), total.alias("total"))
    late_info = F.struct(F.col("o_orderstatus").alias("status"), total.cast("string").alias("total"), F.col("o_orderpriority").alias("priority"))
    tags = F.array(F.struct(F.col("o_orderpriority").alias("of")))
    key = F.col("o_orderkey").alias("key")
    text = F.when(late, F.to_json(F.struct(key, late_info.alias("info"), tags.alias("tags")))).otherwise(F.to_json(F.struct(key, early_info.alias("info"))))
    known = [("$", "object"), ("$.key", "bigint"), ("$.info", "object"), ("$.info.status", "string"), ("$.info.total", "double"), ("$.info.gone", "bigint")]
    rows = read(spark, d, "orders").select(text.alias("payload"))
    return json_paths.json_path_drift(rows, "payload", spark.createDataFrame(known, "path string, type string"))


@query("""
SELECT CAST(id AS INTEGER) AS "Mapping_Id", 'dbo' AS "Src_Schema_nm", 'events' AS "Src_tbl_nm", src AS "Src_cl_nm",
       'source1' AS "Src_nm", 'bronze' AS "Dst_Schema_nm", 'events' AS "Dst_tbl_nm", dst AS "Dst_cl_nm",
       FALSE AS "Is_join_cl", 'direct' AS "Transformation"
FROM (VALUES (1, 'event_id', 'event_id'), (2, 'event_type', 'event_type'), (3, 'ts', 'ts'), (4, 'user_id', 'user_id'),
             (5, 'props', 'props_c'), (6, 'value', 'value_c')) m(id, src, dst)
WHERE EXISTS (SELECT 1 FROM events)
""")
def drift_mapping(spark, d):
    arrived = _arrived_json(spark, d)
    added = [name for change, name, _, _ in project.drift(arrived.schema, _known_schema(spark, d)) if change == "added"]
    known = read(spark, d, "events").drop("value", "props").columns
    mapping = project.drift_mapping(
        table_sinks.empty(spark, "Mapping_Id int"), known, "source1", "dbo", "events", "bronze", "events"
    )
    more = project.drift_mapping(mapping, added, "source1", "dbo", "events", "bronze", "events", "{}_c")
    return mapping.unionByName(more)


# -- streams ----------------------------------------------------------------


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_file_ingest(spark, d):
    root = shared_dir(spark, "events-stream")
    events = read(spark, d, "events")
    for part in (events.where(F.col("ts") < ntz("2024-01-16")), events.where(F.col("ts") >= ntz("2024-01-16"))):
        file_sinks.write_json(part, f"{root}/landing", mode="append", **NTZ_JSON)
        ingest(file_stream(spark, f"{root}/landing", EVENT_SCHEMA, **NTZ_JSON), f"{root}/table", f"{root}/checkpoint")
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{root}/table")


@query("SELECT event_id, event_type, 'bronze' AS layer FROM events")
def stream_declared_table(spark, d):
    root = shared_dir(spark, "declared")
    file_sinks.write_json(read(spark, d, "events"), f"{root}/landing", **NTZ_JSON)
    declared = StreamTables()

    @declared.table(quality="bronze")
    def events_bronze(session):
        stream = file_stream(session, f"{root}/landing", EVENT_SCHEMA, **NTZ_JSON)
        return stream.select("event_id", "event_type", F.lit("bronze").alias("layer"))

    return declared.run(spark, root)["events_bronze"]


@query("""
SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN props END AS props,
       CASE WHEN ts < TIMESTAMP '2024-01-11' THEN CAST(user_id AS VARCHAR)
            WHEN ts < TIMESTAMP '2024-01-21' THEN CAST(CAST(user_id AS DOUBLE) + 0.5 AS VARCHAR) ELSE event_type END AS v,
       FALSE AS rescued
FROM events
""")
def stream_schema_evolves(spark, d):
    """Three drops of files: the second has a column more, and ``v`` goes from whole numbers to fractions to words."""
    root = shared_dir(spark, "events-evolving")
    events = read(spark, d, "events")
    early, late = F.col("ts") < ntz("2024-01-11"), F.col("ts") >= ntz("2024-01-21")
    drops = (
        events.where(early).select("event_id", "event_type", F.col("user_id").alias("v")),
        events.where(~early & ~late).select("event_id", "event_type", "props", (F.col("user_id").cast("double") + 0.5).alias("v")),
        events.where(late).select("event_id", "event_type", "props", F.col("event_type").alias("v")),
    )
    table = EvolvingTable(spark, f"{root}/landing", f"{root}/table")
    for drop in drops:
        file_sinks.write_json(drop, f"{root}/landing", mode="append")
        table.update()
    return table.read().withColumn("rescued", F.col(RESCUED).isNotNull()).drop(RESCUED)
