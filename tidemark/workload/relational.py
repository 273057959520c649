"""Projection, filter, join, aggregate, window, set and function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.compare import differs
from tidemark.operators import aggregates, codes, joins, project, windows
from tidemark.operators.keys import max_key
from tidemark.spec import ColumnMap
from tidemark.workload.changes import ORDERS_SQL, RUN_TS, batch_one, distinct_sql, target_orders
from tidemark.workload.registry import money, ntz, query, read

# -- projections ------------------------------------------------------------

CUSTOMER_MAP = [
    ColumnMap("c_custkey", "contact_id", is_key=True),
    ColumnMap("c_name", "full_name", "upper(c_name)"),
    ColumnMap("c_mktsegment", "segment"),
    ColumnMap("c_nationkey", "place", "concat_ws('-', c_mktsegment, cast(c_nationkey as string))"),
    ColumnMap("c_mktsegment", "place", "concat_ws('-', c_mktsegment, cast(c_nationkey as string))"),
]


@query("""
SELECT c_custkey AS contact_id, upper(c_name) AS full_name, c_mktsegment AS segment,
       concat_ws('-', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS place
FROM customer
""")
def map_project(spark, d):
    return project.map_project(read(spark, d, "customer"), CUSTOMER_MAP)


@query("SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal FROM supplier")
def map_rename(spark, d):
    suppliers = read(spark, d, "supplier").withColumn("s_acctbal", money("s_acctbal"))
    return project.map_rename(suppliers, {"s_suppkey": "id", "s_name": "name", "s_nationkey": "nation"})


@query("SELECT p_partkey, p_name, 'source1' AS \"DataSourceID\", 'EU' AS \"BU\" FROM part")
def add_lineage(spark, d):
    return project.add_lineage(read(spark, d, "part").select("p_partkey", "p_name"), DataSourceID="source1", BU="EU")


@query(f"SELECT p_partkey, p_brand, TIMESTAMP '{RUN_TS}' AS \"LastLoadDate\" FROM part")
def add_load_ts(spark, d):
    return project.add_load_ts(read(spark, d, "part").select("p_partkey", "p_brand"), "LastLoadDate", ntz(RUN_TS))


@query("SELECT o_orderpriority, o_orderkey FROM orders")
def select_cols(spark, d):
    return read(spark, d, "orders").select("o_orderpriority", "o_orderkey")


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_cols(spark, d):
    return project.distinct_values(read(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium' ELSE 'small' END AS size,
       CASE WHEN o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS is_open
FROM orders
""")
def case_when(spark, d):
    price = F.col("o_totalprice")
    return read(spark, d, "orders").select(
        "o_orderkey",
        F.when(price > 300000, "large").when(price > 100000, "medium").otherwise("small").alias("size"),
        F.when(F.col("o_orderstatus") == "F", "N").otherwise("Y").alias("is_open"),
    )


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, DATE '1900-01-01' AS first_day,
       CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_totalprice AS DECIMAL(18,2)) AS price
FROM orders
""")
def cast_lit(spark, d):
    return read(spark, d, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.lit("1900-01-01").cast("date").alias("first_day"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )


@query("""
SELECT s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal,
       CAST(NULL AS VARCHAR) AS c_mktsegment, 'supplier' AS kind
FROM supplier
""")
def schema_align(spark, d):
    suppliers = read(spark, d, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_suppkey").alias("c_custkey"),
    )
    return project.align_to(suppliers, read(spark, d, "customer").schema)


# -- filters ----------------------------------------------------------------


@query("SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:30:00'")
def watermark_filter(spark, d):
    events = read(spark, d, "events").select("event_id", "ts", "event_type")
    return project.watermark_filter(events, "ts", ntz("2024-01-10 06:30:00"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority IS NOT NULL AND o_totalprice <> 0")
def filter_basic(spark, d):
    orders = read(spark, d, "orders")
    kept = (F.col("o_orderstatus") == "O") & F.col("o_orderpriority").isNotNull() & (F.col("o_totalprice") != 0)
    return orders.where(kept).select("o_orderkey", "o_custkey")


@query("""
SELECT p_partkey, p_name FROM part
WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt' OR contains(p_name, 'widget') OR p_type LIKE '%CON%'
""")
def filter_like(spark, d):
    name = F.col("p_name")
    hit = name.startswith("red") | name.endswith("bolt") | name.contains("widget") | F.col("p_type").like("%CON%")
    return read(spark, d, "part").where(hit).select("p_partkey", "p_name")


@query("""
SELECT event_id, user_id FROM events
WHERE event_id IN (SELECT max(event_id) FROM events GROUP BY user_id)
""")
def in_from_query(spark, d):
    events = read(spark, d, "events").select("event_id", "user_id")
    newest = events.groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    return joins.rows_with_keys(events, newest, ["event_id"])


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment LIKE 'A%')
""")
def subquery_in(spark, d):
    chosen = read(spark, d, "customer").where(F.col("c_mktsegment").startswith("A"))
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    return joins.rows_with_keys(orders, chosen.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"])


@query("""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders WHERE o_orderstatus = 'P')
   OR o_totalprice > (SELECT max(l_extendedprice) * 5 FROM lineitem)
""")
def subquery_scalar(spark, d):
    orders = read(spark, d, "orders")
    first = orders.where("o_orderstatus = 'P'").agg(F.min("o_orderdate").alias("m")).scalar()
    top = read(spark, d, "lineitem").agg((F.max("l_extendedprice") * 5).alias("m")).scalar()
    hit = (F.col("o_orderdate") == first) | (F.col("o_totalprice") > top)
    return orders.where(hit).select("o_orderkey", "o_orderdate")


@query("SELECT DISTINCT * FROM (SELECT * REPLACE (CAST(l_orderkey // 2 AS BIGINT) AS l_orderkey) FROM lineitem UNION ALL SELECT * REPLACE (CAST(l_orderkey // 2 AS BIGINT) AS l_orderkey) FROM lineitem)")
def dedupe_full(spark, d):
    """Every row is there twice; all columns decide."""
    lines = read(spark, d, "lineitem").withColumn("l_orderkey", F.floor(F.col("l_orderkey") / 2).cast("bigint"))
    return lines.unionByName(lines).dropDuplicates()


@query("""
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
""")
def dedupe_key(spark, d):
    orders = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return windows.latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


# -- joins ------------------------------------------------------------------


@query("""
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c, nation n, region r
WHERE c.c_nationkey = n.n_nationkey AND n.n_regionkey = r.r_regionkey
""")
def join_inner_codes(spark, d):
    nations = read(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = read(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    out = joins.lookup_join(read(spark, d, "customer"), nations, ["c_nationkey"], "inner")
    return joins.lookup_join(out, regions, ["n_regionkey"], "inner").select("c_custkey", "c_name", "n_name", "r_name")


@query(f"WITH {ORDERS_SQL} SELECT * FROM s1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t0)")
def join_anti_new(spark, d):
    return joins.new_rows(batch_one(spark, d), target_orders(spark, d), ["o_orderkey"])


@query(f"""
WITH {ORDERS_SQL}
SELECT s.* FROM s1 s JOIN t0 t ON s.o_orderkey = t.o_orderkey
WHERE {distinct_sql(["o_totalprice", "o_orderpriority"])}
""")
def join_changed(spark, d):
    return joins.changed_rows(
        batch_one(spark, d), target_orders(spark, d), ["o_orderkey"], ["o_totalprice", "o_orderpriority"]
    )


@query("""
SELECT e.event_id, e.event_id - m.top AS behind FROM events e, (SELECT max(event_id) AS top FROM events) m
""")
def join_scalar_cross(spark, d):
    events = read(spark, d, "events")
    return events.select("event_id", (F.col("event_id") - max_key(events, "event_id", 0)).alias("behind"))


@query("""
SELECT DISTINCT c.c_custkey, c.c_mktsegment FROM customer c, orders o
WHERE c.c_custkey = o.o_custkey AND o.o_orderdate >= TIMESTAMP '2001-06-01'
""")
def join_semi_current(spark, d):
    batch = read(spark, d, "orders").where(F.col("o_orderdate") >= ntz("2001-06-01"))
    customers = read(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return joins.rows_with_keys(customers, batch.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("""
SELECT a.l_orderkey, a.l_linenumber, a.n, b.n AS returned
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) a
JOIN (SELECT l_orderkey AS ok, l_linenumber AS ln, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) b
  ON a.l_orderkey = b.ok AND a.l_linenumber = b.ln
""")
def join_multi_key(spark, d):
    lines = read(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    a = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    b = lines.where("l_returnflag = 'R'").groupBy(*keys).agg(F.count(F.lit(1)).alias("returned"))
    b = b.withColumnsRenamed({"l_orderkey": "ok", "l_linenumber": "ln"})
    pairs = [("l_orderkey", "ok"), ("l_linenumber", "ln")]
    return a.join(b, joins.multi_key_condition(a, b, pairs)).select(*keys, "n", "returned")


@query("""
SELECT o.o_orderkey, upper(o.o_orderpriority) AS priority, c.c_name AS customer, c.c_nationkey AS nationkey,
       n.n_name AS nation, r.r_name AS region
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def join_generated(spark, d):
    steps = [
        joins.JoinStep(read(spark, d, "customer"), (("custkey", "c_custkey"),), {"customer": "c_name", "nationkey": "c_nationkey"}),
        joins.JoinStep(read(spark, d, "nation"), (("nationkey", "n_nationkey"),), {"nation": "n_name", "regionkey": "n_regionkey"}),
        joins.JoinStep(read(spark, d, "region"), (("regionkey", "r_regionkey"),), {"region": "r_name"}, "inner"),
    ]
    columns = {"o_orderkey": "o_orderkey", "priority": "upper(o_orderpriority)", "custkey": "o_custkey"}
    return joins.generated_join(read(spark, d, "orders"), columns, steps).drop("custkey", "regionkey")


# -- aggregates -------------------------------------------------------------


@query("SELECT count(*) AS n FROM lineitem")
def agg_count(spark, d):
    return aggregates.row_count(read(spark, d, "lineitem"))


@query("""
SELECT coalesce(max(o_orderkey), 0) AS top,
       coalesce((SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'X'), 0) AS top_of_none
FROM orders
""")
def agg_max_default(spark, d):
    orders = read(spark, d, "orders")
    none = aggregates.max_or(orders.where("o_orderstatus = 'X'"), "o_orderkey", F.lit(0), "m").scalar()
    return aggregates.max_or(orders, "o_orderkey", F.lit(0), "top").withColumn("top_of_none", none)


@query("SELECT user_id, max(event_id) AS last_event FROM events GROUP BY user_id")
def agg_group_max(spark, d):
    return aggregates.group_max(read(spark, d, "events"), ["user_id"], "event_id", "last_event")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2")
def agg_group_count(spark, d):
    return aggregates.group_count(read(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("SELECT count(DISTINCT props) AS errors FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-05'")
def agg_count_distinct(spark, d):
    errors = read(spark, d, "events").where("event_type = 'error'")
    return aggregates.distinct_count(project.watermark_filter(errors, "ts", ntz("2024-01-05")), "props", "errors")


@query("""
SELECT c_mktsegment, coalesce(max(CASE WHEN c_acctbal > 9990 THEN c_name END), 'FAILED') AS richest
FROM customer GROUP BY c_mktsegment
""")
def agg_group_default(spark, d):
    customers = read(spark, d, "customer").withColumn("rich", F.when(F.col("c_acctbal") > 9990, F.col("c_name")))
    return aggregates.group_max(customers, ["c_mktsegment"], "rich", "richest", F.lit("FAILED"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def agg_argmax(spark, d):
    return aggregates.argmax_rows(read(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


_PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(DISTINCT {c}) AS distinct_count, "
        f"count(*) - count({c}) AS null_count, 'orders' AS table_name "
        "FROM (SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders)"
        for c in _PROFILED
    )
)
def table_profile(spark, d):
    orders = read(spark, d, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return aggregates.profile(orders.select(*_PROFILED), "orders")


# -- order and top rows -----------------------------------------------------


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def top1(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return orders.orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc()).limit(1)


@query("SELECT event_id, event_type FROM events WHERE event_type = 'error' ORDER BY ts DESC LIMIT 1")
def order_limit(spark, d):
    errors = read(spark, d, "events").where("event_type = 'error'")
    return errors.orderBy(F.col("ts").desc()).limit(1).select("event_id", "event_type")


@query("SELECT DISTINCT p_brand FROM part ORDER BY p_brand")
def distinct_sorted(spark, d):
    return read(spark, d, "part").select("p_brand").distinct().orderBy("p_brand")


@query("""
SELECT p_brand, p_partkey, p_size FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS rn FROM part)
WHERE rn = 1
""")
def top1_per_group(spark, d):
    parts = read(spark, d, "part").select("p_brand", "p_partkey", "p_size")
    return windows.top_one(parts, ["p_brand"], [F.col("p_size").desc(), F.col("p_partkey")])


# -- unions -----------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus AS bu FROM orders")
def union_by_table(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("bu"))
    shapes = {"F": ["o_orderkey", "o_custkey", "bu"], "O": ["bu", "o_custkey", "o_orderkey"], "P": ["o_custkey", "bu", "o_orderkey"]}
    return project.union_all_by_name(orders.where(F.col("bu") == bu).select(*cols) for bu, cols in shapes.items())


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS brand FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier
UNION ALL SELECT p_partkey, upper(p_name), NULL, p_brand FROM part
""")
def union_generated(spark, d):
    return project.conform_sources(
        [
            (read(spark, d, "customer"), [ColumnMap("c_custkey", "id"), ColumnMap("c_name", "name"), ColumnMap("c_mktsegment", "segment")]),
            (read(spark, d, "supplier"), [ColumnMap("s_suppkey", "id"), ColumnMap("s_name", "name")]),
            (read(spark, d, "part"), [ColumnMap("p_partkey", "id"), ColumnMap("p_name", "name", "upper(p_name)"), ColumnMap("p_brand", "brand")]),
        ]
    )


@query("""
SELECT o_orderkey, o_orderdate, CAST(NULL AS INTEGER) AS is_latest FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
UNION ALL SELECT o_orderkey, o_orderdate, 1 FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
""")
def union_null_pad(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderdate")
    old = orders.where(F.col("o_orderdate") < ntz("1999-01-01")).withColumn("is_latest", F.lit(1))
    return project.union_all_by_name([old, orders.where(F.col("o_orderdate") >= ntz("1999-01-01"))])


# -- scalar functions -------------------------------------------------------


@query("""
SELECT c_custkey, concat_ws(' ', c_name, c_mktsegment) AS joined,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_name || ':' || c_mktsegment END AS strict,
       lower(c_mktsegment) AS low, trim('  ' || c_name || ' ') AS trimmed,
       split_part(c_name, '#', 2) AS number_text, ends_with(c_name, '7') AS seven,
       replace(c_name, 'Customer', 'C') AS short, substring(c_name, 1, 300) AS cut
FROM customer
""")
def fn_string(spark, d):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return read(spark, d, "customer").select(
        "c_custkey",
        F.concat_ws(" ", name, segment).alias("joined"),
        F.concat(name, F.lit(":"), F.nullif(segment, F.lit("BUILDING"))).alias("strict"),
        F.lower(segment).alias("low"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.split(name, "#")[1].alias("number_text"),
        name.endswith("7").alias("seven"),
        F.replace(name, F.lit("Customer"), F.lit("C")).alias("short"),
        F.substring(name, 1, 300).alias("cut"),
    )


@query("""
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS status, nullif(o_orderstatus, 'P') IS NULL AS missing
FROM orders
""")
def fn_null(spark, d):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return read(spark, d, "orders").select(
        "o_orderkey", F.coalesce(status, F.lit("none")).alias("status"), F.isnull(status).alias("missing")
    )


@query("SELECT doc_id, sha256(text) AS sha, md5(text) AS md FROM documents")
def fn_hash(spark, d):
    return read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.md5("text").alias("md"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_text, CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS day,
       CAST(ts AS DATE) - 1 AS day_before, CAST(ts AS DATE) + 30 AS month_later,
       ts - INTERVAL 10 HOUR AS window_start, ts + INTERVAL 10 MINUTE AS soon,
       greatest(CAST(ts AS DATE) - 1, DATE '2024-01-15') AS later_day
FROM events
""")
def fn_date(spark, d):
    ts = F.col("ts")
    return read(spark, d, "events").select(
        "event_id",
        F.date_format(ts, "yyyy-MM-dd").alias("day_text"),
        F.to_date(F.date_format(ts, "yyyy-MM-dd"), "yyyy-MM-dd").alias("day"),
        F.date_sub(ts, 1).alias("day_before"),
        F.date_add(ts, 30).alias("month_later"),
        (ts - F.expr("INTERVAL 10 HOURS")).alias("window_start"),
        (ts + F.expr("INTERVAL 10 MINUTES")).alias("soon"),
        F.greatest(F.date_sub(ts, 1), F.lit("2024-01-15").cast("date")).alias("later_day"),
    )


@query("""
SELECT page_id, regexp_replace(regexp_replace(url, '^[a-z]+:/+', ''), '[^A-Za-z0-9]+', '_', 'g') AS id_text,
       regexp_matches(url, '/[a-z]{2}/[0-9]+') AS has_id, regexp_extract(url, '/([a-z]{2})/', 1) AS lang,
       substring(url, 1, 5) AS head
FROM pages
""")
def fn_regex(spark, d):
    url = F.col("url")
    bare = F.regexp_replace(url, "^[a-z]+:/+", "")
    return read(spark, d, "pages").select(
        "page_id",
        F.regexp_replace(bare, "[^A-Za-z0-9]+", "_").alias("id_text"),
        F.rlike(url, F.lit("/[a-z]{2}/[0-9]+")).alias("has_id"),
        F.regexp_extract(url, "/([a-z]{2})/", 1).alias("lang"),
        F.substring(url, 1, 5).alias("head"),
    )


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(to_json({'event_id': event_id, 'event_type': event_type}) AS VARCHAR) AS row_json
FROM events
""")
def fn_json(spark, d):
    events = read(spark, d, "events")
    return events.select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("row_json"),
    )


@query("""
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P') <> nullif(o_orderstatus, 'F'), FALSE) AS plain_differs,
       nullif(o_orderstatus, 'P') IS DISTINCT FROM nullif(o_orderstatus, 'F') AS null_safe_differs
FROM orders
""")
def fn_compare(spark, d):
    status = F.col("o_orderstatus")
    a, b = F.nullif(status, F.lit("P")), F.nullif(status, F.lit("F"))
    return read(spark, d, "orders").select(
        "o_orderkey",
        differs(a, b, null_safe=False).alias("plain_differs"),
        differs(a, b).alias("null_safe_differs"),
    )


# -- code tables ------------------------------------------------------------


@query("""
SELECT c.c_custkey, s.segment_code, n.nation_code
FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_nationkey FROM customer) c
JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS segment_code
      FROM (SELECT DISTINCT c_mktsegment AS v FROM customer WHERE c_mktsegment <> 'BUILDING')) s ON c.c_mktsegment = s.v
JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS nation_code
      FROM (SELECT DISTINCT c_nationkey AS v FROM customer)) n ON c.c_nationkey = n.v
""")
def code_table_encode(spark, d):
    customers = read(spark, d, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    coded = codes.encode(customers, {"c_mktsegment": "segment_code", "c_nationkey": "nation_code"})
    return coded.select("c_custkey", "segment_code", "nation_code")
