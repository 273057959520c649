"""Bronze, silver and gold loads of the orders table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import project, upsert
from tidemark.plans import generated, medallion
from tidemark.spec import DIM_FACT_TABLE, ColumnMap, SyncRow
from tidemark.workload.changes import ORDERS_SQL, RUN_TS, all_orders, batch_one, distinct_sql, merge_sql, target_orders
from tidemark.workload.dimensions import _STEP1, ORDER_DIM, first_dimension
from tidemark.workload.registry import ntz, query, read, sql_checksum

_WATERMARK = datetime(1999, 1, 1)

BRONZE_MAP = [
    ColumnMap("o_orderkey", "order_id", is_key=True),
    ColumnMap("o_custkey", "customer_id"),
    ColumnMap("o_orderstatus", "status"),
    ColumnMap("o_totalprice", "price"),
    ColumnMap("o_orderdate", "changed_at"),
]

_BRONZE_COLUMNS = (
    "o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS price, "
    "o_orderdate AS changed_at, o_orderpriority, 'source1' AS \"DataSourceID\""
)


@query(f"""
WITH {ORDERS_SQL}
SELECT {_BRONZE_COLUMNS}, TIMESTAMP '{RUN_TS}' AS "LastmodifiedDate", 'I' AS _action FROM all_orders
""")
def bronze_full(spark, d):
    row = SyncRow("orders", change_column="o_orderdate", source_name="source1")
    return medallion.bronze_load(all_orders(spark, d), None, row, BRONZE_MAP, ntz(RUN_TS)).merged


_BRONZE_REST = ["customer_id", "status", "price", "changed_at", "o_orderpriority", '"DataSourceID"']


@query(
    merge_sql(
        ORDERS_SQL + f", bt AS (SELECT {_BRONZE_COLUMNS} FROM t0), bs AS (SELECT {_BRONZE_COLUMNS} FROM s1)",
        ["order_id"], _BRONZE_REST, distinct_sql(_BRONZE_REST), target="bt", source="bs",
    ).replace(
        " AS _action FROM",
        f" AS _action, CASE WHEN t.order_id IS NULL OR (s.order_id IS NOT NULL AND ({distinct_sql(_BRONZE_REST)})) "
        f"THEN TIMESTAMP '{RUN_TS}' ELSE TIMESTAMP '2024-01-01' END AS \"LastmodifiedDate\" FROM",
    )
)
def bronze_incremental(spark, d):
    first = SyncRow("orders", change_column="o_orderdate", source_name="source1")
    loaded = medallion.bronze_load(target_orders(spark, d), None, first, BRONZE_MAP, ntz("2024-01-01"))
    row = SyncRow(
        "orders", watermark=_WATERMARK, change_column="o_orderdate", source_name="source1", load_type="I"
    )
    return medallion.bronze_load(
        _with_older_orders(spark, d), upsert.snapshot(loaded.merged), row, BRONZE_MAP, ntz(RUN_TS)
    ).merged


def _with_older_orders(spark, d):
    """The whole orders table as the source sees it now: re-priced since the watermark."""
    old = all_orders(spark, d).where(F.col("o_orderdate") < ntz("1999-01-01"))
    return old.unionByName(batch_one(spark, d))


_SILVER_MAP = [
    ColumnMap("o_orderkey", "order_id", is_key=True),
    ColumnMap("o_custkey", "customer_id"),
    ColumnMap("o_orderpriority", "priority", "upper(trim(o_orderpriority))"),
    ColumnMap("o_orderstatus", "state", "concat_ws('/', o_orderstatus, o_orderpriority)"),
    ColumnMap("o_totalprice", "price"),
    ColumnMap("o_orderdate", "LastLoadDate"),
]
_SILVER_HASHED = ["order_id", "customer_id", "priority", "state", "price"]


def _silver_sql(source: str) -> str:
    return (
        f"SELECT *, {sql_checksum(_SILVER_HASHED)} AS checksum FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id, "
        "upper(trim(o_orderpriority)) AS priority, concat_ws('/', o_orderstatus, o_orderpriority) AS state, "
        f"o_totalprice AS price, o_orderdate AS \"LastLoadDate\" FROM {source})"
    )


@query(
    merge_sql(
        ORDERS_SQL + f", bt AS ({_silver_sql('t0')}), bs AS ({_silver_sql('s1')})",
        ["order_id"], ["customer_id", "priority", "state", "price", '"LastLoadDate"', "checksum"],
        distinct_sql(["checksum"]), target="bt", source="bs",
    )
)
def silver_upsert(spark, d):
    order = [F.col("LastLoadDate").desc()]
    first = medallion.silver_upsert(target_orders(spark, d), None, _SILVER_MAP, "o_orderdate", ntz("1900-01-01"), order)
    return medallion.silver_upsert(
        _with_older_orders(spark, d), upsert.snapshot(first), _SILVER_MAP, "o_orderdate", ntz("1999-01-01"), order
    )


@query(f"{_STEP1} SELECT * FROM all1")
def gold_dim(spark, d):
    silver = _with_older_orders(spark, d).withColumn(ORDER_DIM.start, F.lit("2024-02-01").cast("date"))
    dim = first_dimension(spark, d)
    return medallion.gold_dimension(silver, dim, ORDER_DIM, "o_orderdate", ntz("1999-01-01"))


_FACT_MAP = [
    ColumnMap("order_sk", "Dim_Order_sk"),
    ColumnMap("o_orderkey", "order_id", is_key=True),
    ColumnMap("o_custkey", "customer_id", is_key=True),
    ColumnMap("o_totalprice", "price"),
    ColumnMap("o_orderdate", "LastLoadDate"),
]


def _fact_columns(shift: int) -> str:
    return (
        f"o_orderkey + {shift} AS \"Dim_Order_sk\", o_orderkey AS order_id, o_custkey AS customer_id, "
        "o_totalprice AS price, o_orderdate AS \"LastLoadDate\""
    )


@query(
    merge_sql(
        ORDERS_SQL + f", ft AS (SELECT {_fact_columns(1000)} FROM t0), fs AS (SELECT {_fact_columns(5000)} FROM s1)",
        ["order_id", "customer_id"], ['"Dim_Order_sk"', "price", '"LastLoadDate"'],
        distinct_sql(["price", '"LastLoadDate"']), immutable=('"Dim_Order_sk"',), target="ft", source="fs",
    )
)
def gold_fact(spark, d):
    order = [F.col("LastLoadDate").desc()]
    old = target_orders(spark, d).withColumn("order_sk", F.col("o_orderkey") + 1000)
    fact = medallion.gold_fact(old, None, _FACT_MAP, ["Dim_Order_sk"], "o_orderdate", ntz("1900-01-01"), order)
    new = _with_older_orders(spark, d).withColumn("order_sk", F.col("o_orderkey") + 5000)
    return medallion.gold_fact(
        new, upsert.snapshot(fact), _FACT_MAP, ["Dim_Order_sk"], "o_orderdate", ntz("1999-01-01"), order
    )


@query("""
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS contact_id, c_name AS full_name, CAST(NULL AS INTEGER) AS age,
       CAST(NULL AS VARCHAR) AS ethnicity, 'source1' AS "DataSourceID" FROM customer
UNION ALL
SELECT 's' || CAST(s_suppkey AS VARCHAR), concat_ws(' ', split_part(s_name, '#', 1), split_part(s_name, '#', 2)), NULL, NULL, 'source2'
FROM supplier
UNION ALL
SELECT 'p' || CAST(p_partkey AS VARCHAR), concat_ws(' ', split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)), p_size, p_type, 'source3'
FROM part
""")
def conform_sources(spark, d):
    customers = read(spark, d, "customer")
    suppliers = read(spark, d, "supplier").withColumns(
        {"first": F.split("s_name", "#")[0], "last": F.split("s_name", "#")[1]}
    )
    parts = read(spark, d, "part").withColumns({"first": F.split("p_name", " ")[0], "last": F.split("p_name", " ")[1]})
    both = "concat_ws(' ', first, last)"
    return project.conform_sources(
        [
            (
                customers,
                [ColumnMap("c_custkey", "contact_id", "concat('c', c_custkey)"), ColumnMap("c_name", "full_name"),
                 ColumnMap("", "DataSourceID", "'source1'")],
            ),
            (
                suppliers,
                [ColumnMap("s_suppkey", "contact_id", "concat('s', s_suppkey)"), ColumnMap("first", "full_name", both),
                 ColumnMap("", "DataSourceID", "'source2'")],
            ),
            (
                parts,
                [ColumnMap("p_partkey", "contact_id", "concat('p', p_partkey)"), ColumnMap("first", "full_name", both),
                 ColumnMap("p_size", "age"), ColumnMap("p_type", "ethnicity"), ColumnMap("", "DataSourceID", "'source3'")],
            ),
        ]
    )


_PARTY_ROWS = [
    # table, column, target, transformation, key, driving, join table, join column, type
    ("customer", "c_custkey", "party_id", "direct", True, True, None, None, None),
    ("customer", "c_name", "party_name", "direct", False, True, None, None, None),
    ("nation", "n_nationkey", "nation_id", "direct", True, False, "customer", "c_nationkey", "JOIN"),
    ("nation", "n_name", "nation_name", "lower(n_name)", False, False, None, None, "JOIN"),
    ("region", "r_regionkey", "region_id", "direct", True, False, "nation", "n_regionkey", "JOIN"),
    ("region", "r_name", "region_name", "direct", False, False, None, None, "JOIN"),
    ("supplier", "s_suppkey", "party_id", "direct", True, False, None, None, "UNION"),
    ("supplier", "s_name", "party_name", "direct", False, False, None, None, "UNION"),
]


@query("""
SELECT c_custkey AS party_id, c_name AS party_name, n_nationkey AS nation_id, lower(n_name) AS nation_name,
       r_regionkey AS region_id, r_name AS region_name
FROM customer, nation, region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
UNION ALL SELECT s_suppkey, s_name, NULL, NULL, NULL, NULL FROM supplier
""")
def table_from_mapping_rows(spark, d):
    rows = [
        (i, "silver", table, column, "gold", "dim_party", target, text, key, driving, other, other_column, kind)
        for i, (table, column, target, text, key, driving, other, other_column, kind) in enumerate(_PARTY_ROWS, 1)
    ]
    mapping = generated.load_rows(spark.createDataFrame(rows, DIM_FACT_TABLE), "dim_party")
    return generated.assemble({t: read(spark, d, t) for t in mapping}, mapping)
