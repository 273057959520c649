"""Sources, sinks, streams and raw-zone consolidation on files."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import session
from tidemark.plans import consolidate as raw
from tidemark.plans.medallion import bronze_load, gold_fact, silver_upsert
from tidemark.operators.upsert import snapshot
from tidemark.sinks import files as out
from tidemark.sinks import tables
from tidemark.sources import files, jdbc, payload
from tidemark.spec import ColumnMap, SyncRow
from tidemark.streaming.ingest import StreamTables, file_stream, ingest


@pytest.fixture
def path(spark):
    return session.shared_dir(spark, "test")


def test_shared_dir_uses_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or session.shared_dir(spark, "x").rsplit("/", 1)[0]
    assert session.shared_dir(spark, "y").startswith(base.rstrip("/"))


def test_snapshots(spark, path):
    table = tables.SnapshotTable(spark, path)
    assert table.read() is None and table.version() is None
    one = spark.createDataFrame([(1, "a")], "id int, name string")
    assert table.overwrite(one) == 1
    reader = table.read()
    assert table.overwrite(table.read().withColumn("id", F.col("id") + 1).drop("name"), merge_schema=True) == 2
    assert rows(reader) == [(1, "a")]
    assert rows(table.read().select("id", "name")) == [(2, None)]
    assert rows(table.read(1)) == [(1, "a")]


def test_unfinished_folder_is_not_a_version(spark, path):
    table = tables.SnapshotTable(spark, path)
    table.overwrite(spark.range(1))
    spark.range(5).write.parquet(f"{path}/v2-died")
    assert table.version() == 1 and table.read().count() == 1
    assert table.overwrite(spark.range(2)) == 2


def test_staged_tables(spark, path):
    first = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "BU string, v int")
    second = spark.createDataFrame([("B", 8), ("B", 9)], "BU string, v int")
    for table, expected in (("x_stg_h", [("A", 1), ("A", 2), ("B", 8), ("B", 9)]), ("x", [("A", 1), ("A", 2), ("B", 3), ("B", 8), ("B", 9)])):
        place = f"{path}/{table}"
        tables.load_staged(first, place, table)
        tables.load_staged(second, place, table)
        assert rows(spark.read.parquet(place).select("BU", "v")) == expected


def test_sorted_sink_is_in_order(spark, path):
    out.write_sorted(spark.range(1000).withColumn("id", F.reverse(F.col("id").cast("string"))), path, ["id"])
    listed = files.with_file_columns(spark.read.parquet(path)).groupBy("file_path").agg(F.min("id"), F.max("id")).orderBy("file_path").collect()
    bounds = [b for r in listed for b in (r[1], r[2])]
    assert bounds == sorted(bounds)


def test_plain_folder_tree(spark, path):
    for bu in ("north east", "south"):
        spark.createDataFrame([(bu,)], "v string").write.parquet(f"{path}/{bu}/customer")
    assert rows(files.scan_bu_tree(spark, path, "customer").select("v", "BU")) == [("north east", "north east"), ("south", "south")]


def test_consolidation_reads_each_file_once(spark, path):
    spark.createDataFrame([(1,)], "v int").write.parquet(f"{path}/A/t")
    first = raw.consolidate(spark, path, "t")
    assert rows(first.rows.select("BU", "v")) == [("A", 1)]
    log = spark.createDataFrame(first.log.collect(), first.log.schema)
    assert files.last_modified_ms(log.limit(0)) == 0
    spark.createDataFrame([(2,)], "v int").write.parquet(f"{path}/B/t")
    second = raw.consolidate(spark, path, "t", log)
    assert rows(second.rows.select("BU", "v")) == [("B", 2)]
    assert second.log.first()["MESSAGE"] == "PASSED"
    assert len(raw.failure_log(second.log, "x" * 500).first()["MESSAGE"]) == 500
    assert len(raw.failure_log(second.log, "x" * 500, limit=300).first()["MESSAGE"]) == 300
    assert rows(raw.load_table(first.rows, second.rows, "t")) != rows(first.rows)


def test_stream_equals_batch_and_restarts(spark, path):
    schema = "id bigint, v string"

    def put(lo, hi):
        out.write_json(spark.range(lo, hi).withColumn("v", F.col("id").cast("string")), f"{path}/in", mode="append")

    def run():
        return ingest(file_stream(spark, f"{path}/in", schema, max_files=1), f"{path}/table", f"{path}/cp")

    put(0, 10)
    run()
    put(10, 25)
    run()
    run()
    table = spark.read.parquet(f"{path}/table")
    assert rows(table) == rows(spark.read.schema(schema).json(f"{path}/in"))


def test_declared_tables_infer_types(spark, path):
    out.write_json(spark.range(5), f"{path}/in")
    declared = StreamTables()

    @declared.table(quality="bronze")
    def ids(session):
        return file_stream(session, f"{path}/in")

    assert declared.names(quality="bronze") == ["ids"] and declared.names(quality="gold") == []
    assert dict(declared.run(spark, f"{path}/out")["ids"].dtypes) == {"id": "bigint"}
    assert declared.run(spark, f"{path}/out")["ids"].count() == 5


def test_payload_array_and_watermark(spark):
    body = '{"entries": [{"id": 1, "lastLoadDate": "2024-01-01"}, {"id": 2, "lastLoadDate": "2024-03-01"}]}'
    df = spark.createDataFrame([(body,)], "body string")
    schema = "entries array<struct<id: int, lastLoadDate: date>>"
    got = payload.payload_rows(df, "body", schema, entries="entries", since=F.lit("2024-02-01").cast("date"))
    assert rows(got.select("id")) == [(2,)]


class Reader:
    """Records what a JDBC read would be asked; no database is started."""

    def __init__(self):
        self.seen = {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.seen


def test_jdbc_query_is_filtered_by_the_database():
    seen = jdbc.scan_jdbc(
        Reader(), "select * from dbo.contact;", {"url": "jdbc:x"}, "lastLoadDate", datetime(2024, 1, 2, 3, 4, 5),
        {"column": "id", "lower": 0, "upper": 1000, "num": 16},
    )
    assert seen["dbtable"] == (
        "(SELECT * FROM (select * from dbo.contact) q WHERE q.lastLoadDate >= '2024-01-02 03:04:05.000') src"
    )
    assert seen["format"] == "jdbc" and seen["url"] == "jdbc:x"
    assert (seen["partitionColumn"], seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == ("id", "0", "1000", "16")


def test_jdbc_whole_table_and_change_function():
    assert jdbc.scan_jdbc(Reader(), "dbo.contact", {})["dbtable"] == "dbo.contact"
    assert jdbc.scan_jdbc(Reader(), "SELECT * FROM changes(1, 2)", {})["dbtable"] == "(SELECT * FROM changes(1, 2)) src"


def contact(spark, rows_in):
    return spark.createDataFrame(rows_in, "ContactID string, ContactName string, lastLoadDate timestamp_ntz")


MAP = [ColumnMap("ContactID", "id", is_key=True), ColumnMap("ContactName", "name"), ColumnMap("lastLoadDate", "changed")]


def test_three_layers(spark):
    ts = F.lit("2024-06-01").cast("timestamp_ntz")
    full = SyncRow("contact", change_column="lastLoadDate", source_name="s1")
    first = bronze_load(contact(spark, [("1", "a", datetime(2024, 1, 1)), ("2", "b", datetime(2024, 1, 1))]), None, full, MAP, ts)
    bronze = snapshot(first.merged)
    step = SyncRow("contact", datetime(2024, 2, 1), "lastLoadDate", "s1", load_type="I")
    source = contact(
        spark,
        [("1", "a", datetime(2024, 1, 1)), ("2", "old", datetime(2024, 2, 1)), ("2", "new", datetime(2024, 2, 2)), ("3", "c", datetime(2024, 2, 1))],
    ).withColumn("extra", F.lit(1))
    second = bronze_load(source, bronze, step, MAP, ts)
    assert second.drift == [("added", "extra", "int", None)]
    got = rows(second.merged.select("id", "name", "DataSourceID", "extra", "_action"))
    assert got == [("1", "a", "s1", None, "K"), ("2", "new", "s1", 1, "U"), ("3", "c", "s1", 1, "I")]
    silver_map = [ColumnMap("id", "contact_id", is_key=True), ColumnMap("name", "full_name", "upper(name)"), ColumnMap("changed", "LastLoadDate")]
    order = [F.col("LastLoadDate").desc()]
    silver = silver_upsert(snapshot(second.merged), None, silver_map, "changed", F.lit("1900-01-01").cast("timestamp_ntz"), order)
    assert rows(silver.select("contact_id", "full_name")) == [("1", "A"), ("2", "NEW"), ("3", "C")]
    fact_map = [ColumnMap("contact_id", "cid", is_key=True), ColumnMap("full_name", "name"), ColumnMap("LastLoadDate", "LastLoadDate")]
    fact = gold_fact(snapshot(silver), None, fact_map, [], "LastLoadDate", F.lit("2024-02-01").cast("timestamp_ntz"), order)
    assert rows(fact.select("cid")) == [("2",), ("3",)]


def test_a_staged_load_is_one_write(spark, path, monkeypatch):
    """Replaced BUs and rows without one come together or not at all."""

    def frame(*values):
        return spark.createDataFrame(values, "v int, BU string")

    stored = lambda: rows(tables.read_partitioned(spark, path, frame((0, "")), ["BU"]).select("v", "BU"))
    tables.load_staged(frame((1, "A"), (2, "B"), (3, None), (3, None)), path, "t_stg_h")
    before = stored()
    assert before == [(1, "A"), (2, "B"), (3, None), (3, None)]
    with monkeypatch.context() as m:
        m.setattr(tables, "replace_partitions", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            tables.load_staged(frame((9, "A"), (9, None)), path, "t_stg_h")
    assert stored() == before
    tables.load_staged(frame((4, "A"), (5, None)), path, "t_stg_h")
    assert stored() == [(2, "B"), (3, None), (3, None), (4, "A"), (5, None)]
    tables.load_staged(frame((6, "B")), path, "t_stg_h")
    assert stored() == [(3, None), (3, None), (4, "A"), (5, None), (6, "B")]
    tables.load_staged(frame((7, None)), path, "t")
    assert (7, None) in stored() and len(stored()) == 6
