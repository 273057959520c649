from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import spec
from tidemark.operators import project
from tidemark.plans import generated, watermark
from tidemark.sinks.tables import empty
from tidemark.spec import ColumnMap, SyncRow


def test_flags():
    assert all(spec.as_flag(v) for v in ("Y", "true", "1", True, " yes "))
    assert not any(spec.as_flag(v) for v in ("N", "false", None, "", False, "0"))


def test_load_type_switch():
    row = SyncRow("t", change_column="c", load_type="F")
    assert not row.incremental and row.after_success().incremental
    assert not SyncRow("t", change_column=None, load_type="I").incremental
    always = SyncRow("t", change_column="c", load_type="I", always_full=True)
    assert not always.incremental and always.after_success() == always


def test_mapping_rows(spark):
    table = empty(spark, spec.MAPPING_TABLE)
    rows_in = [
        (2, "s", "t", "first", "src", "d", "t2", "full", False, "concat(first, last)"),
        (1, "s", "t", "id", "src", "d", "t2", "key", True, "direct"),
        (3, "s", "other", "id", "src", "d", "t2", "key", True, "direct"),
    ]
    table = table.union(spark.createDataFrame(rows_in, spec.MAPPING_TABLE))
    mapping = spec.load_mapping(table, "src", "t")
    assert mapping == [ColumnMap("id", "key", "direct", True), ColumnMap("first", "full", "concat(first, last)")]
    assert spec.keys_of(mapping) == ["key"]


def test_mapping_validation(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    spec.validate_mapping(df, [ColumnMap("id", "key", is_key=True)], need_key=True)
    with pytest.raises(ValueError, match="does not resolve"):
        spec.validate_mapping(df, [ColumnMap("x", "y", "phone_no")])
    with pytest.raises(ValueError, match="different expressions"):
        spec.validate_mapping(df, [ColumnMap("id", "k"), ColumnMap("name", "k")])
    with pytest.raises(ValueError, match="key"):
        spec.validate_mapping(df, [ColumnMap("id", "k")], need_key=True)


def test_control_layouts(spark):
    for layout in (spec.SYNC_TABLE, spec.DIM_FACT_TABLE, spec.BATCH_HISTORY_TABLE, spec.PROCESS_HISTORY_TABLE,
                   spec.JOB_HISTORY_TABLE, spec.FILE_LOG_TABLE):
        assert empty(spark, layout).count() == 0


def test_drift(spark):
    src = spark.createDataFrame([], "ID int, extra string, n bigint").schema
    dst = spark.createDataFrame([], "id int, gone string, n int").schema
    assert sorted(project.drift(src, dst), key=repr) == sorted(
        [("added", "extra", "string", None), ("removed", "gone", None, "string"), ("retyped", "n", "bigint", "int")], key=repr
    )


def test_align_and_union_go_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2, 5.0)], "name string, id int, extra double")
    assert project.align_to(b, a.schema).columns == ["id", "name", "extra"]
    assert rows(project.union_all_by_name([a, b])) == [(1, "x", None), (2, "y", 5.0)]


def test_watermark_column_may_be_absent(spark):
    df = spark.createDataFrame([(1,)], "id int")
    since = F.lit("2024-01-01").cast("timestamp_ntz")
    assert project.watermark_filter(df, "changed", since, only_if_present=True).count() == 1


def test_watermark_advance_and_reset(spark):
    control = spark.createDataFrame([("t", "1900-01-01 00:00:00.000"), ("u", "x")], "TableName string, WatermarkValue string")
    data = spark.createDataFrame([(datetime(2024, 5, 1, 10),), (datetime(2024, 4, 1),)], "c timestamp_ntz")
    advanced = watermark.advance(control, data, "t", "c")
    assert rows(advanced) == [("t", "2024-05-01 10:00:00.000"), ("u", "x")]
    assert rows(watermark.advance(advanced, data.limit(0), "t", "c")) == rows(advanced)
    assert rows(watermark.reset(advanced, "t"))[0] == ("t", "1900-01-01 00:00:00.000")


def test_drift_mapping_numbers_and_names(spark):
    old = spark.createDataFrame([(7,)], "Mapping_Id int")
    new = project.drift_mapping(old, ["zeta", "age"], "s", "dbo", "t", "bl", "t", "x_{}_c")
    got = [(r.Mapping_Id, r.Src_cl_nm, r.Dst_cl_nm, r.Is_join_cl) for r in new.orderBy("Mapping_Id").collect()]
    assert got == [(8, "age", "x_age_c", False), (9, "zeta", "x_zeta_c", False)]


def test_control_rows(spark):
    line = ("Contact", "1900-01-01T00:00:00.000Z", "Y", "changed", "s1", "source1", "select * from s1.contact", "bl", "c", "N", "I", "NonCDC")
    off = ("Off", None, "N") + line[3:]
    table = spark.createDataFrame([line, off], spec.SYNC_TABLE)
    (row,) = spec.load_sync_rows(table)
    assert row.incremental and row.watermark == spec.START_OF_TIME and row.query == "select * from s1.contact"


def test_generated_join_rejects_a_table_without_key(spark):
    rows_in = [
        (1, "s", "a", "id", "g", "t", "id", "direct", True, True, None, None, None),
        (2, "s", "b", "v", "g", "t", "v", "direct", False, False, None, None, "JOIN"),
    ]
    mapping = generated.load_rows(spark.createDataFrame(rows_in, spec.DIM_FACT_TABLE), "t")
    frame = spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(ValueError, match="no join key"):
        generated.assemble({"a": frame, "b": frame}, mapping)
