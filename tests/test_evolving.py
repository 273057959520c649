import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lattice import conform, widest
from tidemark.streaming.evolving import RESCUED, EvolvingTable, json_schema


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def drop(name, *lines):
        (folder / name).write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))

    drop.path = str(folder)
    return drop


def rows(df):
    return {r.id: tuple(r[c] for c in df.columns if c != "id") for r in df.collect()}


def test_no_value_is_lost_when_a_type_changes(spark, landing, tmp_path):
    table = EvolvingTable(spark, landing.path, f"{tmp_path}/table")
    assert table.read() is None
    landing("a.json", {"id": 1, "v": 10}, {"id": 2, "v": None})
    table.update()
    assert table.read().schema["v"].dataType == T.LongType()
    landing("b.json", {"id": 3, "v": 2.5}, {"id": 4, "v": 7.0, "w": "new"})
    table.update()
    assert table.read().schema["v"].dataType == T.DoubleType()
    landing("c.json", {"id": 5, "v": "abc", "w": 3}, {"id": 6, "v": True})
    table.update()
    out = table.read()
    assert out.columns == ["id", "v", "w", RESCUED]
    assert rows(out) == {
        1: ("10", None, None), 2: (None, None, None), 3: ("2.5", None, None), 4: ("7.0", "new", None),
        5: ("abc", "3", None), 6: ("true", None, None),
    }
    assert sorted(d for d in os.listdir(f"{tmp_path}/table") if d.startswith("v")) == ["v0", "v1", "v2"]


def test_nothing_new_changes_nothing(spark, landing, tmp_path):
    table = EvolvingTable(spark, landing.path, f"{tmp_path}/table")
    landing("a.json", {"id": 1, "v": 1})
    for _ in range(3):
        table.update()
    assert rows(table.read()) == {1: (1, None)}
    assert len([f for f in os.listdir(f"{tmp_path}/table/_schemas") if f.endswith(".json")]) == 1


def test_lines_that_fit_no_column_are_rescued(spark, landing, tmp_path):
    table = EvolvingTable(spark, landing.path, f"{tmp_path}/table", max_files=1)
    landing("a.json", {"id": 1, "v": 1})
    table.update()
    landing("b.json", "{broken", "", "[1, 2]", '{"id": 2, "V": 5}', '{"id": 3, "v": 1, "v": 2}')
    table.update()
    out = table.read()
    assert {r[RESCUED] for r in out.collect()} == {"{broken", "[1, 2]", '{"id": 2, "V": 5}', '{"id": 3, "v": 1, "v": 2}', None}
    assert out.where(F.col(RESCUED).isNull()).select("id", "v").collect() == [(1, 1)]


def test_only_rubbish(spark, landing, tmp_path):
    table = EvolvingTable(spark, landing.path, f"{tmp_path}/table")
    landing("a.json", "not json", "")
    table.update()
    assert [tuple(r) for r in table.read().collect()] == [("not json",)]
    landing("b.json", {"id": 1})
    table.update()
    assert {tuple(r) for r in table.read().select("id", RESCUED).collect()} == {(None, "not json"), (1, None)}


def test_whole_numbers_that_doubles_would_round_are_rescued(spark, landing, tmp_path):
    table = EvolvingTable(spark, landing.path, f"{tmp_path}/table")
    landing("a.json", {"id": 1, "v": 2**53 + 1}, {"id": 2, "v": 2**53})
    table.update()
    landing("b.json", {"id": 3, "v": 0.5})
    table.update()
    found = rows(table.read())
    assert json.loads(found[1][1]) == {"id": 1, "v": 2**53 + 1}
    assert found[2] == (float(2**53), None) and found[3] == (0.5, None)


def test_nested_values_merge(spark, landing, tmp_path):
    table = EvolvingTable(spark, landing.path, f"{tmp_path}/table")
    landing("a.json", {"id": 1, "n": {"a": 1, "l": []}, "e": {}, "s": {"x": 1}})
    table.update()
    landing("b.json", {"id": 2, "n": {"a": 1.5, "b": "t", "l": [1]}, "e": {"k": 2}, "s": "plain"})
    table.update()
    found = {r.id: r.asDict(recursive=True) for r in table.read().collect()}
    assert found[1]["n"] == {"a": 1.0, "l": [], "b": None} and found[2]["n"] == {"a": 1.5, "l": [1], "b": "t"}
    assert found[1]["s"] == '{"x":1}' and found[2]["s"] == "plain"
    assert found[1]["e"] == {"k": None} and found[2]["e"] == {"k": 2}


def test_a_batch_that_died_is_replaced(spark, landing, tmp_path):
    """The batch wrote its rows, the run ended before the checkpoint had it: its files are loaded once."""
    table = EvolvingTable(spark, landing.path, f"{tmp_path}/table")
    landing("a.json", {"id": 1, "v": 1})
    table.update()
    landing("b.json", {"id": 2, "v": 0.5})
    table.update()
    commits = f"{tmp_path}/table/_checkpoint/commits"
    for name in os.listdir(commits):
        if name.strip(".").startswith("1"):
            os.remove(f"{commits}/{name}")
    landing("c.json", {"id": 3, "v": "x"})
    table.update()
    assert rows(table.read()) == {1: ("1", None), 2: ("0.5", None), 3: ("x", None)}


@pytest.mark.parametrize("numbers, kind", [
    (["1", "2"], "bigint"), (["7.0"], "double"), (["1", "7.0"], "double"), (["1e3"], "double"), (["1", "0.5"], "double"),
    (["1", "12345678901234567890"], "string"), (["1", "null"], "bigint"), (["null"], "void"),
])
def test_schema_of_numbers(spark, numbers, kind):
    lines = spark.createDataFrame([(f'{{"a": {n}}}',) for n in numbers], "value string")
    assert json_schema(lines)["a"].dataType.simpleString() == kind


def test_schema_of_text(spark):
    lines = spark.createDataFrame([('{"a": 1, "b": {"c": [1]}}',), ('{"a": 123456789012345678901234, "b": {"c": [2.5]}}',), ("[",), (None,)], "value string")
    assert json_schema(lines).simpleString() == "struct<a:string,b:struct<c:array<double>>>"
    assert json_schema(lines.limit(0)) == T.StructType([])


@pytest.mark.parametrize("a, b, both", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("bigint", "double", "double"), ("float", "int", "double"),
    ("double", "string", "string"), ("boolean", "int", "string"), ("date", "timestamp", "timestamp"), ("date", "int", "string"),
    ("void", "int", "int"), ("decimal(5,2)", "decimal(10,0)", "decimal(12,2)"), ("decimal(38,0)", "decimal(38,10)", "string"),
    ("array<int>", "array<string>", "array<string>"), ("array<int>", "int", "string"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int>", "struct<A:double,b:int>", "struct<a:double,b:int>"),
])
def test_widest(a, b, both):
    kind = lambda ddl: T.StructType.fromDDL(f"x {ddl}")["x"].dataType
    assert widest(kind(a), kind(b)).simpleString() == both
    assert widest(kind(b), kind(a)).simpleString().lower() == both


def test_conform_keeps_nulls(spark):
    df = spark.createDataFrame([(1, (2,), [1, None]), (None, None, None)], "a int, s struct<x:int>, l array<int>")
    new = T.StructType.fromDDL("a string, s struct<x:double,y:string>, l array<double>")
    out = df.select(*[conform(F.col(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name) for f in new])
    assert [tuple(r) for r in out.collect()] == [("1", (2.0, None), [1.0, None]), (None, None, None)]
