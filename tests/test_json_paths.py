from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.json_paths import json_path_drift, json_paths

TEXTS = ['{"a": 1, "b": {"c": [1, 2.5, null], "d": {}}}', '{"a": "x", "b": {"c": [], "e": [[true]]}}', '{"a": null}', "[{}, 3]", "{broken", None, "7", "123456789012345678901234", "7.0"]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_every_path_and_type(spark):
    assert rows(json_paths(texts(spark, TEXTS), "t")) == sorted([
        ("$", "object", 3), ("$", "array", 1), ("$", "malformed", 1), ("$", "bigint", 1), ("$", "decimal", 1), ("$", "double", 1),
        ("$.a", "bigint", 1), ("$.a", "string", 1), ("$.a", "null", 1), ("$.b", "object", 2), ("$.b.c", "array", 2),
        ("$.b.c[]", "bigint", 1), ("$.b.c[]", "double", 1), ("$.b.c[]", "null", 1), ("$.b.d", "object", 1),
        ("$.b.e", "array", 1), ("$.b.e[]", "array", 1), ("$.b.e[][]", "boolean", 1), ("$[]", "object", 1), ("$[]", "bigint", 1),
    ], key=repr)


def test_drift(spark):
    known = spark.createDataFrame([("$", "object"), ("$.a", "bigint"), ("$.b", "object"), ("$.z", "string")], "path string, type string")
    found = json_path_drift(texts(spark, ['{"a": 1, "b": {"n": null}}', '{"a": 2.5, "c": true}']), "t", known)
    assert rows(found) == [("added", "$.c", "boolean", None, 1), ("removed", "$.z", None, "string", None), ("retyped", "$.a", "bigint|double", "bigint", 2)]


def test_no_rows(spark):
    known = spark.createDataFrame([("$", "object")], "path string, type string")
    assert rows(json_path_drift(texts(spark, []), "t", known)) == [("removed", "$", None, "object", None)]
    assert rows(json_paths(texts(spark, [None]), "t")) == []


def test_levels_are_counted_in_one_pass(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        read.add(1)
        return '{"a": [{"b": {"c": %d}}, {"b": {}}], "z": [[], 1]}' % i

    made = spark.range(7, numPartitions=2).select(text.asNondeterministic()("id").alias("t"))
    assert rows(json_paths(made, "t")) == sorted([
        ("$", "object", 7), ("$.a", "array", 7), ("$.a[]", "object", 14), ("$.a[].b", "object", 14), ("$.a[].b.c", "bigint", 7),
        ("$.z", "array", 7), ("$.z[]", "array", 7), ("$.z[]", "bigint", 7),
    ], key=repr)
    assert read.value == 7


def test_deep_texts_take_further_passes(spark):
    depth = 14
    deep = '{"a": ' * depth + '[{"b": 1}, null, [2, 3]]' + "}" * depth
    path = "$" + ".a" * depth
    expected = [("$" + ".a" * i, "object", 2) for i in range(depth)] + [
        (path, "array", 2), (f"{path}[]", "object", 2), (f"{path}[]", "null", 2), (f"{path}[]", "array", 2), (f"{path}[].b", "bigint", 2), (f"{path}[][]", "bigint", 4),
    ]
    assert rows(json_paths(texts(spark, [deep, "3", deep]), "t")) == sorted([*expected, ("$", "bigint", 1)], key=repr)


def test_keys_that_look_like_steps(spark):
    found = rows(json_paths(texts(spark, ['{"[]": {"x": 1}, "": {"": true}}']), "t"))
    assert found == sorted([("$", "object", 1), ("$.[]", "object", 1), ("$.[].x", "bigint", 1), ("$.", "object", 1), ("$..", "boolean", 1)], key=repr)
