import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import consolidate as raw
from tidemark.sources import manifest


def put(spark, path, values):
    """One Parquet file with a column ``v``, under its own name."""
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.mode("overwrite").parquet(f"{path}-tmp")
    part = next(f for f in os.listdir(f"{path}-tmp") if f.endswith(".parquet"))
    os.replace(f"{path}-tmp/{part}", path)


def cut(path, size):
    with open(path, "r+b") as f:
        f.truncate(size)


@pytest.fixture
def tree(spark, tmp_path):
    root = f"{tmp_path}/raw"
    for bu in ("A", "north east", "C[1]"):
        for name in ("x", "y"):
            put(spark, f"{root}/{bu}/t/{name}.parquet", [1, 2])
    return root


def outcome(log):
    return {r.PATH.split("/raw/")[1]: r.MESSAGE.split(":")[0] for r in log.collect()}


def test_one_broken_file_does_not_stop_the_others(spark, tree):
    cut(f"{tree}/A/t/x.parquet", 40)
    cut(f"{tree}/C[1]/t/y.parquet", 5)
    first = raw.consolidate(spark, tree, "t")
    assert outcome(first.log) == {
        "A/t/x.parquet": "FAILED", "A/t/y.parquet": "PASSED", "north east/t/x.parquet": "PASSED",
        "north east/t/y.parquet": "PASSED", "C[1]/t/x.parquet": "PASSED", "C[1]/t/y.parquet": "FAILED",
    }
    assert rows(first.rows.groupBy("BU").count()) == [("A", 2), ("C[1]", 2), ("north east", 4)]
    failed = first.log.where("MESSAGE <> 'PASSED'").collect()
    assert all("FAILED_READ_FILE" in r.MESSAGE and "\n" not in r.MESSAGE for r in failed)


def test_a_failed_file_is_tried_again_and_a_late_one_is_taken(spark, tree):
    cut(f"{tree}/A/t/x.parquet", 40)
    log = spark.createDataFrame(raw.consolidate(spark, tree, "t").log.collect(), manifest.LOG)
    again = raw.consolidate(spark, tree, "t", log)
    assert again.rows is None and outcome(again.log) == {"A/t/x.parquet": "FAILED"}
    os.remove(f"{tree}/A/t/x.parquet")
    put(spark, f"{tree}/A/t/x.parquet", [7])
    put(spark, f"{tree}/A/t/late.parquet", [8])
    os.utime(f"{tree}/A/t/late.parquet", (1, 1))
    third = raw.consolidate(spark, tree, "t", log)
    assert rows(third.rows) == [(7, "A"), (8, "A")]
    assert set(outcome(third.log).values()) == {"PASSED"}


def test_same_millisecond_and_changed_length(spark, tree):
    log = spark.createDataFrame(raw.consolidate(spark, tree, "t").log.collect(), manifest.LOG)
    at = os.stat(f"{tree}/A/t/x.parquet").st_mtime
    put(spark, f"{tree}/A/t/z.parquet", [5])
    os.utime(f"{tree}/A/t/z.parquet", (at, at))
    before = os.stat(f"{tree}/A/t/y.parquet")
    put(spark, f"{tree}/A/t/y.parquet", list(range(500)))
    os.utime(f"{tree}/A/t/y.parquet", (before.st_atime, before.st_mtime))
    new = raw.consolidate(spark, tree, "t", log)
    assert set(outcome(new.log)) == {"A/t/z.parquet", "A/t/y.parquet"}
    assert new.rows.count() == 501


def test_empty_folder_and_log(spark, tmp_path):
    none = raw.consolidate(spark, f"{tmp_path}/nothing", "t")
    assert none.rows is None and none.log.count() == 0
    assert raw.load_table(None, None, "t") is None
    listing = manifest.list_files(spark, f"{tmp_path}/nothing")
    assert manifest.unseen(listing, manifest.empty_log(spark)).count() == 0


def test_an_error_that_is_not_about_a_file_is_raised(spark, tree):
    def read(paths):
        return spark.read.parquet(*paths).select(F.raise_error(F.lit("out of order")).alias("v"))

    with pytest.raises(Exception, match="out of order"):
        manifest.load_files(spark, manifest.list_files(spark, tree, "*.parquet"), read)


def test_many_files_few_jobs(spark, tmp_path):
    """One bad file among 24 costs three reads: all, the bad one alone, the others."""
    for i in range(24):
        put(spark, f"{tmp_path}/raw/A/t/f{i}.parquet", [i])
    cut(f"{tmp_path}/raw/A/t/f7.parquet", 30)
    calls = []

    def read(paths):
        calls.append(len(paths))
        return spark.read.schema("v int").parquet(*paths)

    loaded = manifest.load_files(spark, manifest.list_files(spark, f"{tmp_path}/raw", "*.parquet"), read)
    assert sorted(r.v for r in loaded.rows.collect()) == [i for i in range(24) if i != 7]
    assert sorted(calls) == [1, 23, 24]
