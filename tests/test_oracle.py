"""Every query with SQL gives the same rows and column names as DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{folder}/{name}'")
    return con


def as_text(value):
    return repr(round(value, 9)) if isinstance(value, float) else repr(value)


def canonical(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(as_text(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, tables, con, name):
    df = QUERIES[name](spark, tables)
    result = con.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, df.collect()) == canonical(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, tables, name):
    assert QUERIES[name](spark, tables).count() > 0


def test_entry(spark):
    counts = {r["_action"]: r["count"] for r in entry.entry(spark).groupBy("_action").count().collect()}
    assert set(counts) == {"I", "U", "N", "K"}


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
