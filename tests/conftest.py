import pytest

from tidemark.functions import ranges
from tidemark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tidemark-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def small_buckets(monkeypatch):
    """Make a few rows count as too many for one task."""
    monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", 10)


@pytest.fixture
def tables():
    return "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
