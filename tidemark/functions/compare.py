"""Change tests between two columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def differs(left: Column, right: Column, null_safe: bool = True) -> Column:
    """True where the values differ.

    ``null_safe=False`` is SQL's plain ``<>``: a null on either side never
    counts as a change.
    """
    if null_safe:
        return ~left.eqNullSafe(right)
    return F.coalesce(left != right, F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_null(columns: list[str]) -> Column:
    return any_of([F.col(c).isNull() for c in columns])
