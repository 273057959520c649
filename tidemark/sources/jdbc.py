"""JDBC sources: whole tables, stored queries and change functions.

The connection (URL, user, password, driver) always comes from the caller.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def watermark_query(
    query: str, change_column: str | None = None, since: datetime | None = None, alias: str = "src", literal: str = "'{}'"
) -> str:
    """``query`` as a subquery with the watermark inside, so the database filters.

    ``literal`` is how the database writes a moment: quoted text by default,
    ``"TIMESTAMP '{}'"`` where the standard form is wanted.
    """
    text = query.strip().rstrip(";")
    if change_column is None or since is None:
        return f"({text}) {alias}"
    moment = since.isoformat(sep=" ", timespec="milliseconds")
    return f"(SELECT * FROM ({text}) q WHERE q.{change_column} >= {literal.format(moment)}) {alias}"


def prepared(query: str) -> tuple[str, str]:
    """The common table expressions of a WITH query, and the query that uses them.

    Databases that refuse WITH inside a subquery get the first part through
    the reader's ``prepareQuery`` option.  The final SELECT is the first one
    outside of brackets and quotes.
    """
    depth, quoted = 0, False
    for i, c in enumerate(query):
        if c == "'":
            quoted = not quoted
        elif not quoted:
            depth += (c == "(") - (c == ")")
            if depth == 0 and query[i : i + 6].lower() == "select" and not (query[i - 1] + query[i + 6 : i + 7]).strip():
                return query[:i].strip(), query[i:]
    raise ValueError("no SELECT outside of brackets")


def jdbc_options(dbtable: str, connection: dict[str, str], partition: dict[str, object] | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options; ``partition`` (column, lower, upper, num) splits the read over connections."""
    options = {**connection, "dbtable": dbtable, "fetchsize": str(fetch_size)}
    if partition:
        options |= {
            "partitionColumn": str(partition["column"]),
            "lowerBound": str(partition["lower"]),
            "upperBound": str(partition["upper"]),
            "numPartitions": str(partition["num"]),
        }
    return options


def scan_jdbc(
    spark: SparkSession,
    query_or_table: str,
    connection: dict[str, str],
    change_column: str | None = None,
    since: datetime | None = None,
    partition: dict[str, object] | None = None,
) -> DataFrame:
    """Rows of a table or stored query, optionally changed at or after ``since``.

    A table is given by name, a query by its SELECT (or WITH) text; a
    database change function is a query like any other.
    """
    head = query_or_table.lstrip().split(None, 1)[0].lower()
    if head == "with":
        before, query_or_table = prepared(query_or_table)
        connection = {**connection, "prepareQuery": before}
    is_query = head in {"select", "with"}
    if is_query or change_column is not None:
        query = query_or_table if is_query else f"SELECT * FROM {query_or_table}"
        source = watermark_query(query, change_column, since)
    else:
        source = query_or_table
    return spark.read.format("jdbc").options(**jdbc_options(source, connection, partition)).load()
