"""Incremental file streams into tables, and a registry of declared ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

StreamFunction = Callable[[SparkSession], DataFrame]


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "json",
    max_files: int | None = None,
    **options,
) -> DataFrame:
    """A stream of the files that appear under ``path``.

    Without a schema it is inferred from the files that are there; a folder
    whose columns or types change is for :class:`evolving.EvolvingTable`.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if schema is None:
        schema = spark.read.format(fmt).options(**options).load(path).schema
    return reader.schema(schema).load(path)


def ingest(stream: DataFrame, table_path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Append everything that arrived since the last run, then stop.

    Progress is kept in ``checkpoint``, so each file is loaded once over any
    number of runs.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(table_path)
    query.awaitTermination()
    return query


class StreamTables:
    """Tables declared as functions that return a stream."""

    def __init__(self) -> None:
        self._tables: dict[str, tuple[StreamFunction, dict[str, str]]] = {}

    def table(self, name: str | None = None, **properties: str) -> Callable[[StreamFunction], StreamFunction]:
        """Declare a table; ``properties`` such as ``quality="bronze"`` are kept with it."""

        def declare(function: StreamFunction) -> StreamFunction:
            self._tables[name or function.__name__] = (function, properties)
            return function

        return declare

    def names(self, **properties: str) -> list[str]:
        """Declared tables that have all the given properties."""
        return [n for n, (_, p) in self._tables.items() if properties.items() <= p.items()]

    def run(self, spark: SparkSession, root: str) -> dict[str, DataFrame]:
        """Bring every declared table up to date and return them."""
        out = {}
        for name, (function, _) in self._tables.items():
            ingest(function(spark), f"{root}/{name}", f"{root}/_checkpoints/{name}")
            out[name] = spark.read.option("mergeSchema", True).parquet(f"{root}/{name}")
        return out
