"""Raw-zone consolidation: the same table of many BUs, new files only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upsert import replace_by_keys
from tidemark.sources.files import folder_below
from tidemark.sources.manifest import list_files, load_files, unseen


class Consolidation(NamedTuple):
    """``rows`` with their BU (None if no file was new or readable), and the log rows to append."""

    rows: DataFrame | None
    log: DataFrame


def consolidate(spark: SparkSession, path: str, table: str, log: DataFrame | None = None, schema: T.StructType | str | None = None) -> Consolidation:
    """All BUs' new files of one table as one frame, and the log rows to append.

    A file is new if the log does not have its path, time and length as
    passed, so files that arrive late or failed before are taken.  A file that
    cannot be read is logged with its error and the others load.  The rows are
    written to the shared folder; a file is logged as passed exactly when its
    rows are there.
    """

    def read(paths: list[str]) -> DataFrame:
        reader = spark.read.option("mergeSchema", schema is None)
        return (reader if schema is None else reader.schema(schema)).parquet(*paths)

    loaded = load_files(spark, unseen(list_files(spark, f"{path}/*/{table}", "*.parquet"), log), read)
    if loaded.rows is None:
        return Consolidation(None, loaded.log)
    rows = loaded.rows.withColumn("BU", folder_below(F.col("file_path"), path))
    return Consolidation(rows.drop("file_path", "modified_ms"), loaded.log)


def load_table(target: DataFrame | None, batch: DataFrame | None, table: str, bu: str = "BU") -> DataFrame | None:
    """Next snapshot: history staging tables replace the batch's BUs, others append; no batch changes nothing."""
    if target is None or batch is None:
        return batch if target is None else target
    if table.endswith("_stg_h"):
        return replace_by_keys(target, batch, [bu])
    return target.unionByName(batch, allowMissingColumns=True)


def failure_log(paths: DataFrame, error: str, limit: int | None = None) -> DataFrame:
    """Log rows for files that could not be loaded; messages are cut only if a ``limit`` is given."""
    message = F.lit(error) if limit is None else F.substring(F.lit(error), 1, limit)
    return paths.withColumn("MESSAGE", message)
