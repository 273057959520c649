"""Table sinks: versioned snapshots, appends, partition replacement, DDL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import all_of, any_of
from tidemark.operators.project import union_all_by_name
from tidemark.operators.upsert import merge, snapshot
from tidemark.session import materialize
from tidemark.sinks.files import rebalanced

MAX_TOUCHED = 1000


class SnapshotTable:
    """A parquet table whose every overwrite is a new folder.

    The folder is written first; the version becomes visible when its marker
    file is created under ``_versions``, so nothing is ever half replaced and
    readers of an older version are not disturbed.  One writer at a time: a
    table with several writers belongs into a catalog with transactions.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def published(self) -> dict[int, str]:
        """The data folder of each version that readers can see."""
        fs, path = self._fs(), self._path("_versions")
        if not fs.exists(path):
            return {}
        names = [s.getPath().getName().partition(".") for s in fs.listStatus(path)]
        return {int(number): folder for number, _, folder in names}

    def version(self) -> int | None:
        return max(self.published(), default=None)

    def next_folder(self) -> tuple[int, str]:
        """Number of the next version, and a folder name that no other attempt at it has."""
        number = (self.version() or 0) + 1
        return number, f"v{number}-{uuid.uuid4().hex}"

    def publish(self, number: int, folder: str) -> None:
        """Make a written folder the given version, in one step."""
        self._fs().create(self._path("_versions", f"{number}.{folder}"), False).close()

    def _data_path(self, version: int) -> str:
        folders = self.published()
        if version not in folders:
            raise ValueError(f"no version {version} under {self.path}")
        return f"{self.path}/{folders[version]}"

    def read(self, version: int | None = None) -> DataFrame | None:
        """The given or newest version; None when nothing was written yet."""
        found = self.version() if version is None else version
        return None if found is None else self.spark.read.parquet(self._data_path(found))

    def overwrite(self, df: DataFrame, merge_schema: bool = False, partition_by: list[str] | None = None) -> int:
        """Write the next version and return its number.

        With ``merge_schema`` columns of the previous version that ``df``
        lacks are kept as nulls.
        """
        base = self.version()
        if merge_schema and base is not None:
            df = union_all_by_name([self.read(base).limit(0), df])
        number, folder = self.next_folder()
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/{folder}")
        self.publish(number, folder)
        return number


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append; new columns appear for readers that merge schemas."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; the others stay.

    Rows are rebalanced by partition: few files per small partition, and
    several tasks for one that holds a large share of the rows.
    """
    rebalanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_partitioned(spark: SparkSession, path: str, like: DataFrame, partition_by: list[str]) -> DataFrame:
    """A partitioned table whose partition columns have the types they have in ``like``."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, like.schema[f.name].dataType) if f.name in partition_by else f for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def merge_partitions(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], partition_by: list[str], **options
) -> DataFrame:
    """Merge a batch into a partitioned table and rewrite only the partitions it touches.

    A key must never change its partition; a null partition value is a value
    like any other.  Partition columns are read with the batch's types, not
    with types guessed from folder names.  The merged partitions are written
    to the shared folder first, so the table is not read while it is replaced.
    Returns the merged rows with their actions.
    """
    touched = batch.select(*partition_by).distinct()
    few = touched.limit(MAX_TOUCHED + 1).collect()
    target = read_partitioned(spark, path, batch, partition_by)
    if len(few) <= MAX_TOUCHED:  # as literals, so that other folders are not even listed
        wanted = any_of([all_of([F.col(c).eqNullSafe(F.lit(r[c])) for c in partition_by]) for r in few])
        target = target.where(wanted)
    else:
        named = touched.withColumnsRenamed({c: f"_touched_{c}" for c in partition_by})
        target = target.join(named, all_of([F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in partition_by]), "left_semi")
    merged = materialize(merge(target, batch, keys, **options), "merged-partitions")
    replace_partitions(snapshot(merged), path, partition_by)
    return merged


def load_staged(df: DataFrame, path: str, table: str, bu: str = "BU") -> None:
    """History staging tables (``*_stg_h``) replace their BUs, others append.

    Rows without a BU replace nothing: they are added to those there.  All of
    it is one write: where the batch has such rows, those that the table has
    are read first and written again with them, so that a load that dies in
    between has neither replaced a BU nor added a row.  In that case the rows
    to write are put into the shared folder before the table is touched.
    """
    if not table.endswith("_stg_h"):
        append_rows(df, path, [bu])
        return
    rows, unknown = df, F.col(bu).isNull()
    if _exists(df.sparkSession, path) and not df.where(unknown).isEmpty():
        there = read_partitioned(df.sparkSession, path, df, [bu]).where(unknown)
        rows = materialize(union_all_by_name([df, there]), "staged-rows")
    replace_partitions(rows, path, [bu])


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def create_table(spark: SparkSession, name: str, columns: str, partitioned_by: list[str] | None = None, location: str | None = None) -> None:
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")


def add_columns(spark: SparkSession, name: str, columns: str) -> None:
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def truncate_table(spark: SparkSession, name: str) -> None:
    """Remove all rows of a table that the catalog manages."""
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table_as(df: DataFrame, name: str, location: str | None = None) -> DataFrame:
    writer = df.write.mode("overwrite")
    (writer.option("path", location) if location else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def empty(spark: SparkSession, columns: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(columns))


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Partitions of a table with their row counts."""
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return spark.table(name).groupBy(*parts).agg(F.count(F.lit(1)).alias("row_count"))
