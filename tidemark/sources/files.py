"""File sources: parquet, CSV, JSON lines, text; new files only; folder trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None, merge_schema: bool = False) -> DataFrame:
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema is not None else reader).parquet(*paths)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header; types are inferred unless a schema is given."""
    reader = spark.read.options(header=True, **options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def scan_sql_on_files(spark: SparkSession, query: str, **paths: str) -> DataFrame:
    """SQL straight on parquet folders; ``{name}`` in the query stands for a path."""
    return spark.sql(query.format(**{name: f"parquet.`{path}`" for name, path in paths.items()}))


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def scan_stored_query(spark: SparkSession, query: str, change_column: str | None = None, since: Column | None = None) -> DataFrame:
    """A stored query over catalog tables, limited to rows at or after the watermark."""
    df = spark.sql(query)
    return df if change_column is None else df.where(F.col(change_column) >= since)


def with_file_columns(df: DataFrame) -> DataFrame:
    """Add the path and the modification time (epoch ms) of each row's file."""
    return df.withColumns(
        {
            "file_path": F.url_decode(F.col("_metadata.file_path")),
            "modified_ms": F.unix_millis("_metadata.file_modification_time"),
        }
    )


def scan_new_files(spark: SparkSession, path: str, since_ms: int, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of files modified strictly after ``since_ms``; older files are not opened."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    newer = F.col("_metadata.file_modification_time") > F.timestamp_millis(F.lit(since_ms))
    return with_file_columns(reader.load(path).where(newer))


def last_modified_ms(log: DataFrame) -> int:
    """Highest modification time logged so far, 0 for an empty log."""
    return log.agg(F.coalesce(F.max("MODIFICATIONTIME"), F.lit(0)).alias("m")).first()["m"]


def folder(path: Column, up: int) -> Column:
    """Name of the folder ``up`` levels above a file; ``key=value`` gives the value."""
    name = F.element_at(F.split(path, "/"), -1 - up)
    return F.regexp_replace(name, "^[^=]*=", "")


def folder_below(file: Column, root: str) -> Column:
    """The first folder of a file below ``root``, however deep the file lies; ``key=value`` gives the value."""
    inside = F.regexp_replace(F.lit(root.rstrip("/")), "^[a-z0-9]+:/+", "/")
    rest = F.element_at(F.split(file, F.concat(F.lit("\\Q"), inside, F.lit("/\\E")), 2), 2)
    return F.regexp_replace(F.element_at(F.split(rest, "/"), 1), "^[^=]*=", "")


def scan_bu_tree(spark: SparkSession, path: str, table: str, since_ms: int = 0, schema: T.StructType | str | None = None) -> DataFrame:
    """One table of a ``<path>/<BU>/<table>/*`` tree, all BUs, with its BU as a column."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.option("recursiveFileLookup", True).parquet(f"{path}/*/{table}")
    newer = F.col("_metadata.file_modification_time") > F.timestamp_millis(F.lit(since_ms))
    rows = with_file_columns(rows.where(newer))
    return rows.withColumn("BU", folder_below(F.col("file_path"), path))


def file_log(rows: DataFrame, message: str = "PASSED") -> DataFrame:
    """One log row per file read: id from the path, path, modification time, outcome."""
    files = rows.groupBy("file_path").agg(F.max("modified_ms").alias("MODIFICATIONTIME"))
    file_id = F.regexp_replace(F.regexp_replace("file_path", "^[a-z]+:/+", ""), "[^A-Za-z0-9]+", "_")
    return files.select(
        file_id.alias("ID"), F.col("file_path").alias("PATH"), "MODIFICATIONTIME", F.lit(message).alias("MESSAGE")
    )
