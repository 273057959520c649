"""File sinks.  Each writes to a path that is not being read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rebalanced(df: DataFrame, by: list[str]) -> DataFrame:
    """Group rows by output partition; AQE splits large groups and joins small ones."""
    return df.hint("rebalance", *by)


def _sized(df: DataFrame, files: int | None) -> DataFrame:
    return df if files is None else df.repartition(files)


def write_parquet(df: DataFrame, path: str, files: int | None = None, codec: str = "snappy", mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet, by default with as many files as the data has partitions."""
    sized = rebalanced(df, partition_by) if partition_by and files is None else _sized(df, files)
    writer = sized.write.mode(mode).option("compression", codec)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite", **options) -> None:
    _sized(df, files).write.mode(mode).options(header=True, **options).csv(path)


def write_json(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite", **options) -> None:
    _sized(df, files).write.mode(mode).options(**options).json(path)


def write_json_by_date(df: DataFrame, path: str, ts: str, mode: str = "overwrite", **options) -> None:
    """JSON under ``year=/month=/day=`` folders."""
    dated = df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)})
    rebalanced(dated, ["year", "month", "day"]).write.mode(mode).options(**options).partitionBy("year", "month", "day").json(path)


def write_sorted(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """Parquet in global order: range partitions, each sorted."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode(mode).parquet(path)
