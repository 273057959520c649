"""Mapped projections, lineage columns, schema drift and alignment."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import DIRECT, ColumnMap

DRIFT_SCHEMA = "change string, column_name string, source_type string, target_type string"


def map_project(df: DataFrame, mapping: Iterable[ColumnMap]) -> DataFrame:
    """Select the mapped columns under their target names, each target once."""
    by_target = {}
    for m in mapping:
        by_target.setdefault(m.target, m)
    return df.select(*[F.expr(m.expression).alias(t) for t, m in by_target.items()])


def map_rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def add_lineage(df: DataFrame, **values: str) -> DataFrame:
    """Literal columns that say where the rows come from."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def add_load_ts(df: DataFrame, column: str, run_ts: Column | None = None) -> DataFrame:
    """Load timestamp; pass ``run_ts`` to make the result reproducible."""
    return df.withColumn(column, F.current_timestamp() if run_ts is None else run_ts)


def watermark_filter(df: DataFrame, column: str, since: Column, only_if_present: bool = False) -> DataFrame:
    """Rows changed at or after the watermark (inclusive)."""
    if only_if_present and column not in df.columns:
        return df
    return df.where(F.col(column) >= since)


def drift(source: T.StructType, target: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """Added, removed and retyped columns; names compare without case."""
    new = {f.name.lower(): f for f in source}
    old = {f.name.lower(): f for f in target}
    rows = [("added", f.name, f.dataType.simpleString(), None) for k, f in new.items() if k not in old]
    rows += [("removed", f.name, None, f.dataType.simpleString()) for k, f in old.items() if k not in new]
    rows += [
        ("retyped", f.name, f.dataType.simpleString(), old[k].dataType.simpleString())
        for k, f in new.items()
        if k in old and old[k].dataType != f.dataType
    ]
    return rows


def schema_drift(spark: SparkSession, source: T.StructType, target: T.StructType) -> DataFrame:
    return spark.createDataFrame(drift(source, target), DRIFT_SCHEMA)


def drift_report(source: DataFrame, target: T.StructType) -> DataFrame:
    """The drift rows, with the number of non-null values in each added column."""
    rows = schema_drift(source.sparkSession, source.schema, target)
    added = [name for change, name, _, _ in drift(source.schema, target) if change == "added"]
    if not added:
        return rows.withColumn("non_null_rows", F.lit(None).cast("bigint"))
    counted = source.agg(*[F.count(c).alias(c) for c in added])
    per_column = counted.unpivot([], added, "column_name", "non_null_rows")
    return rows.join(per_column, "column_name", "left")


def json_drift(df: DataFrame, json_column: str, known: Iterable[str]) -> DataFrame:
    """Keys found in a JSON column and not known yet, with the rows that carry them."""
    keys = df.select(F.explode(F.expr(f"json_object_keys(`{json_column}`)")).alias("column_name"))
    counted = keys.groupBy("column_name").agg(F.count(F.lit(1)).alias("rows_with_key"))
    return counted.where(~F.col("column_name").isin(list(known)))


def drift_mapping(
    mapping: DataFrame,
    added: list[str],
    source_name: str,
    source_schema: str,
    source_table: str,
    target_schema: str,
    target_table: str,
    name_template: str = "{}",
) -> DataFrame:
    """New mapping rows for added columns, numbered after the highest id."""
    spark = mapping.sparkSession
    names = spark.createDataFrame(
        [(i, c, name_template.format(c)) for i, c in enumerate(sorted(added), 1)],
        "n int, src string, dst string",
    )
    last = F.coalesce(mapping.agg(F.max("Mapping_Id").alias("m")).scalar(), F.lit(0))
    return names.select(
        (F.col("n") + last).cast("int").alias("Mapping_Id"),
        F.lit(source_schema).alias("Src_Schema_nm"),
        F.lit(source_table).alias("Src_tbl_nm"),
        F.col("src").alias("Src_cl_nm"),
        F.lit(source_name).alias("Src_nm"),
        F.lit(target_schema).alias("Dst_Schema_nm"),
        F.lit(target_table).alias("Dst_tbl_nm"),
        F.col("dst").alias("Dst_cl_nm"),
        F.lit(False).alias("Is_join_cl"),
        F.lit(DIRECT).alias("Transformation"),
    )


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` first, typed nulls where missing, then the new ones."""
    have = set(df.columns)
    wanted = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*wanted, *[c for c in df.columns if c not in schema.names])


def union_all_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conform_sources(sources: Iterable[tuple[DataFrame, list[ColumnMap]]]) -> DataFrame:
    """Differently shaped sources mapped into one table."""
    return union_all_by_name(map_project(df, mapping) for df, mapping in sources)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def rows_as_json(df: DataFrame, alias: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias(alias))
