"""Bronze, silver and gold loads composed from the operators."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import hash_key, row_checksum
from tidemark.operators import project, scd2, upsert
from tidemark.operators.scd2 import Scd2Spec
from tidemark.plans import watermark
from tidemark.session import materialize
from tidemark.sinks.tables import SnapshotTable
from tidemark.spec import ColumnMap, SyncRow, keys_of, validate_mapping


def run_bronze(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    row: SyncRow,
    mapping: list[ColumnMap],
    control: DataFrame,
    mapping_rows: DataFrame,
    run_ts: Column,
    schemas: tuple[str, str] = ("", ""),
) -> tuple[DataFrame, DataFrame, list[tuple]]:
    """A whole bronze load: write the snapshot, then derive mapping rows and the watermark from it.

    ``schemas`` are the source's and the target's, for the mapping rows.
    Returns the control rows with the advanced watermark, the mapping rows to
    append for added columns, and the drift.  Both come after the write, so a
    load that fails leaves the watermark where it was.
    """
    table = SnapshotTable(spark, path)
    load = bronze_load(source, table.read(), row, mapping, run_ts)
    table.overwrite(load.merged)
    mapped = {m.source.lower() for m in mapping}
    added = [c for c in source.columns if c.lower() not in mapped]
    new_rows = project.drift_mapping(mapping_rows, added, row.source_name, schemas[0], row.table, schemas[1], row.table)
    if row.change_column:
        moved = next((m.target for m in mapping if m.source == row.change_column), row.change_column)
        control = watermark.advance(control, table.read(), row.table, moved)
    return control, new_rows, load.drift


class BronzeLoad(NamedTuple):
    """The next snapshot with its actions, and the drift found.

    The next watermark is the highest change value of the snapshot once it is
    written (``watermark.advance``), so a failed load leaves the mark alone.
    """

    merged: DataFrame
    drift: list[tuple]


def bronze_load(
    source: DataFrame,
    target: DataFrame | None,
    row: SyncRow,
    mapping: list[ColumnMap],
    run_ts: Column,
    modified: str = "LastmodifiedDate",
    lineage: str = "DataSourceID",
) -> BronzeLoad:
    """Load one source table into bronze; a full load replaces, an incremental one merges.

    Lineage and modification time are set on every inserted or updated row in
    both modes.  Columns the mapping does not name are loaded under their own
    name.  Drift compares what is loaded with the target's columns (added,
    removed, retyped), or with the mapping while there is no target.  A full
    load takes every row, also those without a change date.  An incremental
    batch is extracted once and written to the shared folder before it is
    merged.
    """
    validate_mapping(source, mapping, need_key=row.incremental)
    extracted = source
    if row.incremental and row.change_column:
        extracted = project.watermark_filter(source, row.change_column, watermark.current(row), only_if_present=True)
    mapped = {m.source.lower() for m in mapping}
    added = [c for c in source.columns if c.lower() not in mapped]
    full_mapping = [*mapping, *[ColumnMap(c, c) for c in added]]
    if target is None:
        drift = project.drift(source.schema, source.drop(*added).schema)
    else:
        own = {modified.lower(), lineage.lower(), upsert.ACTION.lower()}
        before = T.StructType([f for f in target.schema if f.name.lower() not in own])
        drift = project.drift(project.map_project(source, full_mapping).schema, before)
    batch = project.add_lineage(project.map_project(extracted, full_mapping), **{lineage: row.source_name})
    if not row.incremental or target is None:
        return BronzeLoad(batch.withColumns({modified: run_ts, upsert.ACTION: F.lit("I")}), drift)
    order = [F.col(m.target).desc() for m in full_mapping if m.source == row.change_column]
    keys = keys_of(mapping)
    unique = materialize(upsert.dedupe_batch(batch, keys, order), "bronze-batch")
    return BronzeLoad(upsert.upsert_columns(target, unique, keys, run_ts=run_ts, modified=modified), drift)


# Columns that say when a row was loaded, not what it holds.
AUDIT_COLUMNS = ("Effective_Start_Date", "Effective_End_Date", "Current_Record", "Hed_LastLoadDate_c", "LastLoadDate")


def silver_upsert(
    bronze: DataFrame,
    silver: DataFrame | None,
    mapping: list[ColumnMap],
    change_column: str,
    since: Column,
    order_by: list[Column],
    exclude: tuple[str, ...] = AUDIT_COLUMNS,
) -> DataFrame:
    """Rows changed since the window start, mapped, checksummed and merged by checksum."""
    validate_mapping(bronze, mapping, need_key=True)
    rows = project.map_project(project.watermark_filter(bronze, change_column, since), mapping)
    unique = upsert.dedupe_batch(rows, keys_of(mapping), order_by)
    unique = unique.withColumn("checksum", row_checksum(unique, exclude=exclude))
    unique = materialize(unique, "silver-batch")
    return upsert.upsert_checksum(silver, unique, keys_of(mapping))


def gold_dimension(silver: DataFrame, dim: DataFrame | None, spec: Scd2Spec, change_column: str, since: Column, compat: bool = False) -> DataFrame:
    """Silver rows changed since the window start, applied to the dimension.

    The dimension matches rows by their hash key, in which a null equals a
    null; so the batch is reduced to one row per hash key, null keys included.
    """
    return scd2.apply(dim, _dimension_batch(silver, spec, change_column, since), spec, compat)


def _dimension_batch(silver: DataFrame, spec: Scd2Spec, change_column: str, since: Column) -> DataFrame:
    rows = project.watermark_filter(silver, change_column, since).select(*spec.keys, *spec.tracked, spec.start)
    keyed = rows.withColumn("_hash", hash_key(rows, spec.keys))
    return upsert.dedupe_batch(keyed, ["_hash"], [F.col(spec.start).desc()]).drop("_hash")


class DimensionStore:
    """A dimension under ``path``: current rows as snapshots, closed versions in a folder for each load.

    A load reads and rewrites current rows only; the versions it closes go to
    ``closed`` under the very folder name that its snapshot has.  One marker
    makes both visible at once, so what a load that died has left is never
    read, whatever load comes after it and however often the number is tried
    again.  A key's newest surrogate is that of its current row, so the next
    ones follow from the current rows alone.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, spec: Scd2Spec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.current = SnapshotTable(spark, f"{self.path}/current")
        self._compacted = SnapshotTable(spark, f"{self.path}/compacted")

    def stage(self, batch: DataFrame) -> tuple[int, str]:
        """Write the dimension after ``batch`` (one row per hash key); nobody sees it before ``publish``."""
        number, folder = self.current.next_folder()
        after = materialize(scd2.apply(self.current.read(), batch, self.spec), "dimension-load")
        is_closed = F.col(scd2.ACTION) == "closed"
        after.where(is_closed).drop(scd2.ACTION).write.parquet(f"{self.path}/closed/{folder}")
        after.where(~is_closed).drop(scd2.ACTION).write.parquet(f"{self.path}/current/{folder}")
        return number, folder

    def publish(self, number: int, folder: str) -> None:
        self.current.publish(number, folder)

    def load(self, batch: DataFrame) -> int:
        number, folder = self.stage(batch)
        self.publish(number, folder)
        return number

    def closed(self, version: int | None = None) -> DataFrame | None:
        """Versions closed by the loads up to ``version``: a plain scan of their folders."""
        loads = self.current.published()
        if not loads:
            return None
        version = max(loads) if version is None else version
        base = max((n for n in self._compacted.published() if n <= version), default=0)
        folders = [f"{self.path}/closed/{f}" for n, f in sorted(loads.items()) if base < n <= version]
        if base:
            folders.append(f"{self.path}/compacted/{self._compacted.published()[base]}")
        return self.spark.read.schema(self.current.read(version).schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame | None:
        """Current and closed versions, as of the newest or the given load; None before the first."""
        current = self.current.read(version)
        return None if current is None else current.unionByName(self.closed(version))

    def compact(self) -> None:
        """Bring the folders of all loads so far together in one, for readers of many loads."""
        number = self.current.version()
        if number is None or number in self._compacted.published():
            return
        folder = self.current.next_folder()[1]
        self.closed(number).write.parquet(f"{self.path}/compacted/{folder}")
        self._compacted.publish(number, folder)


def load_dimension(
    spark: SparkSession, silver: DataFrame, path: str, spec: Scd2Spec, change_column: str, since: Column
) -> DataFrame:
    """Silver rows changed since the window start, loaded into the stored dimension, which is returned."""
    store = DimensionStore(spark, path, spec)
    store.load(_dimension_batch(silver, spec, change_column, since))
    return store.read()


def gold_fact(
    dim: DataFrame,
    fact: DataFrame | None,
    mapping: list[ColumnMap],
    surrogate: list[str],
    change_column: str,
    since: Column,
    order_by: list[Column],
) -> DataFrame:
    """Dimension rows changed since the window start, upserted by the mapped key list."""
    validate_mapping(dim, mapping, need_key=True)
    rows = project.map_project(project.watermark_filter(dim, change_column, since), mapping)
    unique = materialize(upsert.dedupe_batch(rows, keys_of(mapping), order_by), "fact-batch")
    return upsert.upsert_fact(fact, unique, keys_of(mapping), surrogate)
