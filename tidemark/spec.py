"""Control rows and column mappings, read from small control tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

DIRECT = "direct"
START_OF_TIME = datetime(1900, 1, 1)

# Layouts of the control and history tables.
SYNC_TABLE = (
    "TableName string, WatermarkValue string, ActiveFlag string, EffectiveDateColumnName string, "
    "SchemaName string, SourceName string, ColumnList string, DestinationSchema string, "
    "DestinationTable string, IsAlwaysFullLoad string, LoadType string, SourceType string"
)
MAPPING_TABLE = (
    "Mapping_Id int, Src_Schema_nm string, Src_tbl_nm string, Src_cl_nm string, Src_nm string, "
    "Dst_Schema_nm string, Dst_tbl_nm string, Dst_cl_nm string, Is_join_cl boolean, Transformation string"
)
DIM_FACT_TABLE = (
    "ID int, Source_Schema string, Source_Table string, Source_Column string, Target_Schema string, "
    "Target_Table string, Target_Column string, Transformation string, Is_Join_Key boolean, "
    "Is_Driving_Table boolean, Join_Table string, Join_Table_Column string, Join_Type string"
)
BATCH_HISTORY_TABLE = (
    "BatchID string, JobID int, BatchName string, ExecuteBeginTS timestamp, ExecuteEndTS timestamp, "
    "ExtractWindowBeginTS timestamp, ExtractWindowEndTS timestamp, Status string, ErrorLine string, "
    "ErrorDescription string, LoadType string, RetryAttempt int"
)
PROCESS_HISTORY_TABLE = (
    "ExecutionID string, BatchID string, JobID int, ExecutionStartTime timestamp, "
    "ExecutionEndTime timestamp, TableName string, Status string, TargetInsertRecCount int, "
    "TargetUpdateRecCount int, InitialTargetRecCount int, FinalTargetRecCount int, "
    "TimeTakenInSecs int, ErrorDescription string, ErrorLine int"
)
JOB_HISTORY_TABLE = (
    "JobID int, JobStartTime timestamp, JobEndTime timestamp, Status string, RetryAttempt int, "
    "ErrorMessage string"
)
FILE_LOG_TABLE = "ID string, PATH string, MODIFICATIONTIME bigint, MESSAGE string"


def as_flag(value: object) -> bool:
    """Control tables spell booleans as true, 'true', 'Y', '1', ..."""
    if isinstance(value, str):
        return value.strip().lower() in {"y", "yes", "true", "1"}
    return bool(value)


@dataclass(frozen=True)
class ColumnMap:
    """One mapping row: source column, target column, copy or SQL expression."""

    source: str
    target: str
    transformation: str = DIRECT
    is_key: bool = False

    @property
    def expression(self) -> str:
        return f"`{self.source}`" if self.transformation.strip().lower() == DIRECT else self.transformation


@dataclass(frozen=True)
class SyncRow:
    """How one source table is loaded."""

    table: str
    watermark: datetime = START_OF_TIME
    change_column: str | None = None
    source_name: str = ""
    query: str | None = None
    always_full: bool = False
    load_type: str = "F"
    source_type: str = "DB"

    @property
    def incremental(self) -> bool:
        """A merge needs a change column; without one the load is full."""
        return not self.always_full and self.load_type == "I" and bool(self.change_column)

    def after_success(self) -> "SyncRow":
        """After a good run every table that may load incrementally does so."""
        return self if self.always_full else replace(self, load_type="I")


def keys_of(mapping: Iterable[ColumnMap]) -> list[str]:
    return [m.target for m in mapping if m.is_key]


def load_mapping(rows: DataFrame, source: str, table: str) -> list[ColumnMap]:
    """Mapping rows of one source table, in id order; one row per mapped column."""
    found = (
        rows.where((rows.Src_nm == source) & (rows.Src_tbl_nm == table))
        .orderBy("Mapping_Id")
        .select("Src_cl_nm", "Dst_cl_nm", "Transformation", "Is_join_cl")
        .collect()
    )
    return [ColumnMap(r.Src_cl_nm, r.Dst_cl_nm, r.Transformation or DIRECT, as_flag(r.Is_join_cl)) for r in found]


def load_sync_rows(rows: DataFrame) -> list[SyncRow]:
    """The active control rows; one row per source table."""
    return [
        SyncRow(
            table=r.TableName,
            watermark=datetime.fromisoformat(r.WatermarkValue).replace(tzinfo=None) if r.WatermarkValue else START_OF_TIME,
            change_column=r.EffectiveDateColumnName,
            source_name=r.SourceName,
            query=r.ColumnList,
            always_full=as_flag(r.IsAlwaysFullLoad),
            load_type=r.LoadType or "F",
            source_type=r.SourceType or "",
        )
        for r in rows.where(rows.ActiveFlag == "Y").orderBy("SourceName", "TableName").collect()
    ]


def validate_mapping(df: DataFrame, mapping: Iterable[ColumnMap], need_key: bool = False) -> None:
    """Raise when an expression does not resolve or targets clash."""
    mapping = list(mapping)
    targets: dict[str, str] = {}
    for m in mapping:
        try:
            df.selectExpr(m.expression).schema
        except AnalysisException as e:
            raise ValueError(f"mapping to {m.target}: {m.expression!r} does not resolve") from e
        if targets.setdefault(m.target.lower(), m.expression) != m.expression:
            raise ValueError(f"mapping gives {m.target} two different expressions")
    if need_key and not keys_of(mapping):
        raise ValueError("mapping has no key column")
