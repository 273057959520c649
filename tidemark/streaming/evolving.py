"""A table fed by JSON files whose columns and types change."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.lattice import WHOLE, conform, reads_as, storable, widest
from tidemark.operators.project import union_all_by_name

RESCUED = "_rescued"
_UNFIT = "__unfit"


class Known(NamedTuple):
    """The schema so far; ``version`` counts the times that a type changed."""

    version: int
    schema: T.StructType


def json_schema(lines: DataFrame, column: str = "value") -> T.StructType:
    """The schema of all JSON objects in a text column: one aggregate over VARIANT values.

    Integers are bigint, other numbers double; a field that may hold integers
    of 19 digits or more is a string, as neither has room for them.  A field
    with values that have no type in common is a string.  Fields that are null
    everywhere are void.
    """
    value = F.try_parse_json(column)
    objects = lines.select(value.alias("v"), F.col(column).alias("text")).where(F.schema_of_variant("v").startswith("OBJECT"))
    found = objects.agg(F.schema_of_variant_agg("v").alias("shape"), F.bool_or(F.col("text").rlike("[0-9]{19,}")).alias("long")).first()
    if found["shape"] is None or not found["shape"].startswith("OBJECT<"):
        return T.StructType([])
    return _as_type(T.DataType.fromDDL(_struct_ddl(found["shape"])), found["long"])


def _struct_ddl(text: str) -> str:
    """``OBJECT<...>`` as a struct's DDL; names in backticks stay as they are."""
    parts = text.split("`")
    parts[::2] = [p.replace("OBJECT<", "STRUCT<") for p in parts[::2]]
    return "`".join(parts)


def _as_type(kind: T.DataType, long: bool) -> T.DataType:
    """The table's type for a VARIANT's; ``long``: some text has 19 digits in a row."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_type(f.dataType, long)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_type(kind.elementType, long))
    if isinstance(kind, T.DecimalType):  # 7.0 has no places there, and with bigint it has 20 digits
        return T.StringType() if long and not kind.scale and kind.precision > 18 else T.DoubleType()
    return T.StringType() if isinstance(kind, T.VariantType) else kind


class EvolvingTable:
    """JSON lines that land in a folder, as a table that takes in new columns and changed types.

    Each micro-batch of the file stream is looked at whole before it is
    written, so no value meets a type that does not hold it: the stored schema
    is widened by what the batch holds (:func:`lattice.widest`).  New columns
    are null in older rows.  Where a type changes the rows go to a folder of
    the schema's next version; older folders keep their files, and
    :meth:`read` brings them to the newest types.  A batch writes to a folder
    of its own number, so that one that is run again after a crash replaces
    what it left.

    ``_rescued`` has the whole line where it holds something that no column
    has: text that is no JSON object, a name that differs from a column's only
    in case, a repeated name; and on reading, whole numbers that a wider
    column would round.  Blank lines are left out.
    """

    def __init__(self, spark: SparkSession, landing: str, path: str, max_files: int | None = None, **options):
        self.spark, self.landing, self.path = spark, landing, path.rstrip("/")
        self.max_files, self.options = max_files, options

    def _stored(self) -> list[Known]:
        """One entry per version, with its last schema, in order."""
        try:
            rows = self.spark.read.schema("batch long, version int, schema string").json(f"{self.path}/_schemas").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        last = {r.version: r.schema for r in sorted(rows, key=lambda r: (r.version, r.batch))}
        return [Known(v, T.StructType.fromJson(json.loads(s))) for v, s in last.items()]

    def schema(self) -> T.StructType:
        """The columns of the table as they are now."""
        stored = self._stored()
        return T.StructType([*storable(stored[-1].schema), T.StructField(RESCUED, T.StringType())]) if stored else T.StructType([])

    def _widened(self, found: T.StructType, batch: int) -> Known:
        known = (self._stored() or [Known(0, T.StructType([]))])[-1]
        merged = widest(known.schema, found)
        if merged == known.schema:
            return known
        fits = reads_as(storable(known.schema), storable(merged)) if len(known.schema) else True
        now = Known(known.version + (not fits), merged)
        row = self.spark.createDataFrame([(batch, now.version, merged.json())], "batch long, version int, schema string")
        row.coalesce(1).write.mode("append").json(f"{self.path}/_schemas")
        return now

    def _write(self, lines: DataFrame, batch: int) -> None:
        lines = lines.where(F.trim("value") != "")
        found = json_schema(lines)
        known = self._widened(found, batch)
        if not len(known.schema):
            known = self._widened(T.StructType([T.StructField(RESCUED, T.NullType())]), batch) if not lines.isEmpty() else known
        columns = T.StructType([f for f in storable(known.schema) if f.name != RESCUED])
        record = F.from_json("value", T.StructType([*columns, T.StructField(_UNFIT, T.StringType())]), {**self.options, "columnNameOfCorruptRecord": _UNFIT})
        odd = F.try_parse_json("value").isNull()
        if any(name not in columns.names for name in _names(found)):
            odd |= F.size(F.array_except(F.json_object_keys("value"), F.array(*[F.lit(c) for c in columns.names]))) > 0
        parsed = lines.select("value", record.alias("r"))
        rescued = F.coalesce(F.col(f"r.{_UNFIT}"), F.when(odd, F.col("value"))).alias(RESCUED)
        out = parsed.select(*[F.col(f"r.`{c}`") for c in columns.names], rescued)
        out.write.mode("overwrite").parquet(f"{self.path}/v{known.version}/batch={batch}")

    def update(self) -> StreamingQuery:
        """Load every file that arrived since the last run, then stop."""
        reader = self.spark.readStream.format("text")
        if self.max_files is not None:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        writer = reader.load(self.landing).select("value").writeStream.foreachBatch(self._write)
        query = writer.option("checkpointLocation", f"{self.path}/_checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def read(self) -> DataFrame | None:
        """All rows with the newest columns and types; None before the first batch."""
        stored = self._stored()
        newest = self.schema()
        parts = []
        for known in stored:
            had = T.StructType([*[f for f in storable(known.schema) if f.name != RESCUED], T.StructField(RESCUED, T.StringType())])
            try:
                rows = self.spark.read.schema(had).parquet(f"{self.path}/v{known.version}")
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue  # the batch that made this version never wrote
            parts.append(_as_newest(rows.select(*had.names), had, newest))
        return union_all_by_name(parts) if parts else None


def _names(found: T.StructType) -> list[str]:
    return [f.name for f in found]


def _as_newest(rows: DataFrame, had: T.StructType, newest: T.StructType) -> DataFrame:
    """Rows of one version with the newest types; numbers that these would round are rescued."""
    rounded: Column = F.lit(False)
    out = {}
    for f in newest:
        if f.name not in had.names:
            out[f.name] = F.lit(None).cast(f.dataType)
            continue
        value, old = F.col(f"`{f.name}`"), had[f.name].dataType
        out[f.name] = conform(value, old, f.dataType)
        if isinstance(old, WHOLE) and isinstance(f.dataType, T.DoubleType):
            rounded |= F.coalesce(value.cast("double").cast("decimal(38,0)") != value.cast("decimal(38,0)"), F.lit(False))
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in had.names if c != RESCUED])) if len(had) > 1 else F.lit(None).cast("string")
    out[RESCUED] = F.coalesce(F.col(RESCUED), F.when(rounded, whole))
    return rows.select(*[c.alias(n) for n, c in out.items()])
