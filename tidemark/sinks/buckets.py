"""A table laid out by a hash of its key, whose merges read and rewrite the touched buckets only."""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import any_null
from tidemark.operators.upsert import ACTION, merge

BUCKET = "_bucket"


class State(NamedTuple):
    """One version: its columns, the hash buckets and the folder that has each bucket's rows."""

    number: int
    schema: T.StructType
    keys: list[str]
    buckets: int
    folders: dict[int, str]


class BucketedTable:
    """Rows by ``hash(keys) mod buckets``, a folder per bucket and load.

    A merge looks up which buckets its batch touches, joins these with the
    batch and writes them to a new folder; a version names each bucket's
    folder and becomes visible when its file is renamed into place, so a merge
    that dies changes nothing and untouched buckets keep their files.  The
    folders are partitions of an external bucketed table that the session's
    catalog holds, so the join takes the buckets as they lie: the batch is
    shuffled to them, the target is not.

    Keys must not be null: such rows match nothing and would all be in one
    bucket.  The number of buckets is fixed with the first load; a bucket is
    one task's work.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _place(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._place().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def state(self, version: int | None = None) -> State | None:
        """The newest or the given version; None before the first."""
        fs, folder = self._fs(), self._place("_versions")
        numbers = [int(s.getPath().getName()[: -len(".json")]) for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")] if fs.exists(folder) else []
        if not numbers:
            return None
        number = max(numbers) if version is None else version
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/_versions/{number}.json").first()["value"]
        found = json.loads(text)
        return State(number, T.StructType.fromJson(found["schema"]), found["keys"], found["buckets"], {int(b): f for b, f in found["folders"].items()})

    def _publish(self, state: State) -> None:
        fs, attempt = self._fs(), self._place("_versions", f".{state.number}-{uuid.uuid4().hex}")
        out = fs.create(attempt, False)
        folders = {str(b): f for b, f in state.folders.items()}
        out.write(bytearray(json.dumps({"schema": state.schema.jsonValue(), "keys": state.keys, "buckets": state.buckets, "folders": folders}).encode()))
        out.close()
        if not fs.rename(attempt, self._place("_versions", f"{state.number}.json")):
            raise RuntimeError(f"version {state.number} of {self.path} exists: another writer was quicker")

    def _open(self, state: State, only: list[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets, as a bucketed scan."""
        name = f"bucketed_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema)
        by = ", ".join(f"`{k}`" for k in state.keys)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) "
            f"CLUSTERED BY ({by}) INTO {state.buckets} BUCKETS LOCATION '{self.path}/_none'"
        )
        parts = {b: f for b, f in state.folders.items() if only is None or b in only}
        if parts:
            named = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{self.path}/{f}/{BUCKET}={b}'" for b, f in sorted(parts.items()))
            self.spark.sql(f"ALTER TABLE {name} ADD {named}")
        return self.spark.table(name)

    def bucket_of(self, rows: DataFrame, buckets: int) -> Column:
        """The number that the writer of bucketed tables gives a row."""
        return F.pmod(F.hash(*[F.col(k) for k in self.keys]), F.lit(buckets))

    def read(self, version: int | None = None) -> DataFrame | None:
        state = self.state(version)
        return None if state is None else self._open(state).drop(BUCKET)

    def merged(self, batch: DataFrame, changed: str | list[str] = "columns", **options) -> tuple[State, DataFrame, list[int]]:
        """The next state without its folders, the touched buckets' rows after the merge, and these buckets."""
        state = self.state()
        if state is None:
            state = State(0, T.StructType([]), self.keys, self.buckets, {})
        else:
            batch = batch.withColumns({k: F.col(k).cast(state.schema[k].dataType) for k in self.keys})
        if not batch.where(any_null(self.keys)).isEmpty():
            raise ValueError(f"null in the key {self.keys}")
        number = self.bucket_of(batch, state.buckets)
        touched = sorted(r[0] for r in batch.select(number).distinct().collect())
        target = self._open(state, touched).drop(BUCKET) if state.number else None
        rows = merge(target, batch, self.keys, changed, batch_fits=False, spread_nulls=False, **options)
        return State(state.number + 1, rows.drop(ACTION).schema, self.keys, state.buckets, state.folders), rows, touched

    def upsert(self, batch: DataFrame, changed: str | list[str] = "columns", **options) -> State:
        """Merge ``batch`` (one row per key) as :func:`upsert.merge` does, and publish the next version."""
        state, rows, touched = self.merged(batch, changed, **options)
        folder, name = f"v{state.number}-{uuid.uuid4().hex}", f"written_{uuid.uuid4().hex}"
        rows = rows.drop(ACTION).withColumn(BUCKET, self.bucket_of(rows, state.buckets))
        if state.number == 1:  # nothing has dealt the rows yet
            rows = rows.repartition(state.buckets, *self.keys)
        writer = rows.write.format("parquet").option("path", f"{self.path}/{folder}").partitionBy(BUCKET).bucketBy(state.buckets, *self.keys)
        writer.saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files are external and stay
        state = state._replace(folders=state.folders | dict.fromkeys(touched, folder))
        self._publish(state)
        return state
