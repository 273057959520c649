"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "tidemark") -> SparkSession:
    """A local session for tests and benchmarks; a cluster supplies its own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidemark-warehouse-"))
        .getOrCreate()
    )


#: Folders of local sessions without the setting, and all paths given out, in order.
_OWN: dict[str, str] = {}
_HANDED_OUT: list[str] = []


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared folder (``spark.checkpoint.dir``).

    The setting is read from the session.  Only a session whose executors run
    in the driver (``local[...]``, as in tests) goes without it and gets a
    folder of its own; anywhere else a missing setting is an error, since
    executors cannot see a folder on the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tidemark-"))
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.append(path)
    return path


def materialize(df, label: str, compression: str | None = None):
    """Cut lineage through a written table; survives the loss of executors.

    ``compression`` is Parquet's codec (default: the session's); zstd halves digests in hex, which snappy leaves as they are.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the shared folders that are handed out inside, on the way out.

    For a caller that writes its result to a place of its own:

        with intermediates(spark):
            table.overwrite(gold_dimension(...))
    """
    before = len(_HANDED_OUT)
    try:
        yield
    finally:
        for path in _HANDED_OUT[before:]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del _HANDED_OUT[before:]
