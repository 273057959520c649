"""Files as rows: what a folder holds, what a log has not seen, and how each file's load ended."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.project import union_all_by_name
from tidemark.session import shared_dir
from tidemark.sources.files import with_file_columns

#: A file is known by these three: one that is written again under its name is another file.
IDENTITY = ["PATH", "MODIFICATIONTIME", "LENGTH"]
PASSED, FAILED = "PASSED", "FAILED"
LOG = "ID string, PATH string, MODIFICATIONTIME long, LENGTH long, MESSAGE string"
#: What the readers report for a file that cannot be read, as against a job that failed for another reason.
UNREADABLE = re.compile(r"\[(FAILED_READ_FILE|CANNOT_READ_FILE_FOOTER|UNABLE_TO_INFER_SCHEMA).*")


def list_files(spark: SparkSession, path: str, names: str | None = None) -> DataFrame:
    """``PATH, MODIFICATIONTIME`` (epoch ms)``, LENGTH`` of every file below ``path``, a glob; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = (reader.option("pathGlobFilter", names) if names else reader).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    return found.select(F.col("path").alias("PATH"), F.unix_millis("modificationTime").alias("MODIFICATIONTIME"), F.col("length").alias("LENGTH"))


def unseen(listing: DataFrame, log: DataFrame | None, retry_failed: bool = True) -> DataFrame:
    """Files that the log does not have, whatever their times are.

    A high-water mark of modification times passes over a file that arrives
    late with an older time, and over one of the same millisecond as the last;
    this compares path, time and length.  Files that failed are tried again
    unless ``retry_failed`` is off.  A log without lengths is compared by path
    and time.
    """
    if log is None:
        return listing
    by = [c for c in IDENTITY if c in log.columns]
    done = log.where(F.col("MESSAGE") == PASSED) if retry_failed else log
    return listing.join(done.select(*by).distinct(), by, "left_anti")


class FileLoad(NamedTuple):
    """``rows`` of all files that could be read, with ``file_path`` and ``modified_ms``; a log row for each file."""

    rows: DataFrame | None
    log: DataFrame


def load_files(spark: SparkSession, files: DataFrame, read: Callable[[list[str]], DataFrame]) -> FileLoad:
    """Read the listed files together; those that cannot be read are logged as failed, the others load.

    ``read`` makes a frame of a list of paths (wildcards in names are
    escaped).  The rows are written to the
    shared folder, so that a failure shows here.  When reading fails, the
    files that the error names are tried alone and the others again, or the
    list is halved if it names none: a few bad files cost a few jobs more, and
    a file's rows are all taken or none.  An error that is not about a file is
    raised.  Only the listing reaches the driver, as it does in every scan.
    """
    listed = files.select(*IDENTITY).collect()
    out = shared_dir(spark, "loaded-files")
    todo, parts, errors = [[f.PATH for f in listed]] if listed else [], [], {}
    while todo:
        group = todo.pop()
        place = f"{out}/{len(parts)}-{len(todo)}-{len(errors)}"
        try:
            with_file_columns(read([_literal(p) for p in group])).write.mode("overwrite").parquet(place)
            parts.append(spark.read.parquet(place))
        except (PySparkException, Py4JJavaError) as error:  # the latter from a footer, before there is a plan
            text = str(error)
            reason = UNREADABLE.search(text)
            if reason is None:
                raise
            if len(group) == 1:
                errors[group[0]] = reason.group().split(" SQLSTATE")[0]
                continue
            todo += _suspects(group, text)
    log = [(_file_id(f.PATH), *f, f"{FAILED}: {errors[f.PATH]}" if f.PATH in errors else PASSED) for f in listed]
    return FileLoad(union_all_by_name(parts) if parts else None, spark.createDataFrame(log, LOG))


def _suspects(group: list[str], text: str) -> list[list[str]]:
    named = [p for p in group if _bare(p) in text]
    if named and len(named) < len(group):
        return [[p] for p in named] + [[p for p in group if p not in named]]
    middle = len(group) // 2
    return [group[:middle], group[middle:]]


def _literal(path: str) -> str:
    """A path in which no character is a wildcard."""
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in path)


def _bare(path: str) -> str:
    """A path without its scheme, as it stands in every spelling of it."""
    return "/" + path.split(":", 1)[-1].lstrip("/")


def _file_id(path: str) -> str:
    return "".join(c if c.isascii() and c.isalnum() else "_" for c in _bare(path).lstrip("/"))


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(LOG))
