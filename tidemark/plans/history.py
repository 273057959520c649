"""Queries over batch, process and job history tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.upsert import ACTION
from tidemark.operators.windows import top_one, top_rank
from tidemark.spec import START_OF_TIME


def latest_attempt(batches: DataFrame, name: str, attempt: str, batch: str | None = None, begun: str | None = None) -> DataFrame:
    """The rows of the highest attempt per pipeline, ties kept.

    With ``batch`` and ``begun`` only the attempts of each pipeline's latest
    batch count; the latest is the one with the last begin, as batch ids need
    not be ordered.
    """
    if batch is not None:
        newest = batches.groupBy(name).agg(F.max(F.struct(begun, batch)).alias("_last"))
        newest = newest.select(name, F.col(f"_last.{batch}").alias(batch))
        batches = lookup_join(batches, newest, [name, batch], "left_semi")
    return top_rank(batches, [name], [F.col(attempt).desc()])


def all_success(latest: DataFrame, status: str, ok: str = "SUCCESS") -> DataFrame:
    """One row: did every latest attempt succeed?  False when there is none."""
    return latest.agg(F.coalesce(F.bool_and(F.col(status) == ok), F.lit(False)).alias("all_success"))


def next_window(batches: DataFrame, name: str, end: str, now: Column, full: bool = False, overlap: str = "INTERVAL 10 HOURS") -> DataFrame:
    """Next extraction window per pipeline: from the previous end less the overlap, until now."""
    start_of_time = F.lit(START_OF_TIME.isoformat(sep=" ")).cast("timestamp_ntz")
    begin = start_of_time if full else F.col("last_end") - F.expr(overlap)
    return (
        batches.groupBy(name)
        .agg(F.max(end).alias("last_end"))
        .select(name, begin.alias("window_begin"), now.alias("window_end"))
    )


def next_attempt(batches: DataFrame, name: str, attempt: str) -> DataFrame:
    return batches.groupBy(name).agg((F.coalesce(F.max(attempt), F.lit(0)) + 1).alias("next_attempt"))


def pending_tables(tables: DataFrame, processes: DataFrame, keys: list[str], status: str, started: list[Column]) -> DataFrame:
    """Tables whose first status by the order ``started`` is FAILED, RUNNING, empty or missing.

    Order by the latest start first, so that a retry that succeeded settles
    the table.
    """
    first = top_one(processes, keys, started).select(*keys, F.col(status).alias("last_status"))
    joined = lookup_join(tables, first, keys, "left")
    return joined.where(F.coalesce("last_status", F.lit("")).isin("FAILED", "RUNNING", ""))


def job_rollup(batches: DataFrame, job: str, status: str, attempt: str, error: str) -> DataFrame:
    """Per job: FAILED with the last failed attempt's error if any batch failed, else SUCCESS."""
    failed = F.col(status) == "FAILED"
    return batches.groupBy(job).agg(
        F.when(F.bool_or(failed), "FAILED").otherwise("SUCCESS").alias("job_status"),
        F.max_by(F.when(failed, F.col(error)), F.when(failed, F.col(attempt))).alias("error_message"),
        F.count(F.lit(1)).alias("batches"),
    )


def process_audit(merged: DataFrame, table: str, begun: Column, ended: Column) -> DataFrame:
    """One audit row of a merge: counts before and after, inserted, updated, seconds."""
    act = F.col(ACTION)
    return merged.agg(
        F.count_if(act != "I").alias("InitialTargetRecCount"),
        F.count(F.lit(1)).alias("FinalTargetRecCount"),
        F.count_if(act == "I").alias("TargetInsertRecCount"),
        F.count_if(act == "U").alias("TargetUpdateRecCount"),
    ).select(
        F.lit(table).alias("TableName"),
        "InitialTargetRecCount",
        "FinalTargetRecCount",
        "TargetInsertRecCount",
        "TargetUpdateRecCount",
        F.timestamp_diff("SECOND", begun, ended).alias("TimeTakenInSecs"),
    )


def upstream_window(batches: DataFrame, name: str, batch: str, begin: str, attempt: str) -> DataFrame:
    """Begin of the first attempt of each pipeline's latest batch."""
    runs = batches.groupBy(name, batch).agg(
        F.min_by(begin, attempt).alias("window_begin"), F.max(begin).alias("_last_begin")
    )
    return top_one(runs, [name], [F.col("_last_begin").desc(), F.col(batch).desc()]).drop("_last_begin")
