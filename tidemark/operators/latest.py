"""Maintenance of an 'is latest' flag on append-style tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sizing import fits_broadcast
from tidemark.operators.joins import lookup_join, rows_with_keys
from tidemark.operators.upsert import merge, snapshot
from tidemark.operators.windows import neighbour
from tidemark.session import materialize

OPEN_END = "9999-12-31"


def _with_group_max(df: DataFrame, group: list[str], order: str, alias: str) -> DataFrame:
    """Mark the row with the group's highest ``order`` value.

    The join is on (group, order): each such pair occurs once, so a group
    that holds many rows is still spread over all tasks.  When the maxima
    pass the size check they are broadcast and the rows are not shuffled.
    """
    top = df.groupBy(*group).agg(F.max(order).alias("_top"))
    if fits_broadcast(top):
        top = F.broadcast(top)
    top = top.withColumnsRenamed({g: f"_g_{g}" for g in group}).withColumn(alias, F.lit(True))
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col(order) == F.col("_top")]
    marked = df.join(top, same, "left")
    return marked.select(*df.columns, F.coalesce(alias, F.lit(False)).alias(alias))


def latest_flag(target: DataFrame, batch: DataFrame, key: str, sequence: str, flag: str = "IsLatest") -> DataFrame:
    """Append the batch: the last batch row per key becomes latest.

    Existing rows of the batch's keys lose the flag; other rows keep theirs.
    A null key equals no other, so each such row is its own latest.
    ``sequence`` orders the batch uniquely per key and is dropped from the
    result unless the target has it.
    """
    touched = batch.select(key).distinct().withColumn("_touched", F.lit(True))
    old = lookup_join(target, touched, [key], "left")
    old = old.withColumn(flag, F.when(F.col("_touched"), F.lit(0)).otherwise(F.col(flag))).select(*target.columns)
    marked = _with_group_max(batch, [key], sequence, "_last")
    is_latest = F.col("_last") | F.col(key).isNull()
    new = marked.withColumn(flag, is_latest.cast(target.schema[flag].dataType)).drop("_last")
    if sequence not in target.columns:
        new = new.drop(sequence)
    return old.unionByName(new, allowMissingColumns=True)


def latest_flag_end_ts(
    target: DataFrame,
    batch: DataFrame,
    group: str,
    key: str,
    ts: str,
    flag: str = "IsLatest",
    end: str = "trans_proc_end_ts",
    end_from: str = "self",
) -> DataFrame:
    """Recompute flag and end timestamp for the groups the batch touches.

    Current target rows of those groups and the batch rows are pooled; per
    group the highest ``key`` is latest and stays open, the others end at
    their own timestamp (``end_from="self"``) or at their successor's
    (``"successor"``).  The pool is written to the shared folder first, so the
    target and the batch are read once for it, and the flagged rows again
    before they are merged into the target.
    """
    end_type = target.schema[end].dataType
    current = rows_with_keys(target.where(F.col(flag) == 1), batch, [group]).distinct()
    pool = materialize(current.unionByName(batch, allowMissingColumns=True), "latest-rows")
    marked = _with_group_max(pool, [group], key, "_last")
    closing = ts
    if end_from == "successor":
        marked = neighbour(marked, [group], [key], ts, "_next")
        closing = "_next"
    elif end_from != "self":
        raise ValueError("end_from is 'self' or 'successor'")
    final = marked.withColumns(
        {
            flag: F.col("_last").cast("int"),
            end: F.when(F.col("_last"), F.lit(OPEN_END).cast(end_type)).otherwise(F.col(closing).cast(end_type)),
        }
    ).select(*target.columns)
    final = materialize(final, "latest-pool")
    return snapshot(merge(target, final, [group, key], "always"))
