"""Upserts, updates and deletes that return the next snapshot of a table.

``merge`` is the general form; the named functions fix its change test.  The
result carries ``_action`` per row: I (inserted), U (updated), N (matched, not
changed), K (only in the target, kept).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import any_null, any_of, differs
from tidemark.functions.sizing import fits_broadcast
from tidemark.operators.joins import lookup_join
from tidemark.operators.windows import latest_per_key

ACTION = "_action"


def dedupe_batch(source: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = (), on_duplicate: str = "latest") -> DataFrame:
    """One row per key: the latest by ``order_by``, ties settled by the other columns in turn."""
    keys = list(keys)
    if on_duplicate == "latest":
        ties = [F.col(c).desc() for c in source.columns if c not in keys]
        return latest_per_key(source, keys, [*order_by, *ties])
    if on_duplicate != "error":
        raise ValueError("on_duplicate is 'latest' or 'error'")
    clash = source.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if clash:
        raise ValueError(f"several source rows for one key, e.g. {clash[0].asDict()}")
    return source


def merge(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    changed: Sequence[str] | str = "columns",
    *,
    null_safe: bool = True,
    immutable: Sequence[str] = (),
    stamp: dict[str, Column] | None = None,
    insert: bool = True,
    batch_fits: bool | None = None,
    spread_nulls: bool = True,
) -> DataFrame:
    """Next snapshot of ``target`` after merging ``source`` (one row per key).

    ``changed`` says when a matched row is updated: "always", "columns" (any
    common non-key column differs) or a list of columns to compare.
    ``immutable`` columns keep the target's value on update.  ``stamp`` sets
    columns on inserted and updated rows.  Columns of one side only are kept
    and filled with null on the other; names match without case.  An action
    column stored with the target is replaced.

    When the batch passes the size check it is broadcast, and the target is
    neither shuffled nor sorted; otherwise both sides are shuffled once for a
    full outer join.  Null keys never match and are spread by row content;
    without them ``spread_nulls=False`` joins on the keys alone, as a target
    that lies in buckets of the keys needs.
    """
    keys = list(keys)
    stamp = stamp or {}
    if target is None:
        return source.withColumns({**stamp, ACTION: F.lit("I")})
    target = target.drop(ACTION)
    spelled = {c.lower(): c for c in target.columns}
    source = source.withColumnsRenamed({c: spelled.get(c.lower(), c) for c in source.columns})
    keys = [spelled.get(k.lower(), k) for k in keys]
    payload = [c for c in source.columns if c not in keys]
    common = [c for c in payload if c in target.columns]
    out_columns = [*target.columns, *[c for c in payload if c not in target.columns]]
    out_columns += [c for c in stamp if c not in out_columns]
    if changed == "columns":
        compared = [c for c in common if c not in stamp and c not in immutable]
    else:
        compared = [] if changed == "always" else list(changed)

    if batch_fits is None:
        batch_fits = fits_broadcast(source)
    right = source.select(*keys, F.struct(*keys, *payload).alias("_s"))
    if batch_fits:
        joined = target.withColumn("_t", F.lit(True)).join(F.broadcast(right), keys, "left")
    elif not spread_nulls:
        joined = target.withColumn("_t", F.lit(True)).join(right, keys, "full" if insert else "left")
    else:
        left = target.withColumn("_t", F.lit(True)).withColumn("_spread", _null_salt(target, keys))
        right = source.select(*keys, _null_salt(source, keys).alias("_spread"), F.struct(*keys, *payload).alias("_s"))
        joined = left.join(right, [*keys, "_spread"], "full" if insert else "left").drop("_spread")

    is_target = F.col("_t").isNotNull()
    is_source = F.col("_s").isNotNull()
    differ = F.lit(True) if changed == "always" else any_of(
        [differs(F.col(c), F.col("_s")[c], null_safe) for c in compared]
    )
    action = (
        F.when(~is_target, "I").when(~is_source, "K").when(differ, "U").otherwise("N").alias(ACTION)
    )
    acted = joined.withColumn(ACTION, action)
    out = acted.select(
        *[_merged(c, keys, payload, target.columns, immutable, stamp) for c in out_columns], F.col(ACTION)
    )
    if not (batch_fits and insert):
        return out
    known = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi")
    fresh = source.join(known, keys, "left_anti")
    types = {f.name: f.dataType for f in out.schema}
    inserts = fresh.select(
        *[
            (stamp[c] if c in stamp else F.col(c) if c in source.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in out_columns
        ],
        F.lit("I").alias(ACTION),
    )
    return out.unionByName(inserts)


def _null_salt(df: DataFrame, keys: list[str]) -> Column:
    """Spreads rows with a null key, which match nothing, over all tasks."""
    return F.when(any_null(keys), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("bigint"))


def _merged(name, keys, payload, target_columns, immutable, stamp) -> Column:
    if name in keys:
        return F.col(name)
    in_target = name in target_columns
    old = F.col(name) if in_target else F.lit(None)
    action = F.col(ACTION)
    if name in stamp:
        return F.when(action.isin("I", "U"), stamp[name]).otherwise(old).alias(name)
    if name not in payload:
        return old.alias(name)
    new = F.col("_s")[name]
    if name in immutable:
        return F.when(action == "I", new).otherwise(old).alias(name)
    return F.when(action.isin("I", "U"), new).otherwise(old).alias(name)


def snapshot(merged: DataFrame) -> DataFrame:
    """The table itself, without the action column."""
    return merged.drop(ACTION)


def upsert_columns(target, source, keys, *, run_ts: Column | None = None, modified: str | None = None, **options) -> DataFrame:
    """Update a matched row when any mapped non-key column differs."""
    stamp = {modified: run_ts} if modified else None
    return merge(target, source, keys, "columns", stamp=stamp, **options)


def upsert_checksum(target, source, keys, checksum: str = "checksum", **options) -> DataFrame:
    """Update a matched row when its checksum differs."""
    return merge(target, source, keys, [checksum], **options)


def upsert_overwrite(target, source, keys, **options) -> DataFrame:
    """Replace every matched row, insert the others."""
    return merge(target, source, keys, "always", **options)


def upsert_fact(target, source, keys, surrogate: Sequence[str], **options) -> DataFrame:
    """Composite-key upsert whose updates leave the surrogate columns alone."""
    return merge(target, source, keys, "columns", immutable=list(surrogate), **options)


def update_matched(target, source, keys, set_columns: dict[str, Column] | None = None, **options) -> DataFrame:
    """Update matched rows only; unmatched source rows are ignored."""
    return merge(target, source, keys, "always", stamp=set_columns, insert=False, **options)


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: rows inserted, updated, unchanged, kept.

    Written together with its action column, a snapshot is counted by reading
    that column alone, so the merge runs once for rows and counts.
    """
    names = {"I": "num_inserted_rows", "U": "num_updated_rows", "N": "num_unchanged_rows", "K": "num_kept_rows"}
    return merged.agg(*[F.count_if(F.col(ACTION) == code).alias(name) for code, name in names.items()])


def table_update(df: DataFrame, predicate: Column, assign: dict[str, Column]) -> DataFrame:
    """``UPDATE ... SET ... WHERE``: all right-hand sides see the old row."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.select(*[F.when(hit, assign[c]).otherwise(F.col(c)).alias(c) if c in assign else F.col(c) for c in df.columns])


def table_delete(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE ... WHERE``: rows for which the predicate is null stay."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_keys(df: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the rows whose key is in ``doomed``."""
    return lookup_join(df, doomed.select(*keys).distinct(), list(keys), "left_anti")


def replace_by_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target rows of every key value in the batch, then append the batch."""
    return delete_keys(target, batch, keys).unionByName(batch, allowMissingColumns=True)
