"""Slowly changing dimensions, type 2.

``apply`` loads one batch (one row per key) into a dimension; ``rebuild``
derives the whole dimension from a set of dated versions in any order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.compare import differs
from tidemark.functions.hashing import hash_key, row_checksum
from tidemark.functions.sizing import fits_broadcast
from tidemark.operators.keys import FIRST_SURROGATE, max_key, number_rows
from tidemark.operators.windows import neighbour
from tidemark.session import materialize

ACTION = "_action"


@dataclass(frozen=True)
class Scd2Spec:
    """Keys, tracked columns and the names of the dimension's own columns."""

    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    start: str = "Effective_Start_Date"
    end: str = "Effective_End_Date"
    current: str = "Current_Record"
    surrogate: str = "sk"
    hash_key: str = "Hash_Join_key"
    checksum: str = "checksum"
    first_start: str = "1900-01-01"
    open_end: str | None = None

    @property
    def columns(self) -> list[str]:
        return [
            self.surrogate, self.hash_key, *self.keys, *self.tracked,
            self.start, self.end, self.current, self.checksum,
        ]


def prepare(batch: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Batch rows with hash key and checksum, ready to be versions."""
    return _hashed(_plain(batch, spec), spec)


def _plain(batch: DataFrame, spec: Scd2Spec) -> DataFrame:
    return batch.select(*spec.keys, *spec.tracked, F.col(spec.start).cast("date").alias(spec.start))


def _hashed(rows: DataFrame, spec: Scd2Spec) -> DataFrame:
    return rows.withColumns(_own(rows, spec))


def _fits(rows: DataFrame, spec: Scd2Spec) -> bool:
    """Whether the batch may be broadcast; the hashes it gets later have fixed lengths."""
    return fits_broadcast(rows.withColumns({spec.hash_key: F.lit("-" * 32), spec.checksum: F.lit("-" * 64)}))


def _packed(digest: str) -> Column:
    """A digest's bytes, half as long as its text; null where the text is not lower-case hex, as no batch row's is."""
    value = F.unhex(digest)
    return F.when(F.lower(F.hex(value)) == F.col(digest), value)


def _foreign(digest: str, own: Column) -> Column:
    """A digest that is not the one of its row's own columns, in a struct as it may be null; null where it is that one."""
    return F.when(~F.col(digest).eqNullSafe(own), F.struct(F.col(digest).alias("value")))


def _own(rows: DataFrame, spec: Scd2Spec) -> dict[str, Column]:
    return {spec.hash_key: hash_key(rows, spec.keys), spec.checksum: row_checksum(rows, [*spec.keys, *spec.tracked])}


def bare(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Digests that the row's own columns give are left out, others kept: they are most of a row and do not compress."""
    foreign = [_foreign(c, own).alias(f"_foreign_{c}") for c, own in _own(dim, spec).items()]
    return dim.select(*[c for c in dim.columns if c not in (spec.hash_key, spec.checksum)], *foreign)


def dressed(rows: DataFrame, spec: Scd2Spec) -> DataFrame:
    """The rows of :func:`bare` with all digests again."""
    whole = {c: F.when(F.col(f"_foreign_{c}").isNull(), own).otherwise(F.col(f"_foreign_{c}.value")) for c, own in _own(rows, spec).items()}
    return rows.withColumns(whole).drop(*[f"_foreign_{c}" for c in whole])


def written(dim: DataFrame, spec: Scd2Spec, label: str) -> DataFrame:
    """The dimension through a table in the shared folder, which holds it as :func:`bare` does."""
    return dressed(materialize(bare(dim, spec), label, "zstd"), spec).select(*dim.columns)


def _open_end(spec: Scd2Spec):
    return F.lit(spec.open_end).cast("date")


def _as_dimension(rows: DataFrame, spec: Scd2Spec) -> DataFrame:
    return rows.select(*spec.columns, ACTION)


def apply(dim: DataFrame | None, batch: DataFrame, spec: Scd2Spec, compat: bool = False) -> DataFrame:
    """The dimension after one batch, with ``_action`` per row.

    ``closed``: the current row of a key whose checksum changed; it ends the
    day before the new start, but not before its own start.  ``new_key``: a
    key never seen, valid from ``first_start``.  ``new_version``: the changed
    row, valid from its own start.  ``kept``: everything else.

    A value that returns to an earlier state opens a new version; with
    ``compat=True`` it does not, because any checksum found in the key's
    history counts as known.

    Rows are matched on the hash key, in which a null key equals a null key.
    Only current rows are joined; closed history passes through.  Surrogate
    keys continue the dimension's highest one, in key order, without gaps.

    The batch and the rows to insert are written to the shared folder first:
    the batch is read once from its source, and later steps do not repeat the
    comparison with the dimension.  Both are written and numbered without
    their hashes, and the dimension's rows are shuffled without those that
    their own columns give: they are most of a row and do not compress.
    """
    rows = materialize(_plain(batch, spec), "scd2-batch")
    if dim is None:
        return _as_dimension(_open_versions(rows.withColumn(ACTION, F.lit("new_key")), None, spec), spec)
    new = _hashed(rows, spec)
    small = _fits(rows, spec)
    is_current = F.col(spec.current) == "Y"
    current = dim.where(is_current)
    history = dim.where(~F.coalesce(is_current, F.lit(False)))

    compared = (_compared_small if small else _compared)(current, new, spec)
    changed = F.col("_new_checksum").isNotNull() & differs(F.col("_new_checksum"), F.col("_checksum"))
    day_before = F.date_sub("_new_start", 1)
    updated = compared.select(
        *[c for c in spec.columns if c not in (spec.end, spec.current)],
        F.when(changed, F.greatest(day_before, F.col(spec.start))).otherwise(F.col(spec.end)).alias(spec.end),
        F.when(changed, "N").otherwise(F.col(spec.current)).alias(spec.current),
        F.when(changed, "closed").otherwise("kept").alias(ACTION),
    )
    passed = history.select(*spec.columns, F.lit("kept").alias(ACTION))

    unknown = _unknown_rows_small(dim, new, spec, compat) if small else _unknown_rows(current, history, new, spec, compat)
    fresh = materialize(unknown.select(*rows.columns, ACTION), "scd2-fresh")
    inserted = _open_versions(fresh, dim, spec)
    return _as_dimension(updated, spec).unionByName(_as_dimension(passed, spec)).unionByName(_as_dimension(inserted, spec))


def _compared_small(current: DataFrame, new: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Current rows, each with ``_checksum`` and its batch row's ``_new_checksum`` and ``_new_start``."""
    incoming = new.select(spec.hash_key, F.col(spec.checksum).alias("_new_checksum"), F.col(spec.start).alias("_new_start"))
    return current.join(F.broadcast(incoming), spec.hash_key, "left").withColumn("_checksum", F.col(spec.checksum))


def _compared(current: DataFrame, new: DataFrame, spec: Scd2Spec) -> DataFrame:
    """The same by a shuffle, to which keys go as bytes and digests that a row's own columns give are added after it.

    A key that is no hex matches nothing.
    """
    packed = bare(current.withColumn("_key", _packed(spec.hash_key)), spec)
    incoming = new.select(
        F.unhex(spec.hash_key).alias("_key"), F.unhex(spec.checksum).alias("_new_checksum"), F.col(spec.start).alias("_new_start")
    )
    met = dressed(packed.join(incoming, "_key", "left"), spec)
    return met.withColumns({"_checksum": F.col(spec.checksum), "_new_checksum": F.lower(F.hex("_new_checksum"))})


def _unknown_rows_small(dim: DataFrame, new: DataFrame, spec: Scd2Spec, compat: bool) -> DataFrame:
    """Batch rows that open a version, marked ``new_key`` or ``new_version``.

    Reads key, checksum and flag of the dimension only, and reduces long
    histories to one row per join key before any shuffle.
    """
    match = [spec.hash_key]
    rows = dim.select(*match, spec.checksum, spec.current)
    is_live = F.lit(True) if compat else F.coalesce(F.col(spec.current) == "Y", F.lit(False))
    incoming = F.broadcast(new.select(*match, F.col(spec.checksum).alias("_new_checksum")))
    same = is_live & (F.col(spec.checksum) == F.col("_new_checksum"))
    state = rows.join(incoming, match, "inner").groupBy(*match).agg(F.bool_or(same).alias("_same"))
    fresh = new.join(state, match, "left").where("NOT coalesce(_same, false)")
    seen = F.col("_same").isNotNull()
    return fresh.withColumn(ACTION, F.when(seen, "new_version").otherwise("new_key")).drop("_same")


def _unknown_rows(current: DataFrame, history: DataFrame, new: DataFrame, spec: Scd2Spec, compat: bool) -> DataFrame:
    """The same for a batch too large to broadcast.

    Key and checksum of current rows meet the batch in one shuffle by key, as
    bytes; where the columns are of the same types, the row's own columns go
    in place of the checksum they give, which is longer, and it is made again
    after the shuffle.  Long histories are reduced before: to one row per key,
    with ``compat`` to one per state.  Two windows over the same order tell
    each batch row whether its key and its state are there.
    """
    key, state = _packed(spec.hash_key).alias("_key"), _packed(spec.checksum)
    columns = [*spec.keys, *spec.tracked]
    earlier = history.select(key, (state if compat else F.lit(None).cast("binary")).alias("_state")).distinct()
    same_types = all(current.schema[c].dataType == new.schema[c].dataType for c in columns)
    own = F.col(spec.checksum).eqNullSafe(row_checksum(current, columns)) if same_types else F.lit(False)
    kept = [F.when(F.col("_own"), F.col(c)).alias(c) for c in columns] if same_types else []
    stored = current.withColumn("_own", own).select(key, "_own", *kept, F.when(~F.col("_own"), state).alias("_state"))
    stored = stored.unionByName(earlier.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    stored = stored.where("_key IS NOT NULL").withColumn("_stored", F.lit(True))
    incoming = new.withColumns({"_key": F.unhex(spec.hash_key), "_own": F.lit(True), "_stored": F.lit(False)})
    met = incoming.drop(spec.hash_key, spec.checksum).unionByName(stored, allowMissingColumns=True).repartition("_key")
    met = met.withColumn("_state", F.when(F.col("_own"), F.unhex(row_checksum(new, columns))).otherwise(F.col("_state")))
    known = F.max("_stored").over(Window.partitionBy("_key", "_state"))
    seen = F.max("_stored").over(Window.partitionBy("_key"))
    fresh = met.withColumn("_known", known).withColumn("_seen", seen).where("NOT _stored AND NOT _known")
    return fresh.withColumn(ACTION, F.when(F.col("_seen"), "new_version").otherwise("new_key"))


def _open_versions(fresh: DataFrame, dim: DataFrame | None, spec: Scd2Spec) -> DataFrame:
    """``fresh`` as current versions; numbered before it gets its hashes, which need no sorting."""
    base = max_key(dim, spec.surrogate, FIRST_SURROGATE)
    numbered = number_rows(fresh, list(spec.keys), spec.surrogate, base, written=True)  # both callers have written ``fresh``
    first = F.lit(spec.first_start).cast("date")
    return _hashed(numbered, spec).withColumns(
        {
            spec.start: F.when(F.col(ACTION) == "new_key", first).otherwise(F.col(spec.start)),
            spec.end: _open_end(spec),
            spec.current: F.lit("Y"),
        }
    )


def rebuild(versions: DataFrame, spec: Scd2Spec, sample_from: DataFrame | None = None) -> DataFrame:
    """The dimension implied by all versions of all keys, in any order.

    One row per (key, start) is expected.  A version equal to its predecessor
    is merged into it, the first version of a key starts at ``first_start``,
    each version ends the day before the next one starts, and the last is
    current.  ``sample_from`` may name a cheaper frame with the start column
    to draw the ranges for long histories from (default: the versions).
    """
    if sample_from is None:
        sample_from = versions.select(F.col(spec.start).cast("date").alias(spec.start))
    keys = list(spec.keys)
    rows = prepare(versions, spec)
    raw = versions.select(*keys)
    before = neighbour(rows, keys, [spec.start], spec.checksum, "_before", step=-1, points_from=sample_from, hot_from=raw)
    kept = before.where(F.col("_before").isNull() | (F.col("_before") != F.col(spec.checksum)))
    kept = kept.withColumn(
        spec.start,
        F.when(F.col("_before").isNull(), F.lit(spec.first_start).cast("date")).otherwise(F.col(spec.start)),
    ).drop("_before")
    after = neighbour(kept, keys, [spec.start], spec.start, "_after", points_from=sample_from, hot_from=raw)
    open_row = F.col("_after").isNull()
    return after.select(
        *[c for c in spec.columns if c not in (spec.surrogate, spec.end, spec.current)],
        F.when(open_row, _open_end(spec)).otherwise(F.date_sub("_after", 1)).alias(spec.end),
        F.when(open_row, "Y").otherwise("N").alias(spec.current),
    )


def merge_history(dim: DataFrame, batch: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Rebuild after adding batch versions, which may be older than existing ones."""
    columns = [*spec.keys, *spec.tracked, spec.start]
    return rebuild(dim.select(*columns).unionByName(batch.select(*columns)), spec, dim)
