import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tidemark.operators import scd2
from tidemark.operators.scd2 import ACTION, Scd2Spec

SPEC = Scd2Spec(keys=("id",), tracked=("v",))
SHAPE = f"id int, v string, {SPEC.start} date"
DAY = date(2024, 1, 1)


def batch(spark, values, day):
    return spark.createDataFrame([(k, v, day) for k, v in values.items()], SHAPE)


def load(spark, batches, compat=False, spec=SPEC):
    dim = None
    for i, values in enumerate(batches):
        dim = scd2.apply(dim, batch(spark, values, DAY + timedelta(days=31 * i)), spec, compat).drop(ACTION)
    return dim


def simulate(batches, compat):
    """The rules, row by row."""
    dim, top = [], 1000
    for i, values in enumerate(batches):
        day = DAY + timedelta(days=31 * i)
        before = [dict(r) for r in dim]
        for key in sorted(values):
            mine = [r for r in before if r["id"] == key]
            current = [r for r in dim if r["id"] == key and r["cur"] == "Y"]
            known = [r for r in mine if compat or r["cur"] == "Y"]
            if current and current[0]["v"] != values[key]:
                current[0]["cur"] = "N"
                current[0]["end"] = max(day - timedelta(days=1), current[0]["start"])
            if values[key] not in [r["v"] for r in known]:
                top += 1
                start = day if mine else date(1900, 1, 1)
                dim.append({"sk": top, "id": key, "v": values[key], "start": start, "end": None, "cur": "Y"})
    return sorted(((r["sk"], r["id"], r["v"], r["start"], r["end"], r["cur"]) for r in dim), key=repr)


def changes(seed):
    rng = random.Random(seed)
    return [{k: rng.choice("abc") for k in rng.sample(range(30), 20)} for _ in range(4)]


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("fits", [True, False])
def test_random_batches_follow_the_rules(spark, monkeypatch, compat, fits):
    monkeypatch.setattr(scd2, "fits_broadcast", lambda df: fits)
    batches = changes(3)
    dim = load(spark, batches, compat)
    got = dim.select(SPEC.surrogate, "id", "v", SPEC.start, SPEC.end, SPEC.current)
    assert rows(got) == simulate(batches, compat)


def test_invariants(spark, small_buckets):
    dim = load(spark, changes(8)).collect()
    assert sorted(r["sk"] for r in dim) == list(range(1001, 1001 + len(dim)))
    for key in {r["id"] for r in dim}:
        mine = sorted((r for r in dim if r["id"] == key), key=lambda r: r[SPEC.start])
        assert [r[SPEC.current] for r in mine] == ["N"] * (len(mine) - 1) + ["Y"]
        for a, b in zip(mine, mine[1:]):
            assert a[SPEC.end] + timedelta(days=1) == b[SPEC.start]


def test_same_batch_twice(spark):
    values = {1: "a", 2: "b"}
    dim = load(spark, [values])
    again = scd2.apply(dim, batch(spark, values, DAY + timedelta(days=5)), SPEC)
    assert rows(again.drop(ACTION)) == rows(dim)


def test_return_to_earlier_value(spark):
    steps = [{1: "a"}, {1: "b"}, {1: "a"}]
    assert load(spark, steps).where("Current_Record = 'Y'").count() == 1
    assert load(spark, steps, compat=True).where("Current_Record = 'Y'").count() == 0


def test_end_is_not_before_start(spark):
    dim = load(spark, [{1: "a"}, {1: "b"}])
    out = scd2.apply(dim, batch(spark, {1: "c"}, date(2024, 1, 15)), SPEC)
    closed = out.where(F.col(ACTION) == "closed").first()
    assert closed[SPEC.end] == closed[SPEC.start]


def test_rebuild_three_versions(spark):
    versions = spark.createDataFrame(
        [(1, "a", date(2024, 1, 1)), (1, "b", date(2024, 2, 1)), (1, "c", date(2024, 3, 1))], SHAPE
    )
    spec = Scd2Spec(keys=("id",), tracked=("v",), open_end="9999-12-31")
    out = rows(scd2.rebuild(versions, spec).select("v", spec.start, spec.end, spec.current))
    assert out == [
        ("a", date(1900, 1, 1), date(2024, 1, 31), "N"),
        ("b", date(2024, 2, 1), date(2024, 2, 29), "N"),
        ("c", date(2024, 3, 1), date(9999, 12, 31), "Y"),
    ]


@pytest.mark.parametrize("split", [False, True])
def test_batches_in_order_equal_rebuild(spark, split, request):
    if split:
        request.getfixturevalue("small_buckets")
    batches = changes(5)
    history = [(k, v, DAY + timedelta(days=31 * i)) for i, b in enumerate(batches) for k, v in b.items()]
    rebuilt = scd2.rebuild(spark.createDataFrame(history, SHAPE), SPEC)
    assert rows(rebuilt) == rows(load(spark, batches).select(*rebuilt.columns))


def test_late_versions(spark):
    batches = changes(6)
    parts = [batch(spark, b, DAY + timedelta(days=31 * i)) for i, b in enumerate(batches)]
    whole = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    dim = scd2.prepare(parts[0].union(parts[3]), SPEC)
    assert rows(scd2.merge_history(dim, parts[1].union(parts[2]), SPEC)) == rows(scd2.rebuild(whole, SPEC))


def test_large_batch_needs_no_global_window(spark, tables, small_buckets):
    orders = spark.read.parquet(f"{tables}/orders.parquet").withColumn(SPEC.start, F.to_date("o_orderdate"))
    spec = Scd2Spec(keys=("o_orderkey",), tracked=("o_orderstatus",))
    dim = scd2.apply(None, orders.where("o_orderstatus <> 'F'"), spec).drop(ACTION)
    text = plan(scd2.apply(dim, orders, spec))
    for line in text.splitlines():
        assert "BatchEvalPython" not in line and "CartesianProduct" not in line and "NestedLoop" not in line
        if "Window [" in line:
            assert "_bucket" in line


@pytest.mark.parametrize("fits", [True, False])
def test_null_key_is_one_key(spark, monkeypatch, fits):
    monkeypatch.setattr(scd2, "fits_broadcast", lambda df: fits)
    dim = load(spark, [{None: "a"}, {None: "a"}, {None: "b"}])
    assert rows(dim.select("v", SPEC.current)) == [("a", "N"), ("b", "Y")]


def test_stored_load_leaves_closed_history_alone(spark, tmp_path):
    from tidemark.plans import medallion

    def load_day(values, day):
        silver = batch(spark, values, day).withColumn("changed", F.lit("2024-01-01").cast("timestamp_ntz"))
        return medallion.load_dimension(spark, silver, str(tmp_path), SPEC, "changed", F.lit("1900-01-01").cast("timestamp_ntz"))

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "closed").rglob("*.parquet")}

    steps = [{1: "a", 2: "b", None: "n"}, {1: "c", None: "n"}, {1: "a", 3: "d", None: "m"}]
    dim, seen = None, {}
    for i, values in enumerate(steps):
        dim = load_day(values, DAY + timedelta(days=31 * i))
        now = files()
        assert seen.items() <= now.items()
        seen = now
    plain = load(spark, steps)
    key = [SPEC.surrogate, "id", "v", SPEC.start, SPEC.end, SPEC.current]
    assert rows(dim.select(*key)) == rows(plain.select(*key))
    assert dim.select(SPEC.surrogate).distinct().count() == dim.count()


def stored(spark, path):
    from tidemark.plans.medallion import DimensionStore

    return DimensionStore(spark, str(path), SPEC)


KEY = [SPEC.surrogate, "id", "v", SPEC.start, SPEC.end, SPEC.current]
STEPS = [{1: "a", 2: "b", None: "n"}, {1: "c", 2: "d"}, {1: "a", 3: "d", None: "m"}]


def on(spark, i):
    return batch(spark, STEPS[i], DAY + timedelta(days=31 * i))


@pytest.mark.parametrize("died_in", ["closed", "current", "publish"])
def test_a_load_that_died_leaves_no_trace(spark, tmp_path, monkeypatch, died_in):
    """The next load has another batch under the same number."""
    store = stored(spark, tmp_path)
    store.load(on(spark, 0))
    other = batch(spark, {1: "dead", 2: "dead", 9: "dead", None: "dead"}, DAY + timedelta(days=20))
    number, folder = store.stage(other)
    if died_in != "publish":
        import shutil

        shutil.rmtree(tmp_path / "current" / folder)
    if died_in == "closed":
        next((tmp_path / "closed" / folder).glob("*.parquet")).unlink()
    for i in (1, 2):
        store.load(on(spark, i))
    assert rows(store.read().select(*KEY)) == rows(load(spark, STEPS).select(*KEY))
    assert store.current.published()[number] != folder


def test_reading_a_stored_dimension_shuffles_nothing(spark, tmp_path):
    store = stored(spark, tmp_path)
    assert store.read() is None and store.closed() is None
    for i in range(3):
        store.load(on(spark, i))
    text = plan(store.read())
    assert "Exchange" not in text and "Aggregate" not in text


def test_earlier_loads_and_compaction(spark, tmp_path):
    store = stored(spark, tmp_path)
    store.compact()
    for i in range(3):
        store.load(on(spark, i))
        if i == 1:
            store.compact()
            store.compact()
    for i in range(3):
        assert rows(store.read(i + 1).select(*KEY)) == rows(load(spark, STEPS[: i + 1]).select(*KEY))
    store.compact()
    assert rows(store.read().select(*KEY)) == rows(load(spark, STEPS).select(*KEY))
    assert rows(store.closed().select("id")) == rows(store.read().where(f"{SPEC.current} = 'N'").select("id"))


@pytest.mark.parametrize("compat", [False, True])
def test_digests_are_not_staged_and_shuffled_as_bytes(spark, monkeypatch, compat):
    from tidemark import session

    monkeypatch.setattr(scd2, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = load(spark, changes(2)[:3], compat)
        before = len(session._HANDED_OUT)
        out = scd2.apply(dim, batch(spark, {1: "z", 99: "y"}, date(2024, 9, 1)), SPEC, compat)
        assert "hashpartitioning(Hash_Join_key" not in plan(out) and "hashpartitioning(_key" in plan(out)
        staged = [p for p in session._HANDED_OUT[before:] if "/scd2-" in p]
        assert len(staged) == 2
        for path in staged:
            assert not {SPEC.hash_key, SPEC.checksum} & set(spark.read.parquet(path).columns)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("fits", [True, False])
def test_foreign_digests_stay_as_they_are(spark, monkeypatch, fits, compat):
    """A stored digest that no batch row can have is kept as text; its key, or its state, is unknown."""
    monkeypatch.setattr(scd2, "fits_broadcast", lambda df: fits)
    dim = load(spark, [{i: "a" for i in range(6)}])
    key, state = F.col(SPEC.hash_key), F.col(SPEC.checksum)
    nth = F.col("id")
    foreign = dim.withColumns({
        SPEC.hash_key: F.when(nth == 1, F.upper(key)).when(nth == 2, "no hex").when(nth == 3, None).otherwise(key),
        SPEC.checksum: F.when(nth == 4, F.upper(state)).when(nth == 5, "no hex").otherwise(state),
    })
    kept = {r["id"]: (r[SPEC.hash_key], r[SPEC.checksum]) for r in foreign.collect()}
    out = scd2.apply(foreign, batch(spark, {i: "a" for i in range(6)}, date(2024, 6, 1)), SPEC, compat).collect()
    old = [r for r in out if r[ACTION] in ("kept", "closed")]
    assert {r["id"]: (r[SPEC.hash_key], r[SPEC.checksum]) for r in old} == kept and len(old) == 6
    actions = {i: sorted(r[ACTION] for r in out if r["id"] == i) for i in range(6)}
    assert actions == {0: ["kept"], **{i: ["kept", "new_key"] for i in (1, 2, 3)}, **{i: ["closed", "new_version"] for i in (4, 5)}}


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("fits", [True, False])
def test_key_with_closed_versions_only(spark, monkeypatch, fits, compat):
    monkeypatch.setattr(scd2, "fits_broadcast", lambda df: fits)
    dim = load(spark, [{1: "a", 2: "a"}]).withColumn(SPEC.current, F.when(F.col("id") == 1, "N"))
    out = scd2.apply(dim, batch(spark, {1: "a", 2: "a", 3: "a"}, date(2024, 6, 1)), SPEC, compat)
    new = rows(out.where(f"{ACTION} <> 'kept'").select("id", ACTION))
    assert new == ([(3, "new_key")] if compat else [(1, "new_version"), (2, "new_version"), (3, "new_key")])


@pytest.mark.parametrize("compat", [False, True])
def test_rows_are_stored_without_their_own_digests(spark, monkeypatch, compat):
    """A written dimension has no digest that its columns give; others stay, and a large batch gives what a small one does."""
    monkeypatch.setattr(scd2, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dim = load(spark, [{i: "a" for i in range(40)}])
        key, state = F.col(SPEC.hash_key), F.col(SPEC.checksum)
        odd = dim.withColumns({
            SPEC.hash_key: F.when(F.col("id") == 1, None).when(F.col("id") == 2, "no hex").otherwise(key),
            SPEC.checksum: F.when(F.col("id") == 3, "no hex").when(F.col("id") == 4, "").otherwise(state),
        })
        stored = scd2.written(odd, SPEC, "dim")
        assert stored.schema.simpleString() == odd.schema.simpleString() and rows(stored) == rows(odd)
        assert scd2.bare(odd, SPEC).where(f"_foreign_{SPEC.hash_key} IS NOT NULL OR _foreign_{SPEC.checksum} IS NOT NULL").count() == 4
        staged = spark.read.parquet(stored.inputFiles()[0].rsplit("/", 1)[0])
        assert not {SPEC.hash_key, SPEC.checksum} & set(staged.columns)
        for some in (dim, odd):
            new = batch(spark, {i: "ab"[i % 2] for i in range(50)}, date(2024, 9, 1))
            out = scd2.apply(some, new, SPEC, compat)
            with monkeypatch.context() as m:
                m.setattr(scd2, "fits_broadcast", lambda df: True)
                assert rows(out) == rows(scd2.apply(some, new, SPEC, compat))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("compat", [False, True])
def test_batch_with_columns_of_another_type(spark, monkeypatch, compat):
    """A stored checksum is compared as it is where the batch's columns have other types, with and without a shuffle."""
    dim = load(spark, [{1: "a", 2: "a"}])
    new = batch(spark, {1: "a", 2: "b", 3: "c"}, date(2024, 9, 1)).withColumn("id", F.col("id").cast("decimal(20,0)"))
    found = []
    for fits in (True, False):
        monkeypatch.setattr(scd2, "fits_broadcast", lambda df, fits=fits: fits)
        out = scd2.apply(dim, new, SPEC, compat)
        found.append(rows(out.select(F.col("id").cast("long"), "v", SPEC.checksum, SPEC.start, SPEC.end, ACTION)))
    assert found[0] == found[1] and {r[-1] for r in found[0]} == {"kept", "closed", "new_version", "new_key"}
