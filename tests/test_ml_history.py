import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.ml import classify
from tidemark.plans import history


def sample(spark):
    return spark.range(400).select(
        "id", (F.col("id") % 3).cast("string").alias("colour"), (F.col("id") % 17).cast("double").alias("size"),
        F.when((F.col("id") % 17) > 8, ">50K").otherwise("<=50K").alias("income"),
    )


def test_classification_round_trip(spark):
    df = sample(spark)
    data = classify.fit_features(df, ["colour"], ["size"], label_source="income").transform(df)
    train, test = classify.hash_split(data, "id")
    assert train.count() + test.count() == 400 and 240 < train.count() < 320
    assert rows(classify.hash_split(data.repartition(7), "id")[0].select("id")) == rows(train.select("id"))
    for estimator in (classify.logistic(), classify.tree(), classify.forest(numTrees=5)):
        areas = classify.evaluate(estimator.fit(train).transform(test))
        assert areas["areaUnderROC"] > 0.95
    model = classify.logistic().fit(train)
    names = classify.feature_names(train)
    assert "size" in names and len(names) == len(model.coefficients)
    assert classify.coefficients(model, names, train).count() == len(names) + 1
    curve = classify.roc(classify.score(model, train, ["label"]))
    assert curve.agg(F.max("FPR"), F.max("TPR")).first()[:] == (1.0, 1.0) and curve.count() > 2
    assert len(names) == 2 + 1  # three colours, the rarest has no feature
    searched = classify.cross_validate(classify.tree(), train, {"maxDepth": [1, 3]}, folds=2)
    assert len(searched.avgMetrics) == 2


def test_roc_and_area_by_hand(spark, small_buckets):
    # scores 4, 3, 3, 2, 1 with labels 1, 1, 0, 0, 1
    df = spark.createDataFrame([(4.0, 1), (3.0, 1), (3.0, 0), (2.0, 0), (1.0, 1)], "s double, y int")
    third = 1 / 3
    assert rows(classify.roc(df, "y", "s")) == [(0.0, 0.0), (0.0, third), (0.5, 2 * third), (1.0, 2 * third), (1.0, 1.0)]
    # of 6 pairs 3 are in order and one is tied
    assert classify.area_under_roc(df, "y", "s").first()["area"] == 3.5 / 6
    many = spark.range(200).select((F.col("id") % 37).cast("double").alias("s"), (F.col("id") % 3 % 2).cast("int").alias("y"))
    pairs = many.where("y = 1").alias("p").crossJoin(many.where("y = 0").alias("n"))
    share = pairs.agg(F.avg(F.when(F.col("p.s") > F.col("n.s"), 1.0).when(F.col("p.s") == F.col("n.s"), 0.5).otherwise(0.0))).first()[0]
    assert abs(classify.area_under_roc(many, "y", "s").first()["area"] - share) < 1e-12


def test_index_is_by_frequency(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert rows(classify.string_index(df, "v", "i").distinct()) == [("a", 1.0), ("b", 2.0), ("c", 0.0)]


def test_unknown_categories(spark):
    df = sample(spark)
    other = df.withColumn("colour", F.lit("new"))
    assert classify.fit_features(df, ["colour"], ["size"], unknown="skip").transform(other).count() == 0
    kept = classify.fit_features(df, ["colour"], ["size"], unknown="keep").transform(other)
    assert len(kept.first()["features"]) == 4


def runs(spark):
    return spark.createDataFrame(
        [
            ("p", 1, "FAILED", "e1", "2024-01-01 00:00:00"), ("p", 2, "SUCCESS", None, "2024-01-02 00:00:00"),
            ("q", 1, "SUCCESS", None, "2024-01-01 00:00:00"), ("q", 2, "FAILED", "e2", "2024-01-03 00:00:00"),
        ],
        "name string, attempt int, status string, error string, begun string",
    ).withColumn("begun", F.col("begun").cast("timestamp_ntz"))


def test_latest_and_gate(spark):
    latest = history.latest_attempt(runs(spark), "name", "attempt")
    assert rows(latest.select("name", "status")) == [("p", "SUCCESS"), ("q", "FAILED")]
    assert history.all_success(latest, "status").first()[0] is False
    assert history.all_success(latest.where("name = 'p'"), "status").first()[0] is True
    assert history.all_success(latest.limit(0), "status").first()[0] is False


def test_rollup_and_pending(spark):
    df = runs(spark)
    assert rows(history.job_rollup(df, "name", "status", "attempt", "error")) == [("p", "FAILED", "e1", 2), ("q", "FAILED", "e2", 2)]
    tables = spark.createDataFrame([("p",), ("q",), ("r",)], "name string")
    assert rows(history.pending_tables(tables, df, ["name"], "status", [F.col("begun").desc()])) == [("q", "FAILED"), ("r", None)]


def test_windows(spark):
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    inc = history.next_window(runs(spark), "name", "begun", now)
    full = history.next_window(runs(spark), "name", "begun", now, full=True)
    assert str(inc.where("name = 'p'").first()["window_begin"]) == "2024-01-01 14:00:00"
    assert str(full.where("name = 'p'").first()["window_begin"]) == "1900-01-01 00:00:00"
