import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import ranges
from tidemark.ml import classify


def sample(spark, n=400):
    data = [(i, "abc"[i % 3], ["x", "y", None][i % 3] if i % 7 else "x", float(i % 11), float((i * 37) % 101), float((i * i) % 13 > 5)) for i in range(n)]
    return spark.createDataFrame(data, "id int, c string, e string, u double, v double, label double")


def test_scores_by_table_equal_the_fitted_model(spark):
    df = sample(spark).select("id", "c", "u", "v", "label")
    features = classify.fit_features(df, ["c"], ["u", "v"]).transform(df)
    model = classify.logistic().fit(features)
    weights = classify.coefficients(model, classify.feature_names(features), features)
    fitted = {r.id: (r.prediction, r.probability_1) for r in classify.score(model, features, ["id"]).collect()}
    by_table = {r.id: (r.prediction, r.probability_1) for r in classify.score_by_table(df, weights, "id", ["c"], ["u", "v"]).collect()}
    assert fitted.keys() == by_table.keys()
    for i, (prediction, p) in fitted.items():
        assert by_table[i][0] == prediction and by_table[i][1] == pytest.approx(p, abs=1e-9)


def test_nulls_zeros_and_unknown_features_count_nothing(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", 0.0), (3, "new", 2.0)], "id int, c string, u double")
    weights = spark.createDataFrame([("c_vector_x", 1.0), ("u", 0.5), ("other", 7.0)], "feature string, weight double")
    out = {r.id: r.probability_1 for r in classify.score_by_table(df, weights, "id", ["c"], ["u"]).collect()}
    one = pytest.approx(0.7310585786300049)
    assert out == {1: 0.5, 2: one, 3: one}
    assert classify.score_by_table(df.limit(0), weights, "id", ["c"], ["u"]).collect() == []


@pytest.mark.parametrize("split", [False, True])
def test_area_under_pr_is_the_evaluators(spark, monkeypatch, split):
    if split:
        monkeypatch.setattr(ranges, "ROWS_PER_BUCKET", 9)
    df = sample(spark).select(F.col("v").alias("s"), "label")
    expected = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="label", metricName="areaUnderPR", numBins=0).evaluate(df)
    assert classify.area_under_pr(df, "label", "s").first()["area"] == pytest.approx(expected, abs=1e-12)


def test_area_under_pr_without_positives(spark):
    df = sample(spark).select(F.col("v").alias("s"), F.lit(0.0).alias("label"))
    assert classify.area_under_pr(df, "label", "s").first()["area"] is None


def test_folds_and_areas_do_not_depend_on_the_partitioning(spark):
    df = sample(spark, 300).select("id", "c", "u", "v", "label")
    features = classify.fit_features(df, ["c"], ["u", "v"]).transform(df)
    grid = {"regParam": [0.01, 0.5]}
    found = []
    for n in (1, 16):
        dealt = features.repartition(n, F.rand(n))
        found.append(classify.cross_validate(classify.logistic(), dealt, grid, folds=3, key="id").avgMetrics)
    assert found[0] == pytest.approx(found[1], abs=1e-9)
    folds = lambda d: rows(classify.with_fold(d, "id", 3).select("id", classify.FOLD))
    assert folds(features.repartition(1)) == folds(features.repartition(7))
    assert {f for _, f in folds(features)} == {0, 1, 2}
