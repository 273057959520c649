"""Category encoding and binary classification with Spark ML."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranges import RANGE, ranged, running
from tidemark.functions.sizing import fits_broadcast
from tidemark.operators.joins import lookup_join
from tidemark.operators.keys import number_rows
from tidemark.session import materialize

# The searched settings.
LOGISTIC_GRID = {"regParam": [0.01, 0.5, 2.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [1, 5, 10]}
TREE_GRID = {"maxDepth": [1, 2, 6, 10], "maxBins": [20, 40, 80]}
FOREST_GRID = {"maxDepth": [2, 4, 6], "maxBins": [20, 60], "numTrees": [5, 20]}


def string_index(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Index categories by descending frequency, ties in alphabetical order; rows without one drop out.

    The categories stay a table that is joined, whatever their number.
    """
    known = df.where(F.col(column).isNotNull())
    counted = materialize(known.groupBy(column).agg((-F.count(F.lit(1))).alias("_rank_by")), "categories")
    numbered = number_rows(counted, ["_rank_by", column], "_index", after=-1)
    index = numbered.select(column, F.col("_index").cast("double").alias(alias))
    return lookup_join(df, index, [column], "inner")


def one_hot(df: DataFrame, column: str, index: str, alias: str) -> DataFrame:
    """One-hot vector of the category index, last category dropped."""
    indexed = string_index(df, column, index)
    return OneHotEncoder(inputCols=[index], outputCols=[alias]).fit(indexed).transform(indexed)


def assemble(df: DataFrame, columns: list[str], alias: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=alias).transform(df)


def feature_pipeline(
    categories: list[str], numbers: list[str], label_source: str | None = None, label: str = "label", unknown: str = "error"
) -> Pipeline:
    """Index and one-hot encode categories, index the label, assemble the features.

    A category of ``n`` values gives ``n - 1`` features, the rarest is all
    zeros.  ``unknown`` says what a value does that was not seen in fitting:
    "error", "skip" its row, or "keep" it, in which case it is the one that is
    all zeros and every known value has a feature.  The fitted indexers hold
    the categories, as the vectors have a place for each.
    """
    stages: list = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid=unknown) for c in categories]
    if categories:
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}_index" for c in categories], outputCols=[f"{c}_vector" for c in categories]
            )
        )
    if label_source is not None:
        stages.append(StringIndexer(inputCol=label_source, outputCol=label))
    stages.append(VectorAssembler(inputCols=[*[f"{c}_vector" for c in categories], *numbers], outputCol="features"))
    return Pipeline(stages=stages)


def fit_features(
    df: DataFrame, categories: list[str], numbers: list[str], label_source: str | None = None, unknown: str = "error"
) -> PipelineModel:
    return feature_pipeline(categories, numbers, label_source, unknown=unknown).fit(df)


def hash_split(df: DataFrame, key: str, share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the row key.

    Unlike a random split the membership of a row does not depend on how the
    data is partitioned.
    """
    part = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 4), 16, 10).cast("int")
    limit = int(share * 65536)
    return df.where(part < limit), df.where(part >= limit)


def logistic(label: str = "label", **params) -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol="features", **{"maxIter": 10, **params})


def tree(label: str = "label", **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol="features", **{"maxDepth": 3, **params})


def forest(label: str = "label", **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol="features", **{"seed": 100, **params})


def score(model, df: DataFrame, keep: list[str]) -> DataFrame:
    """Prediction and probability of class 1, with the chosen input columns."""
    scored = model.transform(df).withColumn("probability_1", vector_to_array("probability")[1])
    return scored.select(*keep, "prediction", "probability_1")


def evaluate(scored: DataFrame, label: str = "label", raw: str = "rawPrediction") -> dict[str, float]:
    """Areas under the ROC and the precision-recall curve."""
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, numBins=0)
    return {m: evaluator.setMetricName(m).evaluate(scored) for m in ("areaUnderROC", "areaUnderPR")}


FOLD = "_fold"


def with_fold(df: DataFrame, key: str, folds: int = 5, alias: str = FOLD) -> DataFrame:
    """A fold number from 0 by a hash of the row key (other digits than :func:`hash_split` takes)."""
    return df.withColumn(alias, (F.conv(F.substring(F.md5(F.col(key).cast("string")), 5, 7), 16, 10).cast("int") % folds).cast("int"))


def settings(estimator: Estimator, grid: dict[str, list]) -> list:
    """Every combination of the grid's values."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def cross_validate(
    estimator: Estimator, train: DataFrame, grid: dict[str, list], folds: int = 5, parallelism: int = 4, label: str = "label", key: str | None = None
) -> CrossValidatorModel:
    """Search the grid with k folds; the best setting is refitted on all rows.

    With a ``key`` a row's fold follows from it, so it is the same however the
    rows are partitioned and whichever task is run again.  Without one the
    folds are drawn, and depend on the partitioning.
    """
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=settings(estimator, grid),
        evaluator=BinaryClassificationEvaluator(labelCol=label, numBins=0),
        numFolds=folds,
        parallelism=parallelism,
        seed=100,
    )
    return search.fit(train) if key is None else search.setFoldCol(FOLD).fit(with_fold(train, key, folds))


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the assembled features, in vector order."""
    attributes = df.schema[column].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for group in attributes.values() for a in group), key=lambda a: a["idx"])]


def coefficients(model, features: list[str], df: DataFrame) -> DataFrame:
    """One row per feature with its weight, and one for the intercept."""
    weights = [(n, float(w)) for n, w in zip(features, model.coefficients)]
    return df.sparkSession.createDataFrame([*weights, ("(intercept)", float(model.intercept))], "feature string, weight double")


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if fits_broadcast(rows) else rows


def roc(scored: DataFrame, label: str = "label", score_column: str = "probability_1") -> DataFrame:
    """The ROC curve as rows, ``FPR, TPR``: a point for each distinct score and the origin.

    The distinct scores are cut into ordered ranges; sums run within a range
    and start from the totals of the ranges before it, so no task sorts all
    scores.
    """
    # rising with falling scores
    scored = scored.select((-F.col(score_column)).alias("_s"), (F.col(label) == 1).alias("_y"))
    counted = scored.groupBy("_s").agg(F.count_if("_y").alias("_p"), F.count_if(~F.col("_y")).alias("_n"))
    counted = materialize(counted, "roc-scores")
    cut = ranged(counted, ["_s"], written=True)
    cut = counted.withColumn(RANGE, F.lit(0).cast("long")) if cut is None else cut
    before = running(cut.groupBy(RANGE).agg(F.sum("_p").alias("_tp"), F.sum("_n").alias("_tn")), {"_tp": "_bp", "_tn": "_bn"})
    within = Window.partitionBy(RANGE).orderBy("_s")
    summed = cut.withColumn("_p", F.sum("_p").over(within)).withColumn("_n", F.sum("_n").over(within)).join(_small(before), RANGE)
    whole = counted.agg(F.sum("_p").alias("_all_p"), F.sum("_n").alias("_all_n"))
    points = summed.crossJoin(F.broadcast(whole)).select(
        ((F.col("_n") + F.col("_bn")) / F.col("_all_n")).alias("FPR"), ((F.col("_p") + F.col("_bp")) / F.col("_all_p")).alias("TPR")
    )
    origin = scored.sparkSession.createDataFrame([(0.0, 0.0)], "FPR double, TPR double")
    return origin.unionByName(points)


def area_under_roc(scored: DataFrame, label: str = "label", score_column: str = "probability_1") -> DataFrame:
    """One row, ``area``: the share of (positive, negative) pairs that are in order, ties counted half."""
    counted = scored.groupBy(score_column).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n"))
    counted = materialize(counted.select(F.col(score_column).alias("_s"), "_p", "_n"), "roc-scores")
    cut = ranged(counted, ["_s"], written=True)
    cut = counted.withColumn(RANGE, F.lit(0).cast("long")) if cut is None else cut
    before = running(cut.groupBy(RANGE).agg(F.sum("_n").alias("_t")), {"_t": "_b"})
    below = (F.sum("_n").over(Window.partitionBy(RANGE).orderBy("_s")) + F.col("_b") - F.col("_n")).alias("_below")
    joined = cut.join(_small(before), RANGE).select("_p", "_n", below)
    twice = F.sum(F.col("_p") * (2 * F.col("_below") + F.col("_n")))
    return joined.agg((twice / (2 * F.sum("_p") * F.sum("_n"))).alias("area"))


def area_under_pr(scored: DataFrame, label: str = "label", score_column: str = "probability_1") -> DataFrame:
    """One row, ``area``: under the precision-recall curve, with straight lines between its points.

    The curve has a point for each distinct score, from the highest down, and
    begins at recall 0 with the first point's precision.  A point's share of
    the area follows from its own counts and the sums before it, which run
    within ordered ranges.  Without a positive row the area is null.
    """
    counted = scored.select((-F.col(score_column)).alias("_s"), (F.col(label) == 1).alias("_y"))
    counted = materialize(counted.groupBy("_s").agg(F.count_if("_y").alias("_p"), F.count_if(~F.col("_y")).alias("_n")), "pr-scores")
    cut = ranged(counted, ["_s"], written=True)
    cut = counted.withColumn(RANGE, F.lit(0).cast("long")) if cut is None else cut
    before = running(cut.groupBy(RANGE).agg(F.sum("_p").alias("_tp"), F.sum("_n").alias("_tn")), {"_tp": "_bp", "_tn": "_bn"})
    within = Window.partitionBy(RANGE).orderBy("_s")
    summed = cut.withColumns({"_up": F.sum("_p").over(within), "_un": F.sum("_n").over(within)}).join(_small(before), RANGE)
    hits, all_ = F.col("_up") + F.col("_bp"), F.col("_up") + F.col("_bp") + F.col("_un") + F.col("_bn")
    now = hits / all_
    earlier = F.coalesce(F.try_divide(hits - F.col("_p"), all_ - F.col("_p") - F.col("_n")), now)
    return summed.agg(F.try_divide(F.sum(F.col("_p") * (now + earlier)), 2 * F.sum("_p")).alias("area"))


INTERCEPT = "(intercept)"


def long_features(df: DataFrame, key: str, categories: list[str], numbers: list[str]) -> DataFrame:
    """``key, feature, value``: a row for each feature that is not zero, named as :func:`feature_names` has them.

    A null category or number has no row, as if it were the category or the
    number that is zero.
    """
    values = [F.struct(F.concat(F.lit(f"{c}_vector_"), F.col(c).cast("string")).alias("feature"), F.lit(1.0).alias("value")) for c in categories]
    values += [F.struct(F.lit(n).alias("feature"), F.col(n).cast("double").alias("value")) for n in numbers]
    rows = df.select(key, F.explode(F.array(*values)).alias("_f")).select(key, "_f.feature", "_f.value")
    return rows.where("feature IS NOT NULL AND value IS NOT NULL AND value <> 0")


def score_by_table(df: DataFrame, weights: DataFrame, key: str, categories: list[str], numbers: list[str], keep: list[str] = ()) -> DataFrame:
    """Logistic scores of a model that is a table ``feature, weight``: ``key, *keep, prediction, probability_1``.

    The margin is a join of the features with the weights and a sum per key; a
    feature without a weight counts nothing, so does a weight without a
    feature.  The model may have more features than one task or the driver
    holds.  ``key`` must be unique.
    """
    weighed = long_features(df, key, categories, numbers).join(_small(weights.where(F.col("feature") != INTERCEPT)), "feature")
    sums = weighed.groupBy(key).agg(F.sum(F.col("value") * F.col("weight")).alias("_sum"))
    constant = weights.where(F.col("feature") == INTERCEPT).agg(F.coalesce(F.sum("weight"), F.lit(0.0))).scalar()
    margin = F.coalesce(F.col("_sum"), F.lit(0.0)) + constant
    scored = df.select(key, *keep).join(sums, key, "left").withColumn("probability_1", 1 / (1 + F.exp(-margin)))
    return scored.select(key, *keep, (F.col("probability_1") > 0.5).cast("double").alias("prediction"), "probability_1")


def tree_summary(model, df: DataFrame) -> DataFrame:
    """Node count, depth and impurity of a fitted decision tree."""
    row = (int(model.numNodes), int(model.depth), model.getImpurity())
    return df.sparkSession.createDataFrame([row], "num_nodes int, depth int, impurity string")
