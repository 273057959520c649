"""Category encoding and classification queries over customers and labelled documents."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.ml import classify
from tidemark.operators.joins import lookup_join
from tidemark.session import materialize
from tidemark.workload.registry import query, read

CATEGORIES = ["lang", "source"]
NUMBERS = ["n_chars", "n_words", "n_lines", "digit_share"]


def _labelled(spark, d):
    """Documents with a quality label and simple measures of their whole text."""
    documents = read(spark, d, "documents")
    text = F.col("text")
    measured = documents.select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(text, r"\s+")).cast("double").alias("n_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        (F.length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(F.length(text), F.lit(1))).alias("digit_share"),
    )
    labels = read(spark, d, "labels").select("doc_id", "quality")
    return lookup_join(measured, labels, ["doc_id"], "inner")


def _prepared(spark, d):
    """Feature vectors, measured from the texts once and written for the fits that follow."""
    rows = materialize(_labelled(spark, d).withColumn("label", F.col("quality").cast("double")), "measures")
    return materialize(classify.fit_features(rows, CATEGORIES, NUMBERS).transform(rows), "features")


def _split(spark, d):
    return classify.hash_split(_prepared(spark, d), "doc_id")


def _scored(spark, d):
    documents = read(spark, d, "documents").select("doc_id", F.col("n_chars").alias("s"))
    return lookup_join(documents, read(spark, d, "labels").select("doc_id", F.col("quality").alias("y")), ["doc_id"], "inner")


def _searched(spark, d, estimator, grid):
    """Every setting of the grid with its mean area over five folds."""
    train, _ = _split(spark, d)
    searched = classify.cross_validate(estimator, train.cache(), grid, key="doc_id")
    train.unpersist()
    rows = [
        (str(dict(sorted((p.name, float(v)) for p, v in setting.items()))), float(area))
        for setting, area in zip(searched.getEstimatorParamMaps(), searched.avgMetrics)
    ]
    return spark.createDataFrame(rows, "setting string, area_under_roc double")


def _fit_on_train(spark, d, estimator):
    """The model fitted on the training rows, and all rows to score."""
    rows = _prepared(spark, d)
    return estimator.fit(classify.hash_split(rows, "doc_id")[0]), rows


_SEGMENTS = """
ranked AS (
  SELECT c_mktsegment AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS idx
  FROM customer GROUP BY c_mktsegment)
"""


@query(f"WITH {_SEGMENTS} SELECT c_custkey, c_mktsegment, idx AS segment_index FROM customer JOIN ranked ON c_mktsegment = v")
def ml_string_index(spark, d):
    customers = read(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return classify.string_index(customers, "c_mktsegment", "segment_index")


@query(f"""
WITH {_SEGMENTS}
SELECT c_custkey, CAST(p.pos AS INTEGER) AS pos, CASE WHEN idx = p.pos THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM customer JOIN ranked ON c_mktsegment = v, (SELECT unnest(range((SELECT count(*) - 1 FROM ranked))) AS pos) p
""")
def ml_one_hot(spark, d):
    customers = read(spark, d, "customer").select("c_custkey", "c_mktsegment")
    coded = classify.one_hot(customers, "c_mktsegment", "segment_index", "segment")
    return coded.select("c_custkey", F.posexplode(vector_to_array("segment")).alias("pos", "value"))


@query("""
SELECT p_partkey, CAST(0 AS INTEGER) AS pos, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 1, p_retailprice FROM part
""")
def ml_assemble(spark, d):
    vectors = classify.assemble(read(spark, d, "part"), ["p_size", "p_retailprice"])
    return vectors.select("p_partkey", F.posexplode(vector_to_array("features")).alias("pos", "value"))


@query("""
SELECT doc_id, CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 4) AS INTEGER) < 45875 THEN 'train' ELSE 'test' END AS part
FROM documents
""")
def ml_split(spark, d):
    train, test = classify.hash_split(read(spark, d, "documents").select("doc_id"), "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(r"""
WITH rows AS (SELECT d.*, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
ranked AS (
  SELECT quality, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(quality AS VARCHAR)) - 1 AS DOUBLE) AS label
  FROM rows GROUP BY quality)
SELECT doc_id, label,
       CAST((SELECT count(DISTINCT lang) - 1 + count(DISTINCT source) - 1 + 4 FROM rows) AS INTEGER) AS n_features,
       CAST(lang <> (SELECT lang FROM rows GROUP BY lang ORDER BY count(*), lang DESC LIMIT 1) AS DOUBLE)
         + CAST(source <> (SELECT source FROM rows GROUP BY source ORDER BY count(*), source DESC LIMIT 1) AS DOUBLE) + n_chars + len(regexp_split_to_array(text, '\s+')) + len(string_split(text, chr(10)))
         + CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) / greatest(length(text), 1) AS feature_sum
FROM rows JOIN ranked USING (quality)
""")
def ml_fit_transform(spark, d):
    rows = materialize(_labelled(spark, d), "measures")
    model = classify.fit_features(rows, CATEGORIES, NUMBERS, label_source="quality")
    vectors = model.transform(rows).withColumn("vector", vector_to_array("features"))
    return vectors.select("doc_id", "label", F.size("vector").alias("n_features"), F.aggregate("vector", F.lit(0.0), lambda a, b: a + b).alias("feature_sum"))


@query()
def ml_logreg(spark, d):
    train, test = _split(spark, d)
    return classify.score(classify.logistic().fit(train), test, ["doc_id", "label"])


@query()
def ml_tree(spark, d):
    train, _ = _split(spark, d)
    return classify.tree_summary(classify.tree().fit(train), train)


@query()
def ml_forest(spark, d):
    train, test = _split(spark, d)
    return classify.score(classify.forest().fit(train), test, ["doc_id", "label"])


@query()
def ml_predict(spark, d):
    model, rows = _fit_on_train(spark, d, classify.forest())
    return classify.score(model, rows, ["doc_id", "lang", "source"])


@query()
def ml_evaluate(spark, d):
    train, test = _split(spark, d)
    areas = classify.evaluate(classify.logistic().fit(train).transform(test))
    return spark.createDataFrame(list(areas.items()), "metric string, value double")


@query()
def ml_cross_validate(spark, d):
    return _searched(spark, d, classify.logistic(), classify.LOGISTIC_GRID)


@query()
def ml_cross_validate_tree(spark, d):
    return _searched(spark, d, classify.tree(), classify.TREE_GRID)


@query()
def ml_cross_validate_forest(spark, d):
    return _searched(spark, d, classify.forest(), classify.FOREST_GRID)


@query()
def ml_roc(spark, d):
    train, _ = _split(spark, d)
    return classify.roc(classify.score(classify.logistic().fit(train), train, ["label"]))


_SCORED = "scored AS (SELECT n_chars AS s, quality AS y FROM documents JOIN labels USING (doc_id))"


@query(f"""
WITH {_SCORED}, totals AS (SELECT count(*) FILTER (y = 1) AS p, count(*) FILTER (y <> 1) AS n FROM scored)
SELECT 0.0::DOUBLE AS "FPR", 0.0::DOUBLE AS "TPR"
UNION ALL
SELECT sum(count(*) FILTER (y <> 1)) OVER falling / any_value(n)::DOUBLE, sum(count(*) FILTER (y = 1)) OVER falling / any_value(p)::DOUBLE
FROM scored, totals GROUP BY s WINDOW falling AS (ORDER BY s DESC)
""")
def ml_roc_points(spark, d):
    """The curve of a given score, here the number of characters."""
    return classify.roc(_scored(spark, d), "y", "s")


@query(f"""
WITH {_SCORED}, ranked AS (
  SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r FROM scored)
SELECT (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE)
       / (count(*) FILTER (y = 1) * count(*) FILTER (y <> 1)) AS area
FROM ranked
""")
def ml_area_under_roc(spark, d):
    """The area by the rank formula."""
    return classify.area_under_roc(_scored(spark, d), "y", "s")


@query()
def ml_coefficients(spark, d):
    train, _ = _split(spark, d)
    return classify.coefficients(classify.logistic().fit(train), classify.feature_names(train), train)


@query()
def ml_prediction_counts(spark, d):
    model, rows = _fit_on_train(spark, d, classify.forest())
    scored = classify.score(model, rows, ["lang"])
    return scored.groupBy("lang", "prediction").agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "prediction")


@query(f"""
WITH {_SCORED}, points AS (
  SELECT s, count(*) FILTER (y = 1) AS p, sum(count(*) FILTER (y = 1)) OVER falling AS tp, sum(count(*)) OVER falling AS seen
  FROM scored GROUP BY s WINDOW falling AS (ORDER BY s DESC)),
steps AS (
  SELECT p, tp / seen::DOUBLE AS now, lag(tp / seen::DOUBLE) OVER (ORDER BY s DESC) AS earlier FROM points)
SELECT round(sum(p * (now + coalesce(earlier, now))) / (2 * sum(p)), 9) AS area FROM steps
""")
def ml_area_under_pr(spark, d):
    """Precision and recall of a given score, here the number of characters."""
    return classify.area_under_pr(_scored(spark, d), "y", "s").select(F.round("area", 9).alias("area"))


@query("""
WITH train AS (
  SELECT CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 5, 7) AS INTEGER) % 5 AS fold FROM labels JOIN documents USING (doc_id)
  WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 4) AS INTEGER) < 45875),
grid AS (
  SELECT r.v AS "regParam", e.v AS "elasticNetParam", m.v AS "maxIter"
  FROM (VALUES (0.01), (0.5), (2.0)) r(v), (VALUES (0.0), (0.5), (1.0)) e(v), (VALUES (1.0), (5.0), (10.0)) m(v))
SELECT CAST("regParam" AS DOUBLE) AS "regParam", CAST("elasticNetParam" AS DOUBLE) AS "elasticNetParam", CAST("maxIter" AS DOUBLE) AS "maxIter",
       fold, count(*) AS n_valid, (SELECT count(*) FROM train) - count(*) AS n_train
FROM grid, train GROUP BY ALL
""")
def ml_folds(spark, d):
    """The fits of the logistic search: every setting with the rows that each fold is fitted on and judged by."""
    rows = lookup_join(read(spark, d, "documents").select("doc_id"), read(spark, d, "labels").select("doc_id"), ["doc_id"], "inner")
    folds = classify.with_fold(classify.hash_split(rows, "doc_id")[0], "doc_id").groupBy(F.col(classify.FOLD).alias("fold")).agg(F.count(F.lit(1)).alias("n_valid"))
    folds = materialize(folds, "folds")
    whole = folds.agg(F.sum("n_valid")).scalar()
    grid = [{p.name: float(v) for p, v in setting.items()} for setting in classify.settings(classify.logistic(), classify.LOGISTIC_GRID)]
    settings = spark.createDataFrame([(g["regParam"], g["elasticNetParam"], g["maxIter"]) for g in grid], "regParam double, elasticNetParam double, maxIter double")
    return settings.crossJoin(folds.withColumn("n_train", whole - F.col("n_valid")))


# A model as a table.
_WEIGHTS = [
    ("(intercept)", -0.4), ("lang_vector_en", 0.35), ("lang_vector_de", -0.2), ("source_vector_src0", 0.15), ("source_vector_src1", -0.6),
    ("n_chars", 0.0001), ("n_words", -0.0004), ("n_lines", 0.002), ("digit_share", -3.5), ("never_seen", 9.0),
]
_MODEL_SQL = r"""
WITH weights(feature, weight) AS (VALUES """ + ", ".join(f"('{f}', CAST({w} AS DOUBLE))" for f, w in _WEIGHTS) + r"""),
measured AS (
  SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars, CAST(len(regexp_split_to_array(text, '\s+')) AS DOUBLE) AS n_words,
         CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines,
         CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) / greatest(length(text), 1) AS digit_share
  FROM documents JOIN labels USING (doc_id)),
features AS (
  SELECT doc_id, 'lang_vector_' || lang AS feature, 1.0::DOUBLE AS value FROM measured
  UNION ALL SELECT doc_id, 'source_vector_' || source, 1.0 FROM measured
  UNION ALL SELECT doc_id, 'n_chars', n_chars FROM measured UNION ALL SELECT doc_id, 'n_words', n_words FROM measured
  UNION ALL SELECT doc_id, 'n_lines', n_lines FROM measured UNION ALL SELECT doc_id, 'digit_share', digit_share FROM measured),
sums AS (SELECT doc_id, sum(value * weight) AS m FROM features JOIN weights USING (feature) GROUP BY doc_id),
scored AS (
  SELECT doc_id, lang, source, 1 / (1 + exp(-(coalesce(m, 0) + (SELECT weight FROM weights WHERE feature = '(intercept)')))) AS p
  FROM measured LEFT JOIN sums USING (doc_id))
"""


def _scored_by_table(spark, d):
    rows = materialize(_labelled(spark, d), "measures")
    weights = spark.createDataFrame(_WEIGHTS, "feature string, weight double")
    return classify.score_by_table(rows, weights, "doc_id", CATEGORIES, NUMBERS, ["lang", "source"])


@query(_MODEL_SQL + "SELECT doc_id, lang, source, CAST(p > 0.5 AS DOUBLE) AS prediction, round(p, 9) AS probability_1 FROM scored")
def ml_score_table(spark, d):
    """Scores of a model whose coefficients are rows."""
    return _scored_by_table(spark, d).withColumn("probability_1", F.round("probability_1", 9))


@query(_MODEL_SQL + "SELECT lang, CAST(p > 0.5 AS DOUBLE) AS prediction, count(*) AS n FROM scored GROUP BY ALL")
def ml_table_prediction_counts(spark, d):
    return _scored_by_table(spark, d).groupBy("lang", "prediction").agg(F.count(F.lit(1)).alias("n"))
