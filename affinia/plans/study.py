"""Queries of the classifier study over labelled documents."""

from __future__ import annotations

import functools

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.operators import study
from affinia.operators.ensembles import boost_round
from affinia.operators.sampling import stratified_folds
from affinia.plans.tables import table
from affinia.session import store

THRESHOLDS = (100, 200, 300, 500, 1000, 2000)


def _labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"), "toxic")


def class_distribution(spark, sf_dir):
    return study.class_distribution(_labels(spark, sf_dir))


def class_weights(spark, sf_dir):
    weights = study.class_weights(_labels(spark, sf_dir))
    return weights.withColumns({c: F.round(c, 9) for c in ("weight", "scale_pos_weight")})


def _folded(spark, sf_dir, folds=10):
    return stratified_folds(_labels(spark, sf_dir), "doc_id", "label", folds)


def folds(spark, sf_dir):
    return _folded(spark, sf_dir).select("doc_id", "label", "fold")


def study_plan(spark, sf_dir):
    """Every fit of the full study: configuration, fold, rows to train and test on, positive weight."""
    counts = _folded(spark, sf_dir).groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))
    here = F.col("fold") == F.col("test_fold")
    per_fold = (
        counts.withColumn("test_fold", F.explode(F.sequence(F.lit(0), F.lit(9))))
        .groupBy("test_fold")
        .agg(
            F.sum(F.when(~here, F.col("n")).otherwise(0)).alias("n_train"),
            F.sum(F.when(here, F.col("n")).otherwise(0)).alias("n_test"),
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"),
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
        )
    )
    fits = per_fold.select("*", F.inline(study.grid_column()))
    weight = F.when(F.col("algo") == "xgboost", F.round(F.try_divide("n0", "n1"), 9))
    return fits.select(
        "algo", "n_estimators", "max_depth", "learning_rate", F.col("test_fold").alias("fold"),
        "n_train", "n_test", weight.alias("scale_pos_weight"),
    )


def _given_predictions(spark, sf_dir):
    return _folded(spark, sf_dir).withColumn("prediction", 1 - F.col("toxic"))


def cv_metrics(spark, sf_dir):
    per_fold = study.fold_metrics(study.confusion(_given_predictions(spark, sf_dir), ["fold"]))
    return per_fold.withColumns({m: F.round(m, 9) for m in study.METRICS})


def cv_best_config(spark, sf_dir):
    """Length rules as classifiers: the threshold whose accuracy is closest to a target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rules = F.array(
        *[
            F.struct(F.lit(rule).alias("algo"), F.lit(t).alias("threshold"))
            for rule in ("longer", "shorter")
            for t in THRESHOLDS
        ]
    )
    longer = F.col("n_chars") >= F.col("threshold")
    guesses = (
        _folded(spark, sf_dir)
        .join(docs, "doc_id")
        .select("label", "fold", "n_chars", F.inline(rules))
        .withColumn("prediction", F.when(F.col("algo") == "longer", longer).otherwise(~longer).cast("int"))
    )
    per_fold = study.fold_metrics(study.confusion(guesses, ["algo", "threshold", "fold"]))
    results = study.study_table(per_fold, ["algo", "threshold"])
    targets = results.select(
        "algo", F.when(F.col("algo") == "longer", F.lit(80.0)).otherwise(F.lit(30.0)).alias("target")
    ).distinct()
    best = study.best_config(results, targets, ["threshold"])
    return best.withColumn("accuracy", F.round("accuracy", 6))


def adaboost_round(spark, sf_dir):
    """One weight update, from equal weights, on the given predictions."""
    df = _labels(spark, sf_dir).withColumn("weight", F.lit(1.0))
    miss = F.col("label") != 1 - F.col("toxic")
    _, _, weight = boost_round(df, 0.1, miss)
    return df.select("doc_id", F.round(weight, 9).alias("weight"))


def study_frame(spark, sf_dir, folds=10):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    df = _folded(spark, sf_dir, folds).join(docs, "doc_id")
    df = store(df, "labelled")
    kinds = ["lang", "source"]
    numbers, flags = [f"{c}_number" for c in kinds], [f"{c}_flags" for c in kinds]
    df = StringIndexer(inputCols=kinds, outputCols=numbers, stringOrderType="alphabetAsc").fit(df).transform(df)
    df = OneHotEncoder(inputCols=numbers, outputCols=flags, dropLast=False).fit(df).transform(df)
    df = VectorAssembler(inputCols=["n_chars", *flags], outputCol="features").transform(df)
    return df.select(F.col("doc_id").alias("id"), F.col("label").cast("double").alias("label"), "features", "fold")


@functools.cache
def _counted(application, sf_dir, algo):
    """The confusion counts of the whole study of an algorithm, written once a session."""
    spark = SparkSession.active()
    return store(study.cross_validate(study_frame(spark, sf_dir), algo, study.param_grid(algo)), "study_counts")


def counts_of(spark, sf_dir, algo):
    return _counted(spark.sparkContext.applicationId, sf_dir, algo)


def _study_of(algo):
    """All configurations of an algorithm over ten folds: the mean of each metric."""

    def query(spark, sf_dir):
        per_fold = study.fold_metrics(counts_of(spark, sf_dir, algo))
        return study.study_table(per_fold, ["algo", "n_estimators", "max_depth", "learning_rate"])

    return query


def _coverage_of(algo):
    """How many rows each configuration and fold was tested on."""

    def query(spark, sf_dir):
        tested = counts_of(spark, sf_dir, algo).withColumn("n_test", F.expr("tp + fp + fn + tn"))
        return tested.select("algo", "n_estimators", "max_depth", "learning_rate", "fold", "n_test", F.expr("tp + fn").alias("n_positive"))

    return query


def study_best(spark, sf_dir):
    """Of each algorithm the configuration whose accuracy is closest to the published one."""
    tables = [_study_of(algo)(spark, sf_dir) for algo in study.USES]
    results = functools.reduce(DataFrame.unionByName, tables)
    targets = spark.createDataFrame(list(study.TARGET_ACCURACY.items()), "algo string, target double")
    return study.best_config(results, targets, ["n_estimators", "max_depth", "learning_rate"])


FOLDS_SQL = """folded AS (
  SELECT doc_id, quality AS label, toxic, CAST((row_number() OVER (
    PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) - 1) % 10 AS INTEGER) AS fold FROM labels)"""
_METRICS = """{0}, {1},
  coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1"""
_CONFUSION = """count(*) FILTER (label = 1 AND p = 1) AS tp, count(*) FILTER (label = 0 AND p = 1) AS fp,
  count(*) FILTER (label = 1 AND p = 0) AS fn, count(*) FILTER (label = 0 AND p = 0) AS tn"""
_GRID = ", ".join(
    f"('{algo}', {c['n_estimators']}, {c.get('max_depth') or 'NULL'}, {c.get('learning_rate') or 'NULL'})"
    for algo in study.USES
    for c in study.param_grid(algo)
)

NAMES = {
    "random_forest": "random_forest",
    "extra_trees": "extra_trees",
    "weighted_gbt": "xgboost",
    "adaboost": "adaboost",
    "gbt": "gradient_boosting",
}


def _coverage_sql(algo):
    """Fold sizes beside every configuration of the grid."""
    return f"""WITH {FOLDS_SQL},
grid AS (SELECT * FROM (VALUES {_GRID}) g(algo, n_estimators, max_depth, learning_rate) WHERE algo = '{algo}'),
tests AS (SELECT fold, count(*) AS n_test, count(*) FILTER (label = 1) AS n_positive FROM folded GROUP BY 1)
SELECT algo, n_estimators, max_depth, CAST(learning_rate AS DOUBLE) AS learning_rate, fold, n_test, n_positive FROM grid, tests"""


QUERIES = {
    "class_distribution": class_distribution,
    "class_weights": class_weights,
    "stratified_folds": folds,
    "study_plan": study_plan,
    "cv_metrics": cv_metrics,
    "cv_best_config": cv_best_config,
    "adaboost_round": adaboost_round,
    **{f"study_{name}": _study_of(algo) for name, algo in NAMES.items()},
    **{f"study_{name}_tested": _coverage_of(algo) for name, algo in NAMES.items()},
    "study_best": study_best,
}

ORACLES = {
    **{f"study_{name}_tested": _coverage_sql(algo) for name, algo in NAMES.items()},
    "class_distribution": "SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1",
    "class_weights": """WITH c AS (
  SELECT count(*) FILTER (quality = 0) AS n0, count(*) FILTER (quality = 1) AS n1 FROM labels)
SELECT 0 AS label, round((n0 + n1) / (2 * n0), 9) AS weight, 1.0::DOUBLE AS scale_pos_weight FROM c
UNION ALL SELECT 1, round((n0 + n1) / (2 * n1), 9), round(n0 / n1, 9) FROM c""",
    "stratified_folds": f"WITH {FOLDS_SQL} SELECT doc_id, label, fold FROM folded",
    "study_plan": f"""WITH {FOLDS_SQL},
grid AS (SELECT * FROM (VALUES {_GRID}) g(algo, n_estimators, max_depth, learning_rate)),
c AS (SELECT count(*) AS n, count(*) FILTER (label = 0) / count(*) FILTER (label = 1) AS w FROM folded),
tests AS (SELECT fold, count(*) AS n_test FROM folded GROUP BY 1)
SELECT algo, n_estimators, max_depth, CAST(learning_rate AS DOUBLE) AS learning_rate, fold,
  n - n_test AS n_train, n_test, CASE WHEN algo = 'xgboost' THEN round(w, 9) END AS scale_pos_weight
FROM grid, tests, c""",
    "cv_metrics": f"""WITH {FOLDS_SQL},
counts AS (SELECT fold, {_CONFUSION} FROM (SELECT *, 1 - toxic AS p FROM folded) GROUP BY 1),
m AS (SELECT {_METRICS.format("fold", "tp")} FROM counts)
SELECT fold, {", ".join(f"round({x}, 9) AS {x}" for x in study.METRICS)} FROM m""",
    "cv_best_config": f"""WITH {FOLDS_SQL},
guesses AS (
  SELECT algo, threshold, fold, label,
    CASE WHEN algo = 'longer' THEN (n_chars >= threshold)::INT ELSE (n_chars < threshold)::INT END AS p
  FROM folded JOIN documents USING (doc_id), (SELECT unnest(['longer', 'shorter']) AS algo),
    (SELECT CAST(unnest({list(THRESHOLDS)}) AS INTEGER) AS threshold)),
counts AS (SELECT algo, threshold, fold, {_CONFUSION} FROM guesses GROUP BY 1, 2, 3),
m AS (SELECT {_METRICS.format("algo", "threshold")} FROM counts),
mean AS (SELECT algo, threshold, avg(accuracy) * 100 AS accuracy FROM m GROUP BY 1, 2)
SELECT algo, threshold, round(accuracy, 6) AS accuracy FROM (
  SELECT *, row_number() OVER (PARTITION BY algo
    ORDER BY round(abs(accuracy - CASE algo WHEN 'longer' THEN 80 ELSE 30 END), 9), threshold) AS r FROM mean)
WHERE r = 1""",
    "adaboost_round": """WITH p AS (SELECT doc_id, quality <> 1 - toxic AS miss FROM labels),
e AS (SELECT count(*) AS n, count(*) FILTER (miss) / count(*) AS err FROM p),
a AS (SELECT n, err, CASE WHEN err > 0 AND err < 0.5 THEN 0.1 * ln((1 - err) / err) ELSE 0 END AS alpha FROM e)
SELECT doc_id, round(CASE WHEN miss THEN exp(alpha) ELSE 1 END / (n * (1 - err + err * exp(alpha))), 9) AS weight
FROM p, a""",
}
