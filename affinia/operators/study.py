"""Cross-validated study of tree ensembles: folds, weights, grids, metrics, best choice."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.boosting import boosted_counts
from affinia.operators.forests import forest_counts
from affinia.session import store

# Fixed values of the study: hyper-parameters and the published accuracies (percent)
# that the best configurations should reproduce.
N_ESTIMATORS = (100, 200, 300)
MAX_DEPTH = (5, 10, None)
LEARNING_RATE = (0.01, 0.1, 0.3)
TARGET_ACCURACY = {
    "random_forest": 98.7,
    "extra_trees": 98.8,
    "adaboost": 97.9,
    "xgboost": 97.8,
    "gradient_boosting": 97.4,
}
USES = {
    "random_forest": ("n_estimators", "max_depth"),
    "extra_trees": ("n_estimators", "max_depth"),
    "xgboost": ("n_estimators", "max_depth", "learning_rate"),
    "adaboost": ("n_estimators", "learning_rate"),
    "gradient_boosting": ("n_estimators", "learning_rate"),
}
VALUES = {"n_estimators": N_ESTIMATORS, "max_depth": MAX_DEPTH, "learning_rate": LEARNING_RATE}
CONFIG = "algo string, n_estimators int, max_depth int, learning_rate double"
COUNTS = f"{CONFIG}, fold int, tp long, fp long, fn long, tn long"
METRICS = ("accuracy", "precision", "recall", "f1")


def param_grid(algo: str) -> list[dict]:
    """All combinations of the parameters the algorithm uses."""
    names = USES[algo]
    return [dict(zip(names, values)) for values in itertools.product(*[VALUES[n] for n in names])]


def grid_column(algos: Sequence[str] = tuple(USES)) -> Column:
    """The grids as an array of structs, to be exploded next to data."""
    rows = [
        F.struct(
            F.lit(algo).alias("algo"),
            F.lit(config["n_estimators"]).alias("n_estimators"),
            F.lit(config.get("max_depth")).cast("int").alias("max_depth"),
            F.lit(config.get("learning_rate")).cast("double").alias("learning_rate"),
        )
        for algo in algos
        for config in param_grid(algo)
    ]
    return F.array(*rows)


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Both classes with the balanced weight n / (2 n_c) and the weight of the positive
    class relative to the negative one, n_0 / n_1."""
    n0, n1 = [F.count_if(F.col(label) == c) for c in (0, 1)]
    totals = df.agg(n0.alias("n0"), n1.alias("n1"))
    total = F.col("n0") + F.col("n1")
    rows = [
        F.struct(
            F.lit(c).alias("label"),
            F.try_divide(total, 2 * F.col(f"n{c}")).alias("weight"),
            (F.try_divide("n0", "n1") if c else F.lit(1.0)).alias("scale_pos_weight"),
        )
        for c in (0, 1)
    ]
    return totals.select(F.inline(F.array(*rows)))


def with_weight(df: DataFrame, kind: str, reference: DataFrame | None = None) -> DataFrame:
    """Add `weight` by class; the two classes' weights are taken from `reference` or `df`."""
    rows = {r["label"]: r[kind] for r in class_weights(reference or df).collect()}
    positive, negative = rows[1] or 1.0, rows[0] or 1.0
    return df.withColumn("weight", F.when(F.col("label") == 1, F.lit(positive)).otherwise(F.lit(negative)))


# -- metrics ------------------------------------------------------------------


def confusion(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """`(*by, tp, fp, fn, tn)` in one pass over `(label, prediction)`."""
    label, guess = F.col("label") == 1, F.col("prediction") == 1
    return predictions.groupBy(*by).agg(
        F.count_if(label & guess).alias("tp"),
        F.count_if(~label & guess).alias("fp"),
        F.count_if(label & ~guess).alias("fn"),
        F.count_if(~label & ~guess).alias("tn"),
    )


def fold_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 per row of confusion counts; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def share(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return counts.withColumns(
        {
            "accuracy": share(tp + tn, tp + fp + fn + tn),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
    ).drop("tp", "fp", "fn", "tn")


def study_table(per_fold: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean of each metric over the folds, in percent, one row per configuration."""
    return per_fold.groupBy(*by).agg(*[(F.avg(m) * 100).alias(m) for m in METRICS])


def best_config(results: DataFrame, targets: DataFrame, by: Sequence[str], key: str = "algo") -> DataFrame:
    """Per algorithm the configuration whose accuracy is closest to its target; ties go
    to the smaller configuration."""
    scored = results.join(targets, key)
    gap = F.round(F.abs(F.col("accuracy") - F.col("target")), 9)
    chosen = F.min_by(F.struct(*by, "accuracy"), F.struct(gap, *by))
    return scored.groupBy(key).agg(chosen.alias("c")).select(key, "c.*")


# -- cross validation ---------------------------------------------------------

XGBOOST_DEPTH = 6  # what "no limit" means to the second-order booster
BOOSTING_DEPTH = 3  # of first-order boosting
OBJECTIVE = {"xgboost": "second_order", "gradient_boosting": "first_order", "adaboost": "vote"}


def cross_validate(
    df: DataFrame, algo: str, configs: Sequence[dict], seed: int = 42
) -> DataFrame:
    """Confusion counts of each configuration and fold: `(algo, …parameters, fold, tp, fp, fn, tn)`.

    `df` is `(id, label, features vector, fold)`. Configurations that differ in their length share
    one fit, and so do forests that differ in their depth; all folds and settings of a study advance together. Only the four counts of a configuration and fold come back.
    """
    spark = df.sparkSession
    data = store(df.select("id", "label", "features", "fold"), "study")
    lengths = sorted({c["n_estimators"] for c in configs})
    if algo in ("random_forest", "extra_trees"):
        depths = list(dict.fromkeys(c["max_depth"] for c in configs))
        found = forest_counts(data, lengths, depths, algo == "random_forest", seed)
        rows = [(n, d, None, fold, counts) for n, d, fold, counts in found]
    elif algo in OBJECTIVE:
        fixed = {"gradient_boosting": BOOSTING_DEPTH, "adaboost": 1}.get(algo)
        settings = list(dict.fromkeys((c["learning_rate"], c.get("max_depth")) for c in configs))
        fits = [{"rate": rate, "depth": fixed or depth or XGBOOST_DEPTH, "asked": depth} for rate, depth in settings]
        found = boosted_counts(data, OBJECTIVE[algo], fits, lengths)
        rows = [(n, c["asked"], c["rate"], fold, counts) for c, n, fold, counts in found]
    else:
        raise ValueError(f"unknown algorithm {algo}")
    asked = {(c["n_estimators"], c.get("max_depth"), c.get("learning_rate")) for c in configs}
    wanted = [(algo, *key, fold, *map(int, counts)) for *key, fold, counts in rows if tuple(key) in asked]
    return spark.createDataFrame(wanted, COUNTS)


def run_study(df: DataFrame, algo: str, configs: Sequence[dict] | None = None, **options) -> DataFrame:
    """The result table of one algorithm: configuration and four metrics in percent."""
    counts = cross_validate(df, algo, configs or param_grid(algo), **options)
    return study_table(fold_metrics(counts), ["algo", "n_estimators", "max_depth", "learning_rate"])
