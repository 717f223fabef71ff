import math
import random
import zlib

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from affinia.operators import boosting, forests, study
from affinia.operators.ensembles import boost_round
from affinia.operators.forests import drawn, forest_counts, poisson, trees_of
from affinia.operators.sampling import stratified_folds


def labelled(spark, n=240, seed=1, binary=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.random() for _ in range(4)]
        if binary:
            x = [float(v > 0.5) for v in x]
        label = float(x[0] + x[1] > 0.9) if rng.random() > 0.05 else float(rng.random() > 0.5)
        rows.append((i, label, Vectors.dense(x)))
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    return stratified_folds(df, "id", "label", 3)


def test_grid_sizes():
    sizes = {algo: len(study.param_grid(algo)) for algo in study.USES}
    assert sizes == {"random_forest": 9, "extra_trees": 9, "xgboost": 27, "adaboost": 9, "gradient_boosting": 9}


def test_stratified_fold_sizes(spark):
    df = spark.range(101).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    sizes = stratified_folds(df, "id", "label").groupBy("label", "fold").count().collect()
    for label, n in ((1, 11), (0, 90)):
        counts = sorted(r["count"] for r in sizes if r["label"] == label)
        assert sum(counts) == n and counts[-1] - counts[0] <= 1


CONFIGS = {
    "random_forest": [{"n_estimators": 10, "max_depth": 4}, {"n_estimators": 10, "max_depth": None}],
    "extra_trees": [{"n_estimators": 10, "max_depth": 4}],
    "xgboost": [{"n_estimators": 4, "max_depth": None, "learning_rate": 0.3}],
    "gradient_boosting": [{"n_estimators": 4, "learning_rate": 0.3}],
    "adaboost": [{"n_estimators": n, "learning_rate": 0.5} for n in (1, 8)],
}


@pytest.mark.parametrize("algo", CONFIGS)
def test_study_learns(spark, algo):
    table = study.run_study(labelled(spark), algo, CONFIGS[algo]).collect()
    assert len(table) == len(CONFIGS[algo])
    for row in table:
        assert row["accuracy"] > (60 if row["n_estimators"] == 1 else 80)
        assert 0 <= row["precision"] <= 100 and 0 <= row["recall"] <= 100


def test_counts_cover_every_row_once(spark):
    counts = study.cross_validate(labelled(spark), "random_forest", CONFIGS["random_forest"][:1])
    assert counts.agg(F.sum(F.expr("tp + fp + fn + tn"))).first()[0] == 240


def counted(found):
    return {tuple(x if not isinstance(x, dict) else tuple(x.items()) for x in key): tuple(counts) for *key, counts in found}


def test_adaboost_equals_a_direct_computation(spark):
    df = labelled(spark, binary=True)
    rows = [(r["features"].toArray(), r["label"], r["fold"]) for r in df.collect()]
    cuts = boosting.cut_points(df)
    booster = boosting.Booster("vote", [boosting.Model(f, 0.5, 1) for f in range(3)], cuts, store_every=2)
    booster.begin(boosting.binned(df, cuts))
    for _ in range(5):
        booster.round()
    for m in range(3):
        train = [(x, y) for x, y, fold in rows if fold != m]
        weight = [1.0] * len(train)
        for turn in range(5):
            tree = booster.trees[turn]
            feature, says = tree.feature[m, 0], booster.says[turn][m]
            side = [int(x[feature] > 0.5) for x, _ in train]
            guess = [tree.value[m, tree.child[m, 0] + s] > 0 for s in side]
            err = sum(w for w, g, (_, y) in zip(weight, guess, train) if g != y) / sum(weight)
            assert says == pytest.approx(0.5 * math.log((1 - err) / err))
            weight = [w * (math.exp(says) if g != y else 1) for w, g, (_, y) in zip(weight, guess, train)]


def second_order_tree(rows, depth, score, rate, positive):
    """The scores after one round, by trying every cut."""
    def grow(members, level):
        g, h = (sum(s[i] for _, s in members) for i in (0, 1))
        best = (0.0, None)
        for f in range(4):
            for cut in sorted({x[f] for x, _ in members})[:-1]:
                left = [m for m in members if m[0][f] <= cut]
                gl, hl = (sum(s[i] for _, s in left) for i in (0, 1))
                gr, hr = g - gl, h - hl
                gain = round(0.5 * (gl**2 / (hl + 1) + gr**2 / (hr + 1) - g**2 / (h + 1)), 9)
                if hl >= 1 and hr >= 1 and gain > best[0]:
                    best = (gain, (f, cut))
        if level == depth or best[1] is None:
            return lambda x: -rate * g / (h + 1)
        f, cut = best[1]
        a, b = (grow([m for m in members if (m[0][f] <= cut) == side], level + 1) for side in (True, False))
        return lambda x: a(x) if x[f] <= cut else b(x)

    members = []
    for x, y, s in rows:
        p, w = 1 / (1 + math.exp(-s)), positive if y == 1 else 1.0
        members.append((x, (w * (p - y), w * p * (1 - p))))
    return grow(members, 0)


def test_second_order_rounds_equal_trying_every_cut(spark):
    df = labelled(spark, n=150).repartition(5)
    rows = [(tuple(r["features"].toArray()), r["label"], r["fold"]) for r in df.collect()]
    n1 = sum(y for _, y, _ in rows)
    positive = (len(rows) - n1) / n1
    cuts = boosting.cut_points(df)
    binned = boosting.binned(df, cuts)
    models = [m for m, _ in boosting.fold_models(binned, "second_order", [{"rate": 0.3, "depth": 3}])]
    assert [m.positive for m in models] == [pytest.approx(positive)] * 3
    booster = boosting.Booster("second_order", models, cuts, store_every=2).begin(binned)
    for _ in range(3):
        booster.round()
    got = booster.scores()
    for m in range(3):
        score = {x: 0.0 for x, _, _ in rows}
        for _ in range(3):
            tree = second_order_tree([(x, y, score[x]) for x, y, fold in rows if fold != m], 3, score, 0.3, positive)
            score = {x: s + tree(x) for x, s in score.items()}
        for x, y, fold in rows:
            bins = bytes(sum(c < v for c in cuts[f]) for f, v in enumerate(x))
            assert got[bins, int(y), fold][m] == pytest.approx(score[x], abs=1e-9)


@pytest.mark.parametrize("objective", ["second_order", "first_order", "vote"])
def test_a_longer_fit_gives_the_shorter_ones(spark, objective):
    df, configs = labelled(spark), [{"rate": 0.3, "depth": 1 if objective == "vote" else 3}, {"rate": 0.1, "depth": 1}]
    long = counted(boosting.boosted_counts(df, objective, configs, [2, 5]))
    short = counted(boosting.boosted_counts(df, objective, configs[:1], [2]))
    assert len(long) == 2 * 2 * 3 and short.items() <= long.items()
    assert long == counted(boosting.boosted_counts(df.repartition(3), objective, configs, [2, 5], one_block=0))
    assert sum(map(sum, long.values())) == 2 * 2 * 240 and {sum(c) for c in long.values()} <= {79, 80, 81}


def test_equal_rows_count_as_often_as_they_occur(spark):
    df = labelled(spark, n=90, binary=True)
    twice = df.union(df.withColumn("id", F.col("id") + 1000))
    cuts = boosting.cut_points(df)
    once, both = ({(bytes(r.bins), r.label, r.fold): r.weight for r in boosting.binned(d, cuts).collect()} for d in (df, twice))
    assert len(once) < 90 and sum(once.values()) == 90 and both == {k: 2 * n for k, n in once.items()}


def test_quantiles_keep_rare_values(spark):
    rows = [(Vectors.dense([float(i == 7), float(i % 3)]),) for i in range(2000)]
    assert boosting.quantiles(spark.createDataFrame(rows, ["features"])) == [[0.0, 1.0], [0.0, 1.0, 2.0]]


def test_boost_round_stops_at_perfect_and_at_guessing(spark):
    df = spark.createDataFrame([(1.0, True), (1.0, False)], "weight double, miss boolean")
    assert boost_round(df, 1.0, F.col("miss"))[:2] == (0.5, 0.0)
    assert boost_round(df, 1.0, F.lit(False))[:2] == (0.0, 0.0)


@pytest.mark.parametrize("best_cuts", [False, True])
def test_forests_of_all_lengths_and_depths_from_one_growth(spark, best_cuts):
    df = labelled(spark)
    every = counted(forest_counts(df, [4, 8], [3, None], best_cuts, seed=1))
    assert len(every) == 2 * 2 * 3 and sum(map(sum, every.values())) == 2 * 2 * 240
    alone = counted(forest_counts(df, [4], [3], best_cuts, seed=1))
    assert alone.items() <= every.items()
    assert every == counted(forest_counts(df.repartition(3), [4, 8], [3, None], best_cuts, seed=1, one_block=0))
    right = {key: counts[0] + counts[3] for key, counts in every.items()}
    assert sum(right[8, None, fold] for fold in range(3)) > 190


def test_extra_trees_split_only_where_a_feature_varies(spark):
    constant = F.udf(lambda x: Vectors.dense([*x.toArray()[:2], 5.0]), labelled(spark).schema["features"].dataType)
    df = labelled(spark).withColumn("features", constant("features"))
    edges = boosting.quantiles(df)
    rows = boosting.binned(df, [e[:-1] for e in edges])
    grown = trees_of(rows, edges, [4])
    grown.block, grown.keep_splits = boosting.whole_block(rows, 1), True
    grown.grow([0, 1, 2], range(5))
    assert {s[3] for s in grown.splits} == {0, 1}
    for fold, tree, node, feature, cut, gain, share in grown.splits:
        assert edges[feature][0] <= cut < edges[feature][-1] and 0 < share < 1 and gain >= 0


def test_hashed_draws_are_uniform_and_bootstrap_weights_poisson():
    x = drawn(42, 3, np.arange(200)[:, None], np.arange(1, 101)[None, :], 7).ravel() / forests.PRIME
    assert abs(x.mean() - 0.5) < 0.01 and abs(x.var() - 1 / 12) < 0.005 and len(set(x)) > 19_990
    y = drawn(43, 3, np.arange(200)[:, None], np.arange(1, 101)[None, :], 7).ravel() / forests.PRIME
    for mean in (1.0, 4.0, 900.0):
        times = poisson(x, y, np.full(len(x), mean))
        assert times.mean() == pytest.approx(mean, rel=0.03) and times.var() == pytest.approx(mean, rel=0.05)


def test_a_forest_node_takes_the_best_of_all_cuts(spark):
    df = labelled(spark, n=120)
    edges = boosting.quantiles(df)
    rows = boosting.binned(df, [e[:-1] for e in edges])
    grown = trees_of(rows, edges, [1], best_cuts=True, seed=5)
    grown.block, grown.keep_splits, grown.tried = boosting.whole_block(rows, 1), True, len(edges)
    grown.grow([1], range(6))
    block = grown.block
    names = np.array([zlib.crc32(x.tobytes()) >> 1 for x in np.c_[block.bins, block.label, block.fold].astype(np.uint8)])
    assert len(grown.splits) == 6
    for fold, tree, node, feature, cut, gain, share in grown.splits:
        key = (1, tree, names, len(edges))
        times = poisson(drawn(5, *key) / forests.PRIME, drawn(6, *key) / forests.PRIME, block.weight[:, 0])
        weight = np.where(block.fold[:, 0] != 1, times * grown.class_weight[1, block.label[:, 0]], 0)
        gini = lambda m: 2 * (weight * m * block.label[:, 0]).sum() * (weight * m * (1 - block.label[:, 0])).sum() / max((weight * m).sum(), 1e-9)
        falls = [
            (gini(np.ones(len(weight))) - gini(block.bins[:, f] <= c) - gini(block.bins[:, f] > c)) / weight.sum()
            for f in range(4) for c in range(len(edges[f]) - 1)
        ]
        assert gain == pytest.approx(max(falls), abs=1e-8)


def test_studies_of_an_empty_or_one_class_table(spark):
    df = labelled(spark)
    for algo in ("random_forest", "extra_trees", "xgboost", "gradient_boosting", "adaboost"):
        assert study.cross_validate(df.limit(0), algo, CONFIGS[algo]).count() == 0
        ones = study.cross_validate(df.withColumn("label", F.lit(1.0)), algo, CONFIGS[algo]).collect()
        assert sum(r.tp + r.fn for r in ones) == 240 * len(CONFIGS[algo]) and not any(r.fp + r.tn for r in ones)


def test_metrics_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = study.fold_metrics(study.confusion(df, [])).first()
    assert tuple(row) == (0.5, 0.0, 0.0, 0.0)


def test_best_config_is_the_closest_not_the_highest(spark):
    # the published configurations and accuracies
    results = spark.createDataFrame(
        [("random_forest", 100, 10, 98.7), ("random_forest", 300, 10, 99.2), ("adaboost", 300, None, 97.9), ("adaboost", 100, None, 95.0)],
        "algo string, n_estimators int, max_depth int, accuracy double",
    )
    targets = spark.createDataFrame(list(study.TARGET_ACCURACY.items()), "algo string, target double")
    best = study.best_config(results, targets, ["n_estimators", "max_depth"]).collect()
    assert {r["algo"]: (r["n_estimators"], r["max_depth"]) for r in best} == {"random_forest": (100, 10), "adaboost": (300, None)}


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (1,), (1,), (1,)], "label int")
    assert [tuple(r) for r in study.class_weights(df).orderBy("label").collect()] == [(0, 2.0, 1.0), (1, pytest.approx(2 / 3), pytest.approx(1 / 3))]
