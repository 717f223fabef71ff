"""Ward's micro-clusters: how the k-means rounds are dealt over tasks, and that they are k-means."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from affinia.operators import ward
from affinia.plans.chunked import _labelled

RNG = np.random.default_rng(34)


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], "id long, features array<double>")


def tasks_of(spark, group):
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return [info.numTasks for s in stages if (info := tracker.getStageInfo(s)) and info.numCompletedTasks]


def test_rounds_have_tasks_for_the_points_and_none_for_each_center(spark, monkeypatch):
    monkeypatch.setattr(ward, "BLOCK_ROWS", 100, raising=False)
    x = RNG.normal(size=(640, 48))  # 160 centers of 48 numbers: Spark measures them in 160 tasks
    spark.sparkContext.setJobGroup("ward-rounds", "")
    try:
        got = ward.ward_clusters(frame(spark, x), [3], micro=160).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 640
    tasks = tasks_of(spark, "ward-rounds")
    assert max(tasks) < 20
    assert sum(n >= 4 for n in tasks) >= 3  # before, every round over these points was one task


def test_rounds_are_those_of_the_built_in_method(spark, monkeypatch):
    monkeypatch.setattr(ward, "BLOCK_ROWS", 150)
    x = RNG.normal(size=(600, 6)) + 4 * RNG.integers(0, 5, size=(600, 1))
    df = frame(spark, np.vstack([x, x[:100]]))
    laid_out = df.select("id", array_to_vector("features").alias("vector")).repartition(1, "id").sortWithinPartitions("id").persist()
    means = KMeans(k=40, initMode="random", maxIter=20, seed=42, featuresCol="vector", predictionCol="micro")
    model = means.fit(laid_out)
    want = {r["id"]: r["micro"] for r in model.transform(laid_out).collect()}
    start = np.array(means.copy({means.maxIter: 0}).fit(laid_out).clusterCenters())
    centers = ward.lloyd(df.repartition(5, "id"), start)
    assert centers == pytest.approx(np.array(model.clusterCenters()), rel=1e-9, abs=1e-9)
    own = ward.model_of(spark, centers)
    place = {c.tobytes(): i for i, c in enumerate(centers)}
    order = [place[c.tobytes()] for c in own.clusterCenters()]
    assert sorted(order) == list(range(len(centers)))
    assert {r["id"]: order[r["micro"]] for r in own.transform(laid_out).collect()} == want
    again = ward.lloyd(df.repartition(5, "id").sortWithinPartitions("id"), start)
    assert (again == ward.lloyd(df.repartition(5, "id").sortWithinPartitions("id"), start)).all()


@pytest.mark.parametrize("offset,far", [(0.0, 1.0), (1e8, 1.0), (0.0, 1e9)])
def test_nearest_is_the_brute_force_under_offsets_and_ties(monkeypatch, offset, far):
    monkeypatch.setattr(ward, "PAIRS", 200)
    centers = RNG.integers(-3, 4, size=(30, 3)).astype(float) + offset
    centers[7] = centers[3]  # equal centers: the first one
    centers[9] *= far
    x = np.vstack([RNG.integers(-3, 4, size=(200, 3)) + offset, centers])
    want = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
    assert (ward.nearest(x, centers) == want).all()


def test_centers_without_points_stay(spark):
    start = np.array([[0.0, 0.0], [1.0, 1.0], [50.0, 50.0]])
    got = ward.lloyd(frame(spark, np.array([[0.0, 0.2], [0.2, 0.0], [1.0, 1.2]])), start)
    assert got == pytest.approx(np.array([[0.1, 0.1], [1.0, 1.2], [50.0, 50.0]]))


def test_points_are_dealt_by_id_before_their_labels_multiply(spark):
    df = frame(spark, RNG.normal(size=(60, 2)), [i % 50 for i in range(60)]).coalesce(1)
    labels = spark.createDataFrame([(i, k, i % k) for i in range(50) for k in (2, 3)], "id long, k int, cluster int")
    got = _labelled(labels, df)
    want = labels.join(df, "id")
    assert sorted(map(tuple, got.select("id", "k", "cluster").collect())) == sorted(map(tuple, want.select("id", "k", "cluster").collect()))
    assert got.columns == want.columns
    assert "REPARTITION_BY_COL" in got._jdf.queryExecution().toString() or "RepartitionByExpression" in got._jdf.queryExecution().toString()


def test_missing_features_are_refused(spark):
    df = frame(spark, RNG.normal(size=(20, 2))).withColumn("features", F.when(F.col("id") != 3, F.col("features")))
    with pytest.raises(Exception):
        ward.ward_clusters(df, [3]).collect()
