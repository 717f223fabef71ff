"""Ward clustering for several numbers of clusters at once, by way of micro-clusters."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.functions.vectors import centroid
from affinia.operators.summaries import summarise
from affinia.session import store

BLOCK_ROWS = 8_192  # points of a task of a k-means round
PAIRS = 250_000  # distances that a task holds at once


def ward_clusters(df: DataFrame, ks: Sequence[int], micro: int = 500, seed: int = 42, rows_per_task: int = 100_000) -> DataFrame:
    """`(id, k, cluster)` for every k in `ks`; the clusterings are nested.

    Ward's method compares all pairs of points. Here Spark first forms at most `micro`
    clusters by k-means and summarises them; the merge order is found among those
    summaries, whose number is bounded whatever the number of points, and the labels are
    joined back. K-means starts from `micro` points drawn at random, which are all of them where
    there are no more; it then leaves every distinct point alone, and the result is Ward's own.
    """
    spark = df.sparkSession
    ready = df.select("id", "features")
    n = ready.count()
    tasks = max(1, math.ceil(n / rows_per_task))
    vectors = ready.select("id", array_to_vector("features").alias("vector"))
    laid_out = vectors.repartition(tasks, "id").sortWithinPartitions("id").persist()
    try:  # without a round these are the points that k-means starts from
        drawn = KMeans(k=micro, initMode="random", maxIter=0, seed=seed, featuresCol="vector", predictionCol="micro")
        start = np.array(drawn.fit(laid_out).clusterCenters())
    finally:
        laid_out.unpersist()
    parts = max(1, math.ceil(n / BLOCK_ROWS))
    dealt = store(ready.repartition(parts, "id", "features").sortWithinPartitions("id", "features"), "points")
    centers = lloyd(dealt.coalesce(parts), start)
    model = model_of(spark, centers)
    placed = model.transform(dealt.withColumn("vector", array_to_vector("features")))
    grouped = store(placed.select("id", "features", "micro"), "micro")
    rows = (
        summarise(grouped, ["micro"])
        .select("micro", "n", centroid(F.col("n"), F.col("sum")).alias("center"))
        .collect()
    )
    place = {center.tobytes(): i for i, center in enumerate(centers)}
    order = [place[center.tobytes()] for center in model.clusterCenters()]
    rows.sort(key=lambda row: order[row["micro"]])
    names = [row["micro"] for row in rows]
    cuts = ward_cuts(np.array([r["n"] for r in rows], float), np.array([r["center"] for r in rows], float), ks)
    labels = [
        (int(name), int(k), int(label)) for k, column in cuts.items() for name, label in zip(names, column)
    ]
    lookup = spark.createDataFrame(labels, "micro int, k int, cluster int")  # micro * len(ks) rows
    return grouped.select("id", "micro").join(F.broadcast(lookup), "micro").select("id", "k", "cluster")


def lloyd(df: DataFrame, centers: np.ndarray, rounds: int = 20, tol: float = 1e-4) -> np.ndarray:
    """The centers after k-means rounds from given ones; a center without points stays where it is.

    Spark's own rounds take a task for each center to measure the centers' distances. Here a round is one job
    over blocks of arrays that the executors keep; only the sums of the clusters travel, and
    they are added up in the order of the blocks, so equal tables give equal centers.
    """
    width = centers.shape[1]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"block": pa.array([_matrix(batch, width).tobytes()], pa.binary())})

    blocks = df.select("features").mapInArrow(pack, "block binary").rdd
    blocks = blocks.map(lambda r: np.frombuffer(r["block"]).reshape(-1, width)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(rounds):
            counts, sums = _cluster_sums(blocks, centers)
            held = counts > 0
            moved = centers.copy()
            moved[held] = sums[held] / counts[held, None]
            settled = (((moved - centers) ** 2).sum(axis=1) <= tol * tol).all()
            centers = moved
            if settled:
                break
    finally:
        blocks.unpersist()
    return centers


def _cluster_sums(blocks: RDD, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points nearest to each center."""
    together = math.isqrt(blocks.getNumPartitions() - 1) + 1
    copied = blocks.context.broadcast(centers)

    def part(place: int, arrays: Iterable[np.ndarray]):
        counts, sums = np.zeros(len(copied.value)), np.zeros(copied.value.shape)
        for x in arrays:
            label = nearest(x, copied.value)
            counts += np.bincount(label, minlength=len(counts))
            np.add.at(sums, label, x)
        yield place // together, (place, counts, sums)

    def in_order(found):
        found = sorted(found, key=lambda f: f[0])
        return sum(f[1] for f in found), sum(f[2] for f in found)

    groups = blocks.mapPartitionsWithIndex(part).groupByKey(together).mapValues(in_order).collect()
    copied.destroy()
    return in_order([(place, *found) for place, found in groups])


def model_of(spark: SparkSession, centers: np.ndarray) -> KMeansModel:
    """Spark's model with these centers, in an order of its own: no round over the centers themselves."""
    rows = spark.createDataFrame([(center.tolist(),) for center in centers], "center array<double>")
    means = KMeans(k=max(2, len(centers)), initMode="random", maxIter=0, seed=0, featuresCol="vector", predictionCol="micro")
    return means.fit(rows.select(array_to_vector("center").alias("vector")))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("features").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest center of each row; equal distances go to the first one.

    |c|² - 2xc ranks the centers of a row up to rounding. Where more than one center may be the
    nearest within the bound of that error, the differences themselves are squared.
    """
    label, step = np.empty(len(x), np.int64), max(1, PAIRS // len(centers))
    middle = centers.mean(axis=0)
    c = centers - middle  # a common offset does not cancel the distances
    square, error = (c * c).sum(axis=1), 8 * (x.shape[1] + 4) * np.finfo(float).eps
    for at in range(0, len(x), step):
        rows = x[at : at + step] - middle
        rank = rows @ (-2 * c.T)
        most = (rank + square * (1 + error)).min(axis=1) + 2 * error * (rows * rows).sum(axis=1)
        rank += square * (1 - error)
        label[at : at + step] = rank.argmin(axis=1)
        likely = ~(rank > most[:, None])
        for i in np.flatnonzero(likely.sum(axis=1) != 1):
            few = np.flatnonzero(likely[i])
            label[at + i] = few[((x[at + i] - centers[few]) ** 2).sum(axis=1).argmin()]
    return label


def ward_cuts(sizes: np.ndarray, centers: np.ndarray, ks: Sequence[int]) -> dict[int, np.ndarray]:
    """Labels after merging down to each k; the cheapest merge comes first.

    The cost of joining a and b is n_a n_b / (n_a + n_b) * |c_a - c_b|².
    """
    m = len(sizes)
    sizes, centers = sizes.copy(), centers.copy()
    gaps = ((centers[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    cost = gaps * (sizes[:, None] * sizes[None, :]) / (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(cost, np.inf)
    owner, cuts = np.arange(m), {}
    for left in range(m, 0, -1):
        if left in ks:
            cuts[left] = np.unique(owner, return_inverse=True)[1]
        if left <= min(ks):
            break
        a, b = sorted(divmod(int(cost.argmin()), m))
        centers[a] = (sizes[a] * centers[a] + sizes[b] * centers[b]) / (sizes[a] + sizes[b])
        sizes[a] += sizes[b]
        owner[owner == b] = a
        cost[b, :] = cost[:, b] = np.inf
        alive = np.isfinite(cost[a]) & (np.arange(m) != a)
        row = ((centers - centers[a]) ** 2).sum(axis=1) * sizes * sizes[a] / (sizes + sizes[a])
        cost[a, alive] = cost[alive, a] = row[alive]
    for k in ks:
        cuts.setdefault(k, np.arange(m))  # fewer points than clusters
    return cuts
