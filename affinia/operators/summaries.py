"""Mergeable cluster summaries, cluster statistics, nearest cluster.

A summary is (N, SUM, SUMSQ) for the reports, and M2: the squared deviations from the
cluster's own mean. Variances come from M2, so a large common offset does not cancel them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.functions.text import fixed
from affinia.functions.vectors import centroid, mahalanobis, spread, total

BLOCK_VALUES = 2_000_000  # numbers of cluster summaries that a task holds at once


def summarise(df: DataFrame, by: Sequence[str], features: str = "features") -> DataFrame:
    """`(*by, n, sum, sumsq, m2)` in one pass; partial sums are combined before the shuffle."""
    parts = Summarizer.metrics("count", "sum", "normL2", "variance")
    return (
        df.groupBy(*by)
        .agg(parts.summary(array_to_vector(features)).alias("s"))
        .select(
            *by,
            F.col("s.count").alias("n"),
            vector_to_array("s.sum").alias("sum"),
            F.transform(vector_to_array("s.normL2"), lambda x: x * x).alias("sumsq"),
            F.transform(vector_to_array("s.variance"), lambda v: v * (F.col("s.count") - 1)).alias("m2"),
        )
    )


def merge_summaries(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add up summaries that share a key; the number of rows is that of the clusters.

    Deviations add up after each part's distance from the common mean is added to its own.
    """
    flat = df.select(*by, "n", F.posexplode(F.arrays_zip("sum", "sumsq", "m2")).alias("pos", "v"))
    together = Window.partitionBy(*by, "pos")
    mean = F.sum("v.sum").over(together) / F.sum("n").over(together)
    gap = F.col("v.sum") / F.col("n") - F.col("mean")
    sums = (
        flat.withColumn("mean", mean)
        .groupBy(*by, "pos")
        .agg(
            F.sum("n").alias("n"),
            F.sum("v.sum").alias("sum"),
            F.sum("v.sumsq").alias("sumsq"),
            F.sum(F.col("v.m2") + F.col("n") * gap * gap).alias("m2"),
        )
    )
    packed = sums.groupBy(*by).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "sum", "sumsq", "m2"))).alias("v")
    )
    return packed.select(*by, "n", *[F.col(f"v.{c}").alias(c) for c in ("sum", "sumsq", "m2")])


def cluster_stats(df: DataFrame, by: Sequence[str], features: str = "features") -> DataFrame:
    """`(*by, n, radius, diameter, density_r, density_d)` in one pass over the points.

    radius² is the mean squared distance to the centroid, diameter² the mean squared
    distance of two different points. The latter needs no pairs: it equals twice the
    sample variance summed over the dimensions, and radius² is (n - 1) / n of the
    variance. Summarizer updates means and deviations, so nothing cancels out.
    """
    parts = Summarizer.metrics("count", "variance")
    spread = (
        df.groupBy(*by)
        .agg(parts.summary(array_to_vector(features)).alias("s"))
        .select(*by, F.col("s.count").alias("n"), total(vector_to_array("s.variance")).alias("v"))
    )
    r2, d2 = F.col("v") * (F.col("n") - 1) / F.col("n"), F.col("v") * 2
    density = [F.when(x > 0, F.col("n") / F.nullif(x, F.lit(0.0))).otherwise(F.lit(0.0)) for x in (r2, d2)]
    return spread.select(
        *by,
        "n",
        F.sqrt(r2).alias("radius"),
        F.sqrt(d2).alias("diameter"),
        density[0].alias("density_r"),
        density[1].alias("density_d"),
    )


def stats_by_k(stats: DataFrame) -> DataFrame:
    """Average of each statistic over the clusters of one clustering `k`."""
    names = ("radius", "diameter", "density_r", "density_d")
    return stats.groupBy("k").agg(*[F.avg(c).alias(c) for c in names])


def stats_report(stats: DataFrame) -> DataFrame:
    """One formatted line per cluster: `(k, cluster, line)`."""
    shown = [F.concat(F.lit(f"{c}="), fixed(c, 2)) for c in ("radius", "diameter", "density_r", "density_d")]
    line = F.concat(
        F.format_string("Cluster %s: size=%d, ", F.col("cluster").cast("string"), "n"),
        F.concat_ws(", ", *shown),
    )
    return stats.select("k", "cluster", line.alias("line"))


def nearest_cluster(points: DataFrame, clusters: DataFrame, alpha: float, key: str = "cluster") -> DataFrame:
    """Add `(cluster, distance)` of the nearest cluster within `alpha * sqrt(dimensions)`.

    The distance is the diagonal Mahalanobis distance to `clusters (key, n, sum, m2)`;
    both columns are null where no cluster is near enough. Equal distances go to the
    smaller key. The points are neither shuffled nor multiplied: the few summaries
    are attached as one array, in blocks of bounded size, and each block improves on the
    best cluster so far.
    """
    kind = clusters.schema[key].dataType
    count, width = clusters.agg(F.count(F.lit(1)), F.max(F.size("sum"))).first()
    nothing = F.struct(F.lit(None).cast("double").alias("distance"), F.lit(None).cast(kind).alias("cluster"))
    best = points.withColumn("_best", nothing)
    blocks = math.ceil(count * (width or 1) / BLOCK_VALUES)
    listed = clusters.select(
        F.col(key).alias("cluster"), centroid(F.col("n"), F.col("sum")).alias("center"), spread(F.col("n"), F.col("m2")).alias("spread")
    )
    radius = alpha * F.sqrt(F.size("features"))
    for block in range(blocks):
        part = listed.filter(F.pmod(F.xxhash64("cluster"), F.lit(blocks)) == block)
        table = part.agg(F.collect_list(F.struct("cluster", "center", "spread"))).scalar()
        away = F.transform(
            "_block",
            lambda c: F.struct(
                mahalanobis(F.col("features"), c["center"], c["spread"]).alias("distance"), c["cluster"].alias("cluster")
            ),
        )
        near = F.array_min(F.filter("_away", lambda x: x["distance"] < radius))
        best = best.withColumn("_block", table).withColumn("_away", away).withColumn("_near", near)
        better = F.col("_best.distance").isNull() | (F.col("_near") < F.col("_best"))
        best = best.withColumn("_best", F.when(F.col("_near").isNotNull() & better, F.col("_near")).otherwise(F.col("_best")))
        best = best.drop("_block", "_away", "_near")
    return best.withColumns({"cluster": F.col("_best.cluster"), "distance": F.col("_best.distance")}).drop("_best")
