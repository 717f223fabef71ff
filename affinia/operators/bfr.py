"""BFR clustering: points arrive in chunks, clusters are kept as mergeable summaries."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.functions.vectors import centroid
from affinia.operators.summaries import merge_summaries, nearest_cluster, summarise
from affinia.operators.skew import ranked
from affinia.session import scratch_path

CLUSTERS = "kind string, cluster string, n long, sum array<double>, sumsq array<double>, m2 array<double>"
RETAINED = "id long, features array<double>"
PLACED = "id long, features array<double>, kind string, cluster string"
ASSIGNED = "id long, kind string, cluster string, chunk long"
REPORT = "chunk long, n_points long, ds_clusters long, ds_points long, cs_clusters long, cs_points long, rs_points long"
MOVED = "cluster string, goes_to string"
CHUNK_ROWS = 1_000_000  # points of a chunk where nothing else is asked for


@dataclass(frozen=True)
class BfrSettings:
    k: int = 10
    alpha: float = 2.0  # a point joins a cluster within alpha * sqrt(dimensions)
    over: int = 5  # first clustering uses k * over groups
    smallest: int = 3  # groups below this size are outliers in the first chunk
    seed: int = 42
    rows_per_task: int = 100_000  # of k-means
    most: int = 50  # compressed clusters after a chunk
    tight: float = 1.0  # compressed clusters merge while their spread stays below this times that of the widest DS cluster

    @property
    def least(self) -> int:
        """With this many points one of the first k * over groups has `smallest` points."""
        return self.k * self.over * self.smallest


class Bfr:
    """Discard set (DS), compressed set (CS) and retained set (RS) in versioned tables.

    Every chunk reads version `v - 1` and writes version `v`: the cluster summaries,
    the retained points, the points that found a cluster and one line of the report.
    The report is written last and marks the version as complete, so a chunk that is
    replayed after a failure is either skipped or redone from the version before it.

    The clusters are fixed while a chunk is assigned and each point takes the nearest
    one, so the result does not depend on the order of the points. A chunk may hold any
    number of points: only the summaries, k plus `most` plus k * over at most, travel. After each
    chunk compressed clusters are merged with their nearest ones, see `merge_compressed`.
    Until `BfrSettings.least` points have come all of them wait in RS, so a small first
    chunk never leaves DS without a cluster.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, settings: BfrSettings = BfrSettings()):
        self.spark = spark
        self.path = path or scratch_path(spark, "bfr")
        self.settings = settings

    # -- chunks ---------------------------------------------------------------

    def update(self, chunk: DataFrame, version: int, start: int | None = None) -> None:
        """Add one chunk `(id, features)`; versions count from 0.

        `start`, the number of points before the chunk, goes into the names of its compressed
        clusters; without it the version does.
        """
        if self._complete(version):
            return
        waiting = self._read("retained", version - 1) if version else None
        known = self._read("clusters", version - 1) if version else None
        points = chunk.select("id", "features")
        label = version if start is None else start
        if known is None or known.isEmpty():
            every = points if waiting is None else waiting.unionByName(points)
            if every.count() < self.settings.least:
                clusters, assigned, retained = self._hold(every, version)
            else:
                clusters, assigned, retained = self._first(every, version, label)
        else:
            clusters, assigned, retained = self._next(points, known, waiting, version, label)
        clusters = self._merged(clusters, version)
        self._write(clusters, "clusters", version)
        self._write(assigned.withColumn("chunk", F.lit(version).cast("long")), "assigned", version)
        self._write(self._report(chunk, version, retained), "report", version)

    def restore(self, members: DataFrame) -> None:
        """Version 0 from given members `(id, features, kind, cluster)`, with nothing left over."""
        self._write(summarise(members, ["kind", "cluster"]), "clusters", 0)
        assigned = members.select("id", "kind", "cluster", F.lit(0).cast("long").alias("chunk"))
        self._write(assigned, "assigned", 0)
        self._write(self.spark.createDataFrame([], MOVED), "moved", 0)
        self._write(self.spark.createDataFrame([], RETAINED), "retained", 0)
        self._write(self._report(members, 0, self._read("retained", 0)), "report", 0)

    def _hold(self, points: DataFrame, version: int):
        self._write(points, "retained", version)
        nothing = self.spark.createDataFrame([], CLUSTERS)
        assigned = self.spark.createDataFrame([], ASSIGNED).drop("chunk")
        return nothing, assigned, self._read("retained", version)

    def _first(self, points: DataFrame, version: int, label: int):
        s = self.settings
        grouped = self._sized(self._kmeans(points, s.k * s.over, 30, "grouped", version))
        inliers = grouped.filter(F.col("size") >= s.smallest).select("id", "features")
        outliers = grouped.filter(F.col("size") < s.smallest).select("id", "features")
        core = self._kmeans(inliers, s.k, 30, "core", version).select(
            "id", "features", F.lit("DS").alias("kind"), F.col("group").cast("string").alias("cluster")
        )
        compressed, retained = self._compress(outliers, version, f"CS_{{group}}_{label}" if version else "CS_{group}")
        members = core.unionByName(compressed)
        return summarise(members, ["kind", "cluster"]), members.select("id", "kind", "cluster"), retained

    def _next(self, points: DataFrame, known: DataFrame, waiting: DataFrame, version: int, label: int):
        """One pass places the chunk's points: DS first, CS for those without a near DS cluster."""
        alpha = self.settings.alpha
        sets = {kind: known.filter(F.col("kind") == kind) for kind in ("DS", "CS")}
        placed = nearest_cluster(points, sets["DS"], alpha).withColumnRenamed("cluster", "ds").drop("distance")
        placed = nearest_cluster(placed, sets["CS"], alpha).withColumnRenamed("cluster", "cs")
        kind = F.when(F.col("ds").isNotNull(), F.lit("DS")).when(F.col("cs").isNotNull(), F.lit("CS"))
        placed = placed.select("id", "features", kind.alias("kind"), F.coalesce("ds", "cs").alias("cluster"))
        self._write(placed, "placed", version)
        placed = self._read("placed", version)
        members = placed.filter(F.col("kind").isNotNull())
        left = waiting.unionByName(placed.filter(F.col("kind").isNull()).select("id", "features"))
        if left.count() > 5 * self.settings.k:
            compressed, retained = self._compress(left, version, f"CS_{{group}}_{label}")
            members = members.unionByName(compressed)
        else:
            self._write(left, "retained", version)
            retained = self._read("retained", version)
        summaries = known.unionByName(summarise(members, ["kind", "cluster"]))
        return merge_summaries(summaries, ["kind", "cluster"]), members.select("id", "kind", "cluster"), retained

    def _compress(self, points: DataFrame, version: int, name: str):
        """Cluster the outliers: groups of two or more become compressed clusters."""
        s = self.settings
        grouped = self._sized(self._kmeans(points, s.k * s.over, 10, "regrouped", version))
        before, after = name.split("{group}")
        compressed = grouped.filter(F.col("size") > 1).select(
            "id",
            "features",
            F.lit("CS").alias("kind"),
            F.concat(F.lit(before), F.col("group").cast("string"), F.lit(after)).alias("cluster"),
        )
        self._write(grouped.filter(F.col("size") == 1).select("id", "features"), "retained", version)
        return compressed, self._read("retained", version)

    def _merged(self, clusters: DataFrame, version: int) -> DataFrame:
        """The clusters with compressed ones merged; who went where is written for `finish`."""
        self._write(clusters, "unmerged", version)
        clusters = self._read("unmerged", version)
        rows = [tuple(r) for r in clusters.select("kind", "cluster", "n", "sum", "m2").collect()]  # a bounded number
        into = merge_compressed(rows, self.settings)
        moved = self.spark.createDataFrame(list(into.items()), MOVED)
        self._write(moved, "moved", version)
        if not into:
            return clusters
        renamed = clusters.join(F.broadcast(moved), "cluster", "left").withColumn("cluster", F.coalesce("goes_to", "cluster"))
        return merge_summaries(renamed.select(clusters.columns), ["kind", "cluster"])

    @staticmethod
    def _sized(grouped: DataFrame) -> DataFrame:
        sizes = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
        return grouped.join(F.broadcast(sizes), "group")  # k * over rows at most

    def _kmeans(self, points: DataFrame, k: int, rounds: int, name: str, version: int) -> DataFrame:
        """`(id, features, group)`, written once; rows are laid out by id so that a seed gives one result."""
        s = self.settings
        n = points.count()
        if n < 2:
            grouped = points.select("id", "features", F.lit(0).alias("group"))
            self._write(grouped, name, version)
            return self._read(name, version)
        ready = (
            points.select("id", "features", array_to_vector("features").alias("vector"))
            .repartition(math.ceil(n / s.rows_per_task), "id")
            .sortWithinPartitions("id")
            .persist()
        )
        try:
            model = KMeans(
                k=min(k, n), maxIter=rounds, seed=s.seed, featuresCol="vector", predictionCol="group"
            ).fit(ready)
            self._write(model.transform(ready).select("id", "features", "group"), name, version)
        finally:
            ready.unpersist()
        return self._read(name, version)

    # -- results --------------------------------------------------------------

    def finish(self, version: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Merge compressed clusters into near discard clusters.

        Returns the clusters, the assignment `(id, kind, cluster)` of every clustered
        point with merged names, and the points left over.
        """
        known = self._read("clusters", version)
        merged_into = self.merge_map(known, self.settings.alpha)
        clusters = merge_summaries(
            known.join(merged_into, "cluster", "left").select(
                F.when(F.col("ds").isNotNull(), F.lit("DS")).otherwise(F.col("kind")).alias("kind"),
                F.coalesce("ds", "cluster").alias("cluster"),
                "n",
                "sum",
                "sumsq",
                "m2",
            ),
            ["kind", "cluster"],
        )
        assigned = self._until("assigned", ASSIGNED, version)
        assigned = assigned.join(self._moves(version), "cluster", "left").withColumn("cluster", F.coalesce("goes_to", "cluster"))
        assigned = assigned.join(merged_into, "cluster", "left").select(
            "id",
            F.when(F.col("ds").isNotNull(), F.lit("DS")).otherwise(F.col("kind")).alias("kind"),
            F.coalesce("ds", "cluster").alias("cluster"),
        )
        return clusters, assigned, self._read("retained", version)

    def _moves(self, version: int) -> DataFrame:
        """`(cluster, goes_to)`: where compressed clusters merged in any chunk are now.

        At most `k * over` clusters come with a chunk, so there are few rows even after very many points.
        """
        moved = self.spark.read.schema(f"{MOVED}, v int").parquet(f"{self.path}/moved").filter(F.col("v") <= version)
        now: dict[str, str] = {}
        for row in moved.orderBy(F.desc("v")).collect():  # the later moves first
            now[row.cluster] = now.get(row.goes_to, row.goes_to)
        return self.spark.createDataFrame(list(now.items()), MOVED)

    @staticmethod
    def merge_map(clusters: DataFrame, alpha: float) -> DataFrame:
        """`(cluster, ds)`: the discard cluster nearest to a compressed cluster's centroid."""
        ds = clusters.filter(F.col("kind") == "DS")
        centers = clusters.filter(F.col("kind") == "CS").select(
            F.col("cluster").alias("cs"), centroid(F.col("n"), F.col("sum")).alias("features")
        )
        near = nearest_cluster(centers, ds, alpha).filter(F.col("cluster").isNotNull())
        return near.select(F.col("cs").alias("cluster"), F.col("cluster").alias("ds"))

    def tables(self, version: int) -> tuple[DataFrame, DataFrame]:
        """The clusters and the points left over as they stand after a chunk."""
        return self._read("clusters", version), self._read("retained", version)

    def report(self, version: int) -> DataFrame:
        """One line per chunk: points, and size of the three sets after it."""
        return self._until("report", REPORT, version)

    def last_version(self) -> int | None:
        """The last complete version, or null before the first chunk."""
        try:
            return self.spark.read.schema(f"{REPORT}, v int").parquet(f"{self.path}/report").agg(F.max("v")).first()[0]
        except AnalysisException:  # no such folder yet
            return None

    def _report(self, chunk: DataFrame, version: int, retained: DataFrame) -> DataFrame:
        def of(kind, value):
            return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0)).cast("long")

        n_points, n_retained = chunk.count(), retained.count()
        return self._read("clusters", version).agg(
            F.lit(version).cast("long").alias("chunk"),
            F.lit(n_points).cast("long").alias("n_points"),
            of("DS", F.lit(1)).alias("ds_clusters"),
            of("DS", F.col("n")).alias("ds_points"),
            of("CS", F.lit(1)).alias("cs_clusters"),
            of("CS", F.col("n")).alias("cs_points"),
            F.lit(n_retained).cast("long").alias("rs_points"),
        )

    # -- tables ---------------------------------------------------------------

    def _write(self, df: DataFrame, name: str, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/v={version}")

    def _read(self, name: str, version: int) -> DataFrame:
        schema = {"clusters": CLUSTERS, "unmerged": CLUSTERS, "retained": RETAINED, "placed": PLACED}.get(name)
        return self.spark.read.schema(schema or f"{RETAINED}, group int").parquet(f"{self.path}/{name}/v={version}")

    def _until(self, name: str, schema: str, version: int) -> DataFrame:
        """All versions of a table up to one, by the partition column."""
        every = self.spark.read.schema(f"{schema}, v int").parquet(f"{self.path}/{name}")
        return every.filter(F.col("v") <= version).drop("v")

    def _complete(self, version: int) -> bool:
        """The report is a single row, so it is there as a whole or not at all."""
        try:
            return not self.spark.read.schema(REPORT).parquet(f"{self.path}/report/v={version}").isEmpty()
        except AnalysisException:
            return False


def merge_compressed(rows: Sequence[tuple], settings: BfrSettings) -> dict[str, str]:
    """Which compressed cluster is merged into which, by name, from rows (kind, cluster, n, sum, m2).

    A cluster has a norm bound on its distance to another (that of their centroids' lengths), so most pairs are never
    measured. The two nearest centroids go first. They merge if the mean variance of the whole stays below
    `tight` times that of the widest discard cluster, or if more than `most` compressed clusters are left.
    """
    wide = [np.sum(m2) / n for kind, _, n, _, m2 in rows if kind == "DS"]
    limit = settings.tight * max(wide, default=0.0)
    live = {name: (n, np.array(total, float), float(np.sum(m2))) for kind, name, n, total, m2 in sorted(rows, key=lambda r: r[1]) if kind == "CS"}
    into: dict[str, str] = {}

    def nearest(name: str) -> tuple[float, str, str] | None:
        """The nearest other centroid: candidates by length, until the lengths differ by more than the best distance."""
        n, total, _ = live[name]
        center, best = total / n, None
        length = float(np.linalg.norm(center))
        others = sorted((abs(lengths[o] - length), o) for o in live if o != name)
        for gap, other in others:
            if best is not None and gap > best[0]:
                break
            d = float(np.linalg.norm(live[other][1] / live[other][0] - center))
            if best is None or (d, other) < best:
                best = (d, other)
        return best and (best[0], *sorted((name, best[1])))

    lengths = {name: float(np.linalg.norm(total / n)) for name, (n, total, _) in live.items()}
    near = {name: nearest(name) for name in live}
    refused: set[tuple[str, str]] = set()
    while len(live) > 1:
        pairs = sorted({p for p in near.values() if p and (len(live) > settings.most or p[1:] not in refused)})
        if not pairs:
            break
        _, a, b = pairs[0]
        (na, sa, ma), (nb, sb, mb) = live[a], live[b]
        n, gap = na + nb, sa / na - sb / nb
        m2 = ma + mb + float(gap @ gap) * na * nb / n
        if m2 / n > limit and len(live) <= settings.most:
            refused.add((a, b))
            continue
        live[a] = (n, sa + sb, m2)
        del live[b]
        lengths[a] = float(np.linalg.norm(live[a][1] / n))
        into[b] = a
        for name in live:
            if name == a or near[name] is None or {a, b} & set(near[name][1:]):
                near[name] = nearest(name)
            else:  # the merged centroid may have come nearer
                d = float(np.linalg.norm(live[a][1] / n - live[name][1] / live[name][0]))
                near[name] = min(near[name], (d, *sorted((name, a))))
        near.pop(b, None)
    for name in into:
        while into[name] in into:
            into[name] = into[into[name]]
    return into


def chunk_rows(n: int, chunks: int = 4, least: int = 250) -> int:
    """The size of `chunks` equal chunks of n points: the number of jobs does not grow with the table."""
    return max(least, -(-n // chunks))


def run_chunks(
    df: DataFrame, size: int = CHUNK_ROWS, settings: BfrSettings = BfrSettings(), path: str | None = None
) -> tuple[Bfr, int]:
    """Cluster `(id, features)` in chunks of `size` points by ascending id; returns the state and its version.

    Points are ranked, so gaps between ids do not matter. The rows are written once,
    partitioned by chunk, so each chunk reads its own files only.
    """
    spark = df.sparkSession
    bfr = Bfr(spark, path, settings)
    source = f"{bfr.path}/source"
    chunk = F.floor((F.col("rank") - 1) / size).cast("long")
    # a chunk is written by a bounded number of tasks, each with about `rows_per_task` rows
    slices = math.ceil(size / settings.rows_per_task)
    part = F.pmod(F.xxhash64("id"), F.lit(slices))
    numbered = ranked(df.select("id", "features"), [], ["id"])
    laid_out = numbered.select("id", "features", chunk.alias("chunk")).repartition("chunk", part)
    laid_out.write.mode("overwrite").partitionBy("chunk").parquet(source)
    stored = spark.read.schema("id long, features array<double>, chunk long").parquet(source)
    last = stored.agg(F.max("chunk")).first()[0]
    for version in range(0 if last is None else last + 1):
        bfr.update(stored.filter(F.col("chunk") == version).drop("chunk"), version, version * size)
    return bfr, -1 if last is None else last


def set_sizes(clusters: DataFrame, retained: DataFrame) -> DataFrame:
    """`(kind, clusters, points)` of the three sets."""
    counted = clusters.groupBy("kind").agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("points"))
    left = retained.agg(
        F.lit("RS").alias("kind"), F.lit(0).cast("long").alias("clusters"), F.count(F.lit(1)).alias("points")
    )
    return counted.unionByName(left)


def final_report(clusters: DataFrame) -> DataFrame:
    """Each cluster with N and the first three components of SUM and SUMSQ."""
    return clusters.select(
        "kind", "cluster", "n", F.slice("sum", 1, 3).alias("sum3"), F.slice("sumsq", 1, 3).alias("sumsq3")
    )
