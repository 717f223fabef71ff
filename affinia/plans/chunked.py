"""Queries that run the iterative clusterings over the embeddings."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from affinia.operators.bfr import BfrSettings, chunk_rows, run_chunks, set_sizes
from affinia.operators.summaries import cluster_stats, stats_report, summarise
from affinia.operators.ward import ward_clusters
from affinia.plans.tables import points
from affinia.session import scratch_path, store
from affinia.streaming.bfr_stream import cluster_stream

CHUNKS, LEAST = 4, 250  # chunks of a run, and the points one has at least
# with 64 noisy dimensions alpha 2 would take in every point; this keeps all three sets busy
SETTINGS = BfrSettings(alpha=1.2)


def _points(spark, sf_dir):
    return points(spark, sf_dir).select("id", "features")


def _run(spark, sf_dir):
    df = _points(spark, sf_dir)
    return run_chunks(df, chunk_rows(df.count(), CHUNKS, LEAST), SETTINGS)


def bfr_run(spark, sf_dir):
    bfr, version = _run(spark, sf_dir)
    clusters, _, retained = bfr.finish(version)
    return set_sizes(clusters, retained)


def bfr_log(spark, sf_dir):
    bfr, version = _run(spark, sf_dir)
    return bfr.report(version)


def bfr_totals(spark, sf_dir):
    """Points of each chunk, and of the three sets together after it."""
    total = (F.col("ds_points") + F.col("cs_points") + F.col("rs_points")).alias("n_total")
    return bfr_log(spark, sf_dir).select("chunk", "n_points", total)


def _conserved(spark, sf_dir, bfr, version):
    """N, SUM and SUMSQ of all clusters and of the points left over, added up by dimension.

    n_wrong counts clusters whose N is not the number of points assigned to them.
    """
    clusters, assigned, retained = bfr.finish(version)
    kept = clusters.select("n", F.posexplode(F.arrays_zip("sum", "sumsq")).alias("pos", "v"))
    kept = kept.select("pos", "n", F.col("v.sum").alias("sum"), F.col("v.sumsq").alias("sumsq"))
    left = retained.select(F.posexplode("features").alias("pos", "x"))
    left = left.select("pos", F.lit(1).cast("long").alias("n"), F.col("x").alias("sum"), (F.col("x") * F.col("x")).alias("sumsq"))
    totals = kept.union(left).groupBy("pos").agg(*[F.sum(c).alias(c) for c in ("n", "sum", "sumsq")])
    rebuilt = summarise(assigned.join(_points(spark, sf_dir), "id"), ["kind", "cluster"])
    apart = clusters.join(rebuilt.select("kind", "cluster", F.col("n").alias("found")), ["kind", "cluster"], "full")
    wrong = apart.filter(~F.col("n").eqNullSafe(F.col("found"))).agg(F.count(F.lit(1)).alias("n_wrong"))
    return totals.select(
        "pos", "n", F.round("sum", 6).alias("sum"), F.round("sumsq", 6).alias("sumsq"), wrong.scalar().alias("n_wrong")
    )


def bfr_conserved(spark, sf_dir):
    return _conserved(spark, sf_dir, *_run(spark, sf_dir))


def _streamed(spark, sf_dir):
    """The points as a stream of files, in as many micro-batches."""
    path, df = scratch_path(spark, "arriving"), _points(spark, sf_dir)
    n = df.count()
    df.repartition(math.ceil(n / chunk_rows(n, CHUNKS, LEAST)), "id").write.parquet(path)
    return cluster_stream(spark, path, SETTINGS)


def bfr_stream(spark, sf_dir):
    bfr, version = _streamed(spark, sf_dir)
    clusters, _, retained = bfr.finish(version)
    return set_sizes(clusters, retained)


def bfr_stream_conserved(spark, sf_dir):
    return _conserved(spark, sf_dir, *_streamed(spark, sf_dir))


def bfr_bounded(spark, sf_dir):
    """For each chunk whether the compressed set stayed within its bound."""
    bounded = (F.col("cs_clusters") <= SETTINGS.most).alias("cs_bounded")
    return bfr_log(spark, sf_dir).select("chunk", "n_points", bounded)


KS = range(8, 17)


def _labelled(labels, df):
    """Labels with the points, which are dealt by id: their files may be few, and each point has a label for every k."""
    return labels.join(df.repartition("id"), "id")


def ward_nested(spark, sf_dir):
    """Cluster sizes for k = 8 to 16, from one merge sequence."""
    labels = ward_clusters(_points(spark, sf_dir), KS)
    return labels.groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("n"))


def ward_stats(spark, sf_dir):
    """Statistics of the clusters for k = 8 to 16, as report lines."""
    labels = store(ward_clusters(_points(spark, sf_dir), KS), "ward")
    return stats_report(cluster_stats(_labelled(labels, _points(spark, sf_dir)), ["k", "cluster"]))


def ward_check(spark, sf_dir):
    """For each k the clusters, their points, and how many lie in several clusters of k - 1."""
    labels = store(ward_clusters(_points(spark, sf_dir), KS), "ward")
    sizes = cluster_stats(_labelled(labels, _points(spark, sf_dir)), ["k", "cluster"])
    sizes = sizes.groupBy("k").agg(F.count(F.lit(1)).alias("n_clusters"), F.sum("n").alias("n_points"))
    coarse = labels.select("id", (F.col("k") + 1).alias("k"), F.col("cluster").alias("outer"))
    split = labels.join(coarse, ["id", "k"]).groupBy("k", "cluster").agg(F.countDistinct("outer").alias("outers"))
    split = split.groupBy("k").agg(F.count_if(F.col("outers") > 1).alias("n_split"))
    return sizes.join(split, "k", "left").select("k", "n_clusters", "n_points", F.coalesce("n_split", F.lit(0).cast("long")).alias("n_split"))


QUERIES = {
    "bfr_run": bfr_run,
    "bfr_log": bfr_log,
    "bfr_totals": bfr_totals,
    "bfr_conserved": bfr_conserved,
    "bfr_stream": bfr_stream,
    "bfr_stream_conserved": bfr_stream_conserved,
    "bfr_bounded": bfr_bounded,
    "ward_nested": ward_nested,
    "ward_stats": ward_stats,
    "ward_check": ward_check,
}
_CHUNKED = f"""r AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, greatest({LEAST}, ceil(count(*) OVER () / {CHUNKS})) AS size FROM embeddings),
c AS (SELECT CAST(floor(r / size) AS BIGINT) AS chunk, count(*) AS n_points FROM r GROUP BY 1)"""
_CONSERVED = """WITH flat AS (
  SELECT unnest(range(64)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT CAST(pos AS INTEGER) AS pos, count(*) AS n, round(sum(x), 6) AS sum, round(sum(x * x), 6) AS sumsq,
  CAST(0 AS BIGINT) AS n_wrong FROM flat GROUP BY 1"""

ORACLES = {
    "bfr_totals": f"""WITH {_CHUNKED}
SELECT chunk, n_points, CAST(sum(n_points) OVER (ORDER BY chunk) AS BIGINT) AS n_total FROM c""",
    "bfr_bounded": f"WITH {_CHUNKED} SELECT chunk, n_points, true AS cs_bounded FROM c",
    "bfr_conserved": _CONSERVED,
    "bfr_stream_conserved": _CONSERVED,
    "ward_check": f"""SELECT CAST(k AS INTEGER) AS k, k AS n_clusters, (SELECT count(*) FROM embeddings) AS n_points,
  CAST(0 AS BIGINT) AS n_split FROM (SELECT unnest(range({KS.start}, {KS.stop})) AS k)""",
}
