"""Queries over clustered points and the labels of cluster members."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinia.functions.vectors import centroid
from affinia.operators import profile as prof
from affinia.operators import summaries as summ
from affinia.operators.bfr import Bfr, BfrSettings
from affinia.plans.tables import points, table

ASSIGN_ALPHA = 1.0
MERGE_ALPHA = 0.2
SUBSET = "en"


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def cluster_summary(spark, sf_dir):
    summary = summ.summarise(points(spark, sf_dir), ["label"])
    flat = summary.select(
        F.col("label").alias("cluster"), "n", F.posexplode(F.arrays_zip("sum", "sumsq")).alias("pos", "v")
    )
    return _rounded(
        flat.select("cluster", "pos", "n", F.col("v.sum").alias("sum"), F.col("v.sumsq").alias("sumsq")),
        "sum",
        "sumsq",
    )


STATS = ("radius", "diameter", "density_r", "density_d")


def cluster_stats(spark, sf_dir):
    stats = summ.cluster_stats(points(spark, sf_dir), ["label"])
    return _rounded(stats.withColumnRenamed("label", "cluster"), *STATS)


def _two_clusterings(spark, sf_dir):
    """The same points grouped into 10 and into 5 clusters."""
    both = F.array(
        F.struct(F.lit(10).alias("k"), F.col("label").alias("cluster")),
        F.struct(F.lit(5).alias("k"), (F.col("label") % 5).alias("cluster")),
    )
    df = points(spark, sf_dir).select("features", F.inline(both))
    return summ.cluster_stats(df, ["k", "cluster"])


def cluster_stats_by_k(spark, sf_dir):
    return _rounded(summ.stats_by_k(_two_clusterings(spark, sf_dir)), *STATS)


def cluster_report(spark, sf_dir):
    return summ.stats_report(_two_clusterings(spark, sf_dir))


def mahalanobis_assign(spark, sf_dir):
    """Every point against the summaries of all labels, not only its own."""
    df = points(spark, sf_dir)
    summary = summ.summarise(df, ["label"])
    near = summ.nearest_cluster(df.select("id", "features"), summary, ASSIGN_ALPHA, "label")
    return _rounded(near.select(F.col("id").alias("vec_id"), "cluster", "distance"), "distance")


def bfr_merge(spark, sf_dir):
    """Labels 5 to 9 as compressed clusters, merged into labels 0 to 4 where near enough."""
    summary = summ.summarise(points(spark, sf_dir), ["label"])
    ds, cs = summary.filter(F.col("label") < 5), summary.filter(F.col("label") >= 5)
    centers = cs.select(
        F.col("label").alias("cs"), "n", centroid(F.col("n"), F.col("sum")).alias("features")
    )
    near = summ.nearest_cluster(centers, ds, MERGE_ALPHA, "label")
    sizes = ds.select(F.col("label").alias("cluster"), F.col("n").alias("n_ds"))
    return near.join(sizes, "cluster", "left").select(
        "cs", F.col("cluster").alias("ds"), (F.col("n") + F.coalesce("n_ds", F.lit(0))).alias("n_total")
    )


OFFSET = 1e8


def mahalanobis_offset(spark, sf_dir):
    """The nearest cluster with a large number added to every feature, and whether its distance
    is the one without it (to three decimals, the features having lost seven of theirs)."""
    plain = mahalanobis_assign(spark, sf_dir).select("vec_id", F.col("distance").alias("plain"))
    df = points(spark, sf_dir).withColumn("features", F.transform("features", lambda x: x + F.lit(OFFSET)))
    near = summ.nearest_cluster(df.select("id", "features"), summ.summarise(df, ["label"]), ASSIGN_ALPHA, "label")
    moved = near.select(F.col("id").alias("vec_id"), "cluster", "distance")
    close = F.coalesce(F.abs(F.col("distance") - F.col("plain")) < 1e-3, F.col("distance").isNull() & F.col("plain").isNull())
    return moved.join(plain, "vec_id").select("vec_id", "cluster", close.alias("close"))


def bfr_finish(spark, sf_dir):
    """The last step of BFR from given sets: labels 0 to 4 as DS, 5 to 9 as CS."""
    bfr = Bfr(spark, settings=BfrSettings(alpha=MERGE_ALPHA))
    kind = F.when(F.col("label") < 5, F.lit("DS")).otherwise(F.lit("CS"))
    name = F.col("label").cast("string")
    members = points(spark, sf_dir).select("id", "features", kind.alias("kind"), name.alias("cluster"))
    bfr.restore(members)
    clusters, assigned, _ = bfr.finish(0)
    moved = assigned.groupBy("kind", "cluster").agg(F.count(F.lit(1)).alias("n_assigned"))
    return clusters.join(moved, ["kind", "cluster"], "left").select(
        "kind", "cluster", "n", "n_assigned", F.round(F.col("sum")[0], 6).alias("sum0"), F.round(F.col("sumsq")[0], 6).alias("sumsq0")
    )


def chunk_counts(spark, sf_dir):
    chunk = F.floor(F.col("id") / 100).alias("chunk")
    return points(spark, sf_dir).groupBy(chunk).agg(F.count(F.lit(1)).alias("n"))


def members(spark, sf_dir):
    docs, labelled = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id")
    known = labelled.select("doc_id", F.lit(True).alias("known"))
    labels = docs.join(known, "doc_id", "left").select(
        F.col("doc_id").alias("id"), F.when(F.col("known"), F.col("source")).alias("label")
    )
    return docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("cluster")), labels


def _counts(spark, sf_dir):
    return prof.label_counts(*members(spark, sf_dir))


def profile_counts(spark, sf_dir):
    return _counts(spark, sf_dir).filter(F.col("label").isNotNull())


def profile_missing(spark, sf_dir):
    return prof.missing_counts(_counts(spark, sf_dir))


def profile_top_labels(spark, sf_dir):
    return prof.profile_clusters(_counts(spark, sf_dir))


def profile_report(spark, sf_dir):
    return prof.profile_report(prof.profile_clusters(_counts(spark, sf_dir)))


def profile_coverage(spark, sf_dir):
    return prof.coverage(*members(spark, sf_dir))


def _documents_with_labels(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def table_profile(spark, sf_dir):
    return prof.table_profile(_documents_with_labels(spark, sf_dir))


def table_preview(spark, sf_dir):
    df = _documents_with_labels(spark, sf_dir).select("doc_id", "lang", "source", "quality", "toxic")
    return prof.preview(df, 5, "doc_id")


def drop_incomplete(spark, sf_dir):
    df = _documents_with_labels(spark, sf_dir).select("doc_id", "quality", "toxic")
    return prof.complete_rows(df).select("doc_id", "quality")


STATISTICS = ("mean", "std", "min", "max")


def subset_mean_features(spark, sf_dir):
    """Vectors as flat named columns; the `mean` columns of members of one subset."""
    wide = points(spark, sf_dir).select(
        "id",
        *[
            F.col("features")[i].alias(f"band{i // 4:02d}__{STATISTICS[i % 4]}__01")
            for i in range(64)
        ],
    )
    membership = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("subset")
    )
    members = prof.in_subset(wide, membership, SUBSET)
    return members.select("id", *prof.statistic_columns(members, "mean"))


_FLAT = """flat AS (
  SELECT vec_id, label, unnest(range(64)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
summary AS (
  SELECT label, pos, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM flat GROUP BY 1, 2)
"""
_STATS_OF = """pts AS (
  SELECT vec_id, k, CASE WHEN k = 10 THEN label ELSE label % 5 END AS cluster, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings, (SELECT unnest([10, 5]) AS k)),
pairwise AS (
  SELECT a.k, a.cluster, avg(pow(list_distance(a.v, b.v), 2)) AS d2
  FROM pts a JOIN pts b ON a.k = b.k AND a.cluster = b.cluster AND a.vec_id < b.vec_id GROUP BY 1, 2),
dims AS (SELECT k, cluster, vec_id, unnest(range(64)) AS pos, unnest(v) AS x FROM pts),
centers AS (SELECT k, cluster, pos, avg(x) AS c FROM dims GROUP BY 1, 2, 3),
sizes AS (SELECT k, cluster, count(*) AS n FROM pts GROUP BY 1, 2),
around AS (
  SELECT k, cluster, sum(pow(x - c, 2)) AS ss FROM dims JOIN centers USING (k, cluster, pos) GROUP BY 1, 2),
stats AS (
  SELECT k, cluster, n, sqrt(ss / n) AS radius, sqrt(coalesce(d2, 0)) AS diameter,
         CASE WHEN ss > 0 THEN n / (ss / n) ELSE 0 END AS density_r,
         CASE WHEN d2 > 0 THEN n / d2 ELSE 0 END AS density_d
  FROM sizes JOIN around USING (k, cluster) LEFT JOIN pairwise USING (k, cluster))
"""
_ROUND4 = ", ".join(f"round({c}, 6) AS {c}" for c in STATS)
_MEMBERS = """members AS (
  SELECT lang AS cluster, CASE WHEN l.doc_id IS NOT NULL THEN source END AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
counts AS (SELECT cluster, label, count(*) AS n FROM members WHERE label IS NOT NULL GROUP BY 1, 2),
gaps AS (SELECT cluster, count(*) AS n_missing FROM members WHERE label IS NULL GROUP BY 1),
top AS (
  SELECT cluster, CAST(rank AS INTEGER) AS rank, label, n FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS rank FROM counts)
  WHERE rank <= 5),
profile AS (
  SELECT coalesce(top.cluster, gaps.cluster) AS cluster, rank, label, n, coalesce(n_missing, 0) AS n_missing
  FROM top FULL JOIN gaps ON top.cluster = gaps.cluster)
"""
_PROFILE_COLUMNS = {
    "doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
    "n_chars": "bigint", "quality": "int", "toxic": "int",
}

QUERIES = {
    "cluster_summary": cluster_summary,
    "cluster_stats": cluster_stats,
    "cluster_stats_by_k": cluster_stats_by_k,
    "cluster_report": cluster_report,
    "mahalanobis_assign": mahalanobis_assign,
    "mahalanobis_offset": mahalanobis_offset,
    "bfr_merge": bfr_merge,
    "bfr_finish": bfr_finish,
    "chunk_counts": chunk_counts,
    "profile_counts": profile_counts,
    "profile_missing": profile_missing,
    "profile_top_labels": profile_top_labels,
    "profile_report": profile_report,
    "profile_coverage": profile_coverage,
    "table_profile": table_profile,
    "table_preview": table_preview,
    "drop_incomplete": drop_incomplete,
    "subset_mean_features": subset_mean_features,
}

_MERGED = """
dist AS (
  SELECT c.label AS cs, d.label AS ds,
    sqrt(sum(pow(c.s / c.n - d.s / d.n, 2) / greatest(d.q / d.n - pow(d.s / d.n, 2), 1e-10))) AS dd
  FROM summary c JOIN summary d ON c.pos = d.pos WHERE c.label >= 5 AND d.label < 5 GROUP BY 1, 2),
best AS (SELECT cs, ds FROM (
  SELECT *, row_number() OVER (PARTITION BY cs ORDER BY dd, ds) AS r FROM dist WHERE dd < {alpha} * 8) WHERE r = 1)"""

ORACLES = {
    "mahalanobis_offset": f"""WITH {_FLAT},
dist AS (
  SELECT vec_id, m.label, sqrt(sum(pow(x - s / n, 2) / greatest(q / n - pow(s / n, 2), 1e-10))) AS d
  FROM flat f JOIN summary m ON f.pos = m.pos GROUP BY 1, 2),
best AS (SELECT vec_id, label FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS r FROM dist WHERE d < {ASSIGN_ALPHA} * 8)
  WHERE r = 1)
SELECT e.vec_id, b.label AS cluster, true AS close FROM embeddings e LEFT JOIN best b ON e.vec_id = b.vec_id""",
    "bfr_finish": f"""WITH {_FLAT}, {_MERGED.format(alpha=MERGE_ALPHA)},
named AS (
  SELECT CASE WHEN label < 5 OR ds IS NOT NULL THEN 'DS' ELSE 'CS' END AS kind,
    CAST(coalesce(ds, label) AS VARCHAR) AS cluster, n, s, q
  FROM summary LEFT JOIN best ON cs = label WHERE pos = 0)
SELECT kind, cluster, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) AS BIGINT) AS n_assigned,
  round(sum(s), 6) AS sum0, round(sum(q), 6) AS sumsq0 FROM named GROUP BY 1, 2""",
    "cluster_summary": f"""WITH {_FLAT} SELECT label AS cluster, CAST(pos AS INTEGER) AS pos, n,
  round(s, 6) AS sum, round(q, 6) AS sumsq FROM summary""",
    "cluster_stats": f"WITH {_STATS_OF} SELECT cluster, n, {_ROUND4} FROM stats WHERE k = 10",
    "cluster_stats_by_k": f"""WITH {_STATS_OF}, means AS (
  SELECT k, {", ".join(f"avg({c}) AS {c}" for c in STATS)} FROM stats GROUP BY 1)
SELECT k, {_ROUND4} FROM means""",
    "cluster_report": f"""WITH {_STATS_OF} SELECT k, cluster, 'Cluster ' || cluster || printf(
  ': size=%d, radius=%.2f, diameter=%.2f, density_r=%.2f, density_d=%.2f',
  n, radius, diameter, density_r, density_d) AS line FROM stats""",
    "mahalanobis_assign": f"""WITH {_FLAT},
dist AS (
  SELECT vec_id, m.label, sqrt(sum(pow(x - s / n, 2) / greatest(q / n - pow(s / n, 2), 1e-10))) AS d
  FROM flat f JOIN summary m ON f.pos = m.pos GROUP BY 1, 2),
best AS (SELECT vec_id, label, d FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS r FROM dist WHERE d < {ASSIGN_ALPHA} * 8)
  WHERE r = 1)
SELECT e.vec_id, b.label AS cluster, round(b.d, 6) AS distance
FROM embeddings e LEFT JOIN best b ON e.vec_id = b.vec_id""",
    "bfr_merge": f"""WITH {_FLAT},
dist AS (
  SELECT c.label AS cs, d.label AS ds,
    sqrt(sum(pow(c.s / c.n - d.s / d.n, 2) / greatest(d.q / d.n - pow(d.s / d.n, 2), 1e-10))) AS dd
  FROM summary c JOIN summary d ON c.pos = d.pos WHERE c.label >= 5 AND d.label < 5 GROUP BY 1, 2),
best AS (SELECT cs, ds FROM (
  SELECT *, row_number() OVER (PARTITION BY cs ORDER BY dd, ds) AS r FROM dist WHERE dd < {MERGE_ALPHA} * 8) WHERE r = 1),
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT s.label AS cs, b.ds, s.n + coalesce(t.n, 0) AS n_total
FROM sizes s LEFT JOIN best b ON s.label = b.cs LEFT JOIN sizes t ON b.ds = t.label WHERE s.label >= 5""",
    "chunk_counts": "SELECT CAST(floor(vec_id / 100) AS BIGINT) AS chunk, count(*) AS n FROM embeddings GROUP BY 1",
    "profile_counts": f"WITH {_MEMBERS} SELECT cluster, label, n FROM counts",
    "profile_missing": f"WITH {_MEMBERS} SELECT cluster, n_missing FROM gaps",
    "profile_top_labels": f"WITH {_MEMBERS} SELECT cluster, rank, label, n, n_missing FROM profile",
    "profile_report": f"""WITH {_MEMBERS}
SELECT DISTINCT cluster, 0 AS place, 'Cluster ' || cluster || ':' AS line FROM profile
UNION ALL SELECT cluster, rank, '  ' || label || ': ' || n || ' songs' FROM top
UNION ALL SELECT cluster, 1000000, '  ( with no genre): ' || n_missing || ' songs' FROM gaps
UNION ALL SELECT DISTINCT cluster, 1000001, '' FROM profile""",
    "profile_coverage": """SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS assigned_ids,
  (SELECT count(DISTINCT doc_id) FROM documents) AS label_ids,
  (SELECT count(source) FROM documents JOIN labels USING (doc_id)) AS labelled""",
    "table_profile": "WITH j AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS n_rows, count({c}) AS n_non_null FROM j"
        for c, t in _PROFILE_COLUMNS.items()
    ),
    "table_preview": """SELECT d.doc_id, lang, source, quality, toxic FROM documents d
  LEFT JOIN labels l ON d.doc_id = l.doc_id ORDER BY d.doc_id LIMIT 5""",
    "drop_incomplete": """SELECT d.doc_id, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id
  WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
    "subset_mean_features": "SELECT vec_id AS id, "
    + ", ".join(f"CAST(embedding[{4 * b + 1}] AS DOUBLE) AS band{b:02d}__mean__01" for b in range(16))
    + f" FROM embeddings WHERE EXISTS (SELECT 1 FROM documents WHERE doc_id = vec_id AND lang = '{SUBSET}')",
}
