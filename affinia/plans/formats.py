"""Queries that write a table in a supported format and read it back."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from affinia.operators import profile as prof
from affinia.operators.bfr import Bfr
from affinia.operators.graph import recommend_friends
from affinia.operators.recommend import predict_pairs, recommend_items
from affinia.operators.skew import ranked
from affinia.plans.baskets import ORACLES as BASKET_ORACLES
from affinia.plans.baskets import QUERIES as BASKET_QUERIES
from affinia.plans.clusters import ORACLES as CLUSTER_ORACLES
from affinia.plans.clusters import QUERIES as CLUSTER_QUERIES
from affinia.plans.clusters import members
from affinia.plans.recommend import NEAR_SQL, near_items, raw_ratings, split_ratings, titles
from affinia.plans.graph import ORACLES as GRAPH_ORACLES
from affinia.plans.study import ORACLES as STUDY_ORACLES
from affinia.plans.study import QUERIES as STUDY_QUERIES
from affinia.plans.tables import GRAPH_SQL, graph, points, table
from affinia.session import scratch_path
from affinia.sources import readers, writers

STATISTICS = ("mean", "std", "min", "max")


def src_adjacency(spark, sf_dir):
    path = scratch_path(spark, "adjacency")
    writers.write_adjacency(*graph(spark, sf_dir), path)
    vertices, edges, _ = readers.read_adjacency(spark, path)
    return vertices.join(edges, vertices["id"] == edges["src"], "left").select("id", F.col("dst").alias("friend"))


def src_transactions(spark, sf_dir):
    path = scratch_path(spark, "transactions")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    rows = lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.lit("").alias("START"),
        F.lit("").alias("STOP"),
        F.col("l_orderkey").cast("string").alias("PATIENT"),
        F.lit("").alias("ENCOUNTER"),
        F.col("p_brand").alias("CODE"),
        F.concat(F.col("p_type"), F.lit(', "quoted", with comma')).alias("DESCRIPTION"),
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return readers.read_transactions(spark, path).rows


def src_features(spark, sf_dir):
    """Vectors under three header lines; the components of one statistic are read back."""
    path = scratch_path(spark, "features")
    heads = [
        ",".join(["feature", *[f"band{i // 4:02d}" for i in range(64)]]),
        ",".join(["statistics", *[STATISTICS[i % 4] for i in range(64)]]),
        ",".join(["number", *["01"] * 64]),
    ]
    lines = points(spark, sf_dir).select(
        F.concat_ws(",", F.col("id").cast("string"), F.col("features").cast("array<string>")).alias("value")
    )
    head = spark.createDataFrame([(h,) for h in heads], "value string").coalesce(1)
    head.unionByName(lines).write.text(path)
    names = readers.read_feature_names(spark, path)
    kept = readers.statistic_features(readers.read_features(spark, path).rows, names, "mean")
    return kept.select("id", F.posexplode("features").alias("pos", "x"))


def src_ratings(spark, sf_dir):
    """Order lines as ratings, with `::` and no header, and as CSV with header."""
    rows = raw_ratings(spark, sf_dir).withColumn(
        "ts", F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    )
    colons, commas = scratch_path(spark, "ratings"), scratch_path(spark, "ratings")
    rows.select(F.concat_ws("::", *[F.col(c).cast("string") for c in rows.columns]).alias("value")).write.text(colons)
    rows.write.option("header", True).csv(commas)
    read = [
        readers.read_ratings(spark, colons).rows.withColumn("format", F.lit("colons")),
        readers.read_ratings(spark, commas, ",", rows.columns).rows.withColumn("format", F.lit("commas")),
    ]
    return read[0].unionByName(read[1])


def src_items(spark, sf_dir):
    path = scratch_path(spark, "items")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    rows.select(F.concat_ws("::", *[F.col(c).cast("string") for c in rows.columns]).alias("value")).write.text(path)
    return readers.read_items(spark, path).rows


def src_labels(spark, sf_dir):
    """Documents as a table with a two-line header, their titles broken over three lines."""
    path = scratch_path(spark, "labels")
    rows = table(spark, sf_dir, "documents").select(
        F.concat_ws(",", F.col("doc_id").cast("string"), F.lit('"a, ""b""\n\nc"'), F.col("lang"), F.col("source")).alias("value")
    )
    heads = [(",album,set,track",), (",title,subset,genre_top",), ("track_id,,,",)]
    head = spark.createDataFrame(heads, "value string").coalesce(1)
    head.unionByName(rows).write.text(path)
    return readers.read_labels(spark, path).rows


def src_assignments(spark, sf_dir):
    path = scratch_path(spark, "assignments")
    assigned = points(spark, sf_dir).select(
        "id", F.lit("DS").alias("kind"), F.col("label").cast("string").alias("cluster")
    )
    writers.write_assignments(assigned, path)
    return readers.read_assignments(spark, path)


def src_labelled(spark, sf_dir):
    path = scratch_path(spark, "labelled")
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    rows = labels.join(docs, "doc_id").select("toxic", "n_chars", F.col("quality").alias("Label"))
    rows.write.option("header", True).csv(path)
    found = readers.read_labelled(spark, path, columns=rows.columns).rows
    values = vector_to_array("features")
    return found.select("label", values[0].alias("toxic"), values[1].alias("n_chars"))


def sink_recommendations(spark, sf_dir):
    path = scratch_path(spark, "recommendations")
    writers.write_recommendations(recommend_friends(*graph(spark, sf_dir)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def sink_predictions(spark, sf_dir):
    """Top 10 of the held-out pairs as CSV, read back as text columns."""
    path = scratch_path(spark, "predictions")
    train, held_out = split_ratings(spark, sf_dir)
    predictions = predict_pairs(held_out, train, near_items(train))
    writers.write_predictions(recommend_items(predictions, titles(spark, sf_dir)), path)
    schema = "`UserID` string, `MovieID` string, `Movie Name` string, `Predicted Rating` string"
    read = spark.read.csv(path, schema=schema, header=True, escape='"')
    return read.toDF("user_id", "movie_id", "movie_name", "predicted_rating")


def _lines_in_order(spark, path):
    """`(position, line)` of a text sink: its files by name, their lines as they stand."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place")
    )
    return ranked(lines, [], ["file", "place"], "position").select(F.col("position").cast("long").alias("position"), "line")


def sink_itemsets(spark, sf_dir):
    path = scratch_path(spark, "itemset_report")
    writers.write_itemset_report(BASKET_QUERIES["itemset_report"](spark, sf_dir), path)
    return _lines_in_order(spark, path)


def sink_stats(spark, sf_dir):
    path = scratch_path(spark, "stats_report")
    writers.write_stats_report(CLUSTER_QUERIES["cluster_report"](spark, sf_dir), path)
    return _lines_in_order(spark, path)


def sink_profile(spark, sf_dir):
    """Labels of clusters of which two have numbers: these come first, by number."""
    path = scratch_path(spark, "profile_report")
    assigned, labels = members(spark, sf_dir)
    cluster = F.when(F.col("cluster") == "en", F.lit("10")).when(F.col("cluster") == "de", F.lit("9"))
    counts = prof.label_counts(assigned.withColumn("cluster", F.coalesce(cluster, "cluster")), labels)
    writers.write_profile_report(prof.profile_report(prof.profile_clusters(counts)), path)
    return _lines_in_order(spark, path)


def sink_run_log(spark, sf_dir):
    """The log of a run that begins with given sets: embeddings in whole numbers, five labels a kind."""
    path = scratch_path(spark, "run_log")
    whole = F.transform("features", lambda x: F.floor(x * 100).cast("double"))
    members = points(spark, sf_dir).select(
        "id", whole.alias("features"), F.when(F.col("label") < 5, F.lit("DS")).otherwise(F.lit("CS")).alias("kind"),
        F.col("label").cast("string").alias("cluster"),
    )
    bfr = Bfr(spark)
    bfr.restore(members)
    clusters, retained = bfr.tables(0)
    writers.write_run_log(bfr.report(0), clusters, retained, path)
    # sums are whole numbers but for their last bits
    pattern = r"^(  Cluster .*SUM\[:3\]=\[)(.*)(\], SUMSQ\[:3\]=\[)(.*)(\])$"
    groups = [F.regexp_extract("line", pattern, i) for i in range(1, 6)]
    whole = [F.concat_ws(" ", F.transform(F.split(g, " "), lambda x: F.round(x.try_cast("double")).cast("long").cast("string"))) for g in groups]
    line = F.concat(groups[0], whole[1], groups[2], whole[3], groups[4])
    lines = _lines_in_order(spark, path)
    return lines.withColumn("line", F.when(F.col("line").rlike(pattern), line).otherwise(F.col("line")))


def sink_study(spark, sf_dir):
    """The metrics of each fold as a table of rows."""
    path = scratch_path(spark, "study")
    writers.write_study(STUDY_QUERIES["cv_metrics"](spark, sf_dir), path)
    return spark.read.parquet(path)


def sink_csv(spark, sf_dir):
    """Parts as sorted CSV, read back in the order of the files."""
    path = scratch_path(spark, "csv")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(', "x"')).alias("name"), "p_size")
    writers.write_csv(parts, path, [F.desc("p_size"), "p_partkey"])
    rows = spark.read.csv(path, header=True, escape='"', schema="p_partkey long, name string, p_size int")
    rows = rows.select("*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place"))
    placed = ranked(rows, [], ["file", "place"], "position")
    return placed.select(F.col("position").cast("long").alias("position"), "p_partkey", "name", "p_size")


def src_rejects(spark, sf_dir):
    """Rows and rejected lines of each reader where bad lines stand among good ones."""
    ids = points(spark, sf_dir).select("id")
    number = F.col("id").cast("string")

    def written(name, good, *others):
        path = scratch_path(spark, f"bad_{name}")
        fixed = spark.range(1).select(F.explode(F.array(*map(F.lit, others))).alias("value")).coalesce(1)
        fixed.union(ids.select(good.alias("value"))).write.text(path)
        return path

    adjacency = readers.read_adjacency(spark, written("adjacency", F.concat(number, F.lit("\t1,2")), "x\t1", "3\ty", ""))
    found = {
        "adjacency": readers.Rows(adjacency.vertices, adjacency.rejects),
        "features": readers.read_features(
            spark, written("features", F.concat(number, F.lit(",1.5,2")), "feature,a,a", "statistics,mean,std", "x9,4.0,5.0", ",6.0,7.0", "1,,2")
        ),
        "labels": readers.read_labels(
            spark, written("labels", F.concat(number, F.lit(',"a\n b",small,Rock')), ",album,set,track", ",title,subset,genre_top", "track_id,,,", ",x,y,z", "bad,c,large,")
        ),
        "labelled": readers.read_labelled(
            spark, written("labelled", F.concat(number, F.lit(",2,1")), "p1,p2,Label", "1,,0", ",1,1", "1,oops,0", ""), columns=["p1", "p2", "Label"]
        ),
        "ratings": readers.read_ratings(spark, written("ratings", F.concat(number, F.lit("::10::4.5::9")), "2::10::x::1", "  ")),
    }
    n = F.count(F.lit(1))
    counts = [
        found[name].rows.agg(n.alias("n_rows")).select(
            F.lit(name).alias("reader"), "n_rows", found[name].rejects.agg(n).scalar().alias("n_rejects")
        )
        for name in found
    ]
    every = counts[0]
    for part in counts[1:]:
        every = every.union(part)
    return every


QUERIES = {
    "src_rejects": src_rejects,
    "sink_run_log": sink_run_log,
    "sink_study": sink_study,
    "sink_csv": sink_csv,
    "sink_itemsets": sink_itemsets,
    "sink_stats": sink_stats,
    "sink_profile": sink_profile,
    "src_adjacency": src_adjacency,
    "src_transactions": src_transactions,
    "src_features": src_features,
    "src_ratings": src_ratings,
    "src_items": src_items,
    "src_labels": src_labels,
    "src_assignments": src_assignments,
    "src_labelled": src_labelled,
    "sink_recommendations": sink_recommendations,
    "sink_predictions": sink_predictions,
}

_RAW = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_RATING_ROW = 'o_custkey AS "user", l_suppkey AS item, l_quantity / 10 AS rating, CAST(epoch(l_shipdate) AS BIGINT) AS ts'

_HEADS = "(0, -1, '=== Frequent Itemsets Analysis ==='), (0, 0, ''), " + ", ".join(
    f"({k}, -1, ''), ({k}, 0, 'Top 10 frequent itemsets of size {k}:')" for k in (1, 2, 3)
)
_NUMBERED = CLUSTER_ORACLES["profile_report"].replace("lang AS cluster", "CASE lang WHEN 'en' THEN '10' WHEN 'de' THEN '9' ELSE lang END AS cluster")

ORACLES = {
    "src_rejects": " UNION ALL ".join(
        f"SELECT '{name}' AS reader, count(*) AS n_rows, CAST({bad} AS BIGINT) AS n_rejects FROM embeddings"
        for name, bad in (("adjacency", 3), ("features", 3), ("labels", 2), ("labelled", 4), ("ratings", 2))
    ),
    "sink_run_log": """WITH x AS (
  SELECT label, CASE WHEN label < 5 THEN 2 ELSE 3 END AS part, list_transform(embedding[1:3], lambda v: floor(v::DOUBLE * 100)) AS f FROM embeddings),
s AS (SELECT part, label::VARCHAR AS name, count(*) AS n, [sum(f[1]), sum(f[2]), sum(f[3])]::BIGINT[] AS s,
  [sum(f[1] * f[1]), sum(f[2] * f[2]), sum(f[3] * f[3])]::BIGINT[] AS q FROM x GROUP BY part, label),
c AS (SELECT count(*) FILTER (part = 2) AS ds, coalesce(sum(n) FILTER (part = 2), 0)::BIGINT AS dp, count(*) FILTER (part = 3) AS cs,
  coalesce(sum(n) FILTER (part = 3), 0)::BIGINT AS cp FROM s),
fixed AS (SELECT unnest([
  {'part': 0, 'place': 0, 'line': ''}, {'part': 0, 'place': 1, 'line': '=== Initialization ==='},
  {'part': 0, 'place': 2, 'line': 'Points in this chunk: ' || (dp + cp)}, {'part': 0, 'place': 3, 'line': 'DS clusters: ' || ds || ' (' || dp || ' points)'},
  {'part': 0, 'place': 4, 'line': 'CS clusters: ' || cs || ' (' || cp || ' points)'}, {'part': 0, 'place': 5, 'line': 'RS points: 0'},
  {'part': 1, 'place': 0, 'line': ''}, {'part': 1, 'place': 1, 'line': '=== FINAL REPORT ==='}, {'part': 1, 'place': 2, 'line': 'DS clusters: ' || ds},
  {'part': 1, 'place': 3, 'line': 'CS clusters: ' || cs}, {'part': 1, 'place': 4, 'line': 'RS points: 0'},
  {'part': 2, 'place': -1, 'line': ''}, {'part': 2, 'place': 0, 'line': 'Discard Set (DS) contains ' || ds || ' clusters:'},
  {'part': 3, 'place': -1, 'line': ''}, {'part': 3, 'place': 0, 'line': 'Compression Set (CS) contains ' || cs || ' clusters:'}]) AS r FROM c),
every AS (SELECT r.part AS part, r.place AS place, '' AS name, r.line AS line FROM fixed UNION ALL
  SELECT part, 1, name, '  Cluster ' || name || ': N=' || n || ', SUM[:3]=[' || array_to_string(s, ' ') || '], SUMSQ[:3]=[' || array_to_string(q, ' ') || ']' FROM s)
SELECT row_number() OVER (ORDER BY part, place, name) AS position, line FROM every""",
    "sink_study": STUDY_ORACLES["cv_metrics"],
    "sink_csv": """SELECT row_number() OVER (ORDER BY p_size DESC, p_partkey) AS position, p_partkey, p_name || ', "x"' AS name, p_size FROM part""",
    "sink_itemsets": f"""WITH r AS (
  SELECT section, rank, line FROM ({BASKET_ORACLES["itemset_report"]})
  UNION ALL SELECT * FROM (VALUES {_HEADS}) h(section, rank, line))
SELECT row_number() OVER (ORDER BY section, rank) AS position, line FROM r""",
    "sink_stats": f"""WITH r AS (SELECT k, cluster AS place, line FROM ({CLUSTER_ORACLES["cluster_report"]})),
every AS (
  SELECT k, place, line FROM r UNION ALL SELECT DISTINCT k, -2, '' FROM r
  UNION ALL SELECT DISTINCT k, -1, '=== Clustering with k = ' || k || ' ===' FROM r)
SELECT row_number() OVER (ORDER BY k, place) AS position, line FROM every""",
    "sink_profile": f"""WITH r AS ({_NUMBERED})
SELECT row_number() OVER (ORDER BY try_cast(cluster AS BIGINT) NULLS LAST, cluster, place) AS position, line FROM r""",
    "src_adjacency": f"WITH {GRAPH_SQL} SELECT p_partkey AS id, dst AS friend FROM part LEFT JOIN edges ON src = p_partkey",
    "src_transactions": """SELECT CAST(l_orderkey AS VARCHAR) AS basket, p_brand AS item,
  p_type || ', "quoted", with comma' AS description FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "src_features": """SELECT vec_id AS id, CAST(pos AS INTEGER) AS pos, CAST(embedding[4 * pos + 1] AS DOUBLE) AS x
FROM embeddings, (SELECT unnest(range(16)) AS pos)""",
    "src_ratings": f"SELECT 'colons' AS format, {_RATING_ROW} {_RAW} UNION ALL SELECT 'commas', {_RATING_ROW} {_RAW}",
    "src_items": "SELECT p_partkey AS item, p_name AS title, p_type AS genres FROM part",
    "src_labels": "SELECT doc_id AS id, lang AS subset, source AS label FROM documents",
    "src_assignments": "SELECT vec_id AS id, 'DS' AS kind, CAST(label AS VARCHAR) AS cluster FROM embeddings",
    "src_labelled": """SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS toxic,
  CAST(n_chars AS DOUBLE) AS n_chars FROM labels JOIN documents USING (doc_id)""",
    "sink_recommendations": f"""SELECT CAST(id AS VARCHAR) || chr(9) || recs AS line
FROM ({GRAPH_ORACLES["friend_recommendations"]})""",
    "sink_predictions": f"""WITH {NEAR_SQL},
scored AS (
  SELECT v.u, v.i, sum(s * n.rating) / sum(abs(s)) AS p
  FROM val v JOIN near ON v.i = near.i JOIN train n ON n.u = v.u AND n.i = near.j GROUP BY 1, 2),
top AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY round(p, 6) DESC, i) AS r FROM scored)
SELECT CAST(u AS VARCHAR) AS user_id, CAST(i AS VARCHAR) AS movie_id, s_name AS movie_name,
  printf('%.4f', p) AS predicted_rating
FROM top LEFT JOIN supplier ON s_suppkey = i WHERE r <= 10""",
}
