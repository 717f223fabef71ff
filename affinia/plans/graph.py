"""Queries over the part graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinia.operators.graph import mutual_neighbours, recommend_friends
from affinia.plans.tables import GRAPH_SQL, graph


def mutual_friends(spark, sf_dir):
    _, edges = graph(spark, sf_dir)
    return mutual_neighbours(edges)


def friend_recommendations(spark, sf_dir):
    vertices, edges = graph(spark, sf_dir)
    recs = recommend_friends(vertices, edges)
    return recs.select("id", F.concat_ws(",", F.col("recs").cast("array<string>")).alias("recs"))


def friends_past_hubs(spark, sf_dir):
    """The same lists where every part with more than a hundred paths counts as a hub: hundreds of them."""
    vertices, edges = graph(spark, sf_dir)
    recs = recommend_friends(vertices, edges, hub_paths=100, block_bytes=1 << 16)
    return recs.select("id", F.concat_ws(",", F.col("recs").cast("array<string>")).alias("recs"))


_TOP = f"""WITH {GRAPH_SQL},
paths AS (
  SELECT f.src, g.dst AS candidate, count(*) AS n_mutual
  FROM edges f JOIN edges g ON f.dst = g.src
  WHERE g.dst <> f.src
    AND NOT EXISTS (SELECT 1 FROM edges k WHERE k.src = f.src AND k.dst = g.dst)
  GROUP BY f.src, g.dst),
best AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY src ORDER BY n_mutual DESC, candidate) AS INTEGER) AS rank
    FROM paths)
  WHERE rank <= 10)
"""

_RECS = _TOP + """
SELECT p_partkey AS id, coalesce(recs, '') AS recs
FROM part LEFT JOIN (
  SELECT src, string_agg(CAST(candidate AS VARCHAR), ',' ORDER BY rank) AS recs FROM best GROUP BY src)
  ON src = p_partkey"""

QUERIES = {
    "mutual_friends": mutual_friends,
    "friend_recommendations": friend_recommendations,
    "friends_past_hubs": friends_past_hubs,
}

ORACLES = {
    "mutual_friends": _TOP + "SELECT src, candidate, n_mutual, rank FROM best",
    "friend_recommendations": _RECS,
    "friends_past_hubs": _RECS,
}
