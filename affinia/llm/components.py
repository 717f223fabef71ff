"""Connected components of a link table, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.session import store


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    return _distinct(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _distinct(moved.union(least.select("a", F.col("least").alias("b"))))


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node that a link `(a, b)` names; root is the smallest node reachable.

    Alternating large-star and small-star rounds, each written to the shared folder, until
    nothing changes. The table never has more rows than links, a node with very many
    neighbours only takes part in a min, and nothing but a count reaches the driver.
    Nulls link nothing, repeated links and self-links change nothing.
    """
    links = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    now = store(_distinct(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "links")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        now = store(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
