"""The input frames that the registered queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts, linked both ways when they stand on consecutive lines of an order.

    Edges may repeat; the operators collapse them.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    following = lines.select(
        "l_orderkey",
        (F.col("l_linenumber") - 1).alias("l_linenumber"),
        F.col("l_partkey").alias("next_part"),
    )
    steps = (
        lines.join(following, ["l_orderkey", "l_linenumber"])
        .filter(F.col("l_partkey") != F.col("next_part"))
        .select(F.col("l_partkey").alias("a"), F.col("next_part").alias("b"))
    )
    both = F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst")),
    )
    edges = steps.select(F.inline(both))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")), edges


GRAPH_SQL = """
steps AS (
  SELECT DISTINCT x.l_partkey AS a, y.l_partkey AS b
  FROM lineitem x JOIN lineitem y
    ON x.l_orderkey = y.l_orderkey AND y.l_linenumber = x.l_linenumber + 1
  WHERE x.l_partkey <> y.l_partkey),
edges AS (SELECT a AS src, b AS dst FROM steps UNION SELECT b, a FROM steps)
"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as `(id, features, label)` with double features."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), "label"
    )
