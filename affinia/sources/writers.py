"""Sinks: text reports, CSV lists and the id-to-cluster table.

Everything is written by the tasks. Sorted output stays in several files whose order is
that of their names; `single=True` puts a small result into one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.functions.text import fixed
from affinia.operators.profile import cluster_order


def write_lines(df: DataFrame, path: str, order: Sequence[str | Column], single: bool = False) -> None:
    """The column `line` as text, in the given order."""
    lines = df.orderBy(*order).select("line")
    (lines.coalesce(1) if single else lines).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, order: Sequence[str | Column], single: bool = False) -> None:
    """CSV with header."""
    rows = df.orderBy(*order)
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(path)


def recommendation_lines(recs: DataFrame) -> DataFrame:
    """`id TAB rec,rec,…`, also for an empty list."""
    joined = F.concat_ws(",", F.col("recs").cast("array<string>"))
    return recs.select("id", F.concat(F.col("id").cast("string"), F.lit("\t"), joined).alias("line"))


def write_recommendations(recs: DataFrame, path: str, single: bool = False) -> None:
    write_lines(recommendation_lines(recs), path, ["id"], single)


def write_adjacency(vertices: DataFrame, edges: DataFrame, path: str, per_line: int = 1000) -> None:
    """Neighbour lists, about `per_line` to a line: a long list goes on in further lines."""
    degree = edges.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / per_line).alias("lines"))
    parts = edges.join(degree, "src").withColumn("part", F.pmod(F.xxhash64("dst"), F.col("lines")))
    lists = parts.groupBy("src", "part").agg(
        F.concat_ws(",", F.array_sort(F.collect_list("dst")).cast("array<string>")).alias("friends")
    )
    lines = vertices.join(lists, vertices["id"] == lists["src"], "left")
    text = F.concat(F.col("id").cast("string"), F.lit("\t"), F.coalesce("friends", F.lit("")))
    lines.select(text.alias("value")).write.mode("overwrite").text(path)


def itemset_report_lines(report: DataFrame, n: int = 10) -> DataFrame:
    """The itemset report with its headings: `(section, rank, line)`."""
    heads = [(0, -1, "=== Frequent Itemsets Analysis ==="), (0, 0, "")]
    for size in (1, 2, 3):
        heads += [(size, -1, ""), (size, 0, f"Top {n} frequent itemsets of size {size}:")]
    fixed_lines = report.sparkSession.createDataFrame(heads, "section int, rank int, line string")
    return report.unionByName(fixed_lines)


def write_itemset_report(report: DataFrame, path: str) -> None:
    write_lines(itemset_report_lines(report), path, ["section", "rank"], single=True)


def write_rule_report(report: DataFrame, path: str, single: bool = False) -> None:
    """Rule lines, strongest first."""
    write_lines(report, path, [F.col("standardized_lift").desc(), "antecedent", "consequent"], single)


def prediction_rows(top: DataFrame, digits: int = 4) -> DataFrame:
    """`(user, item, title, predicted)` with the column names and decimals of the export."""
    return top.select(
        F.col("user").alias("UserID"),
        F.col("item").alias("MovieID"),
        F.col("title").alias("Movie Name"),
        fixed("predicted", digits).alias("Predicted Rating"),
    )


def write_predictions(top: DataFrame, path: str, single: bool = False) -> None:
    """Users ascending, each user's best prediction first."""
    # sorted before formatting, by the number and not by its text
    ordered = top.orderBy("user", F.col("predicted").desc(), "item")
    rows = prediction_rows(ordered)
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(path)


def write_stats_report(report: DataFrame, path: str) -> None:
    """Cluster lines under one heading per k; `report (k, cluster, line)`."""
    number = F.col("cluster").try_cast("bigint")
    heads = report.select("k").distinct().select(
        "k", F.explode(F.array(F.lit(""), F.format_string("=== Clustering with k = %d ===", "k"))).alias("line")
    )
    place = F.when(F.col("line") == "", F.lit(-2)).otherwise(F.lit(-1)).cast("bigint")
    lines = report.select("k", number.alias("place"), "line").unionByName(heads.select("k", place.alias("place"), "line"))
    write_lines(lines, path, ["k", "place"], single=True)


def write_assignments(assigned: DataFrame, path: str) -> None:
    """`(id, kind, cluster)` as a table of rows, readable in parallel."""
    assigned.select("id", "kind", "cluster").write.mode("overwrite").parquet(path)


def run_log_lines(report: DataFrame, clusters: DataFrame, retained_points: int) -> DataFrame:
    """The chunk report and the final clusters as text: `(part, place, line)`."""
    chunk = F.col("chunk").cast("bigint")

    def sets():
        return [
            F.format_string("DS clusters: %d (%d points)", "ds_clusters", "ds_points"),
            F.format_string("CS clusters: %d (%d points)", "cs_clusters", "cs_points"),
            F.format_string("RS points: %d", "rs_points"),
        ]

    title = F.when(chunk == 0, F.lit("=== Initialization ===")).otherwise(
        F.format_string("--- Processing chunk %d ---", chunk + 1)
    )
    texts = [F.lit(""), title, F.format_string("Points in this chunk: %d", "n_points"), *sets()]
    chunks = report.select(F.lit(0).alias("part"), chunk.alias("c"), F.posexplode(F.array(*texts)).alias("p", "line"))
    chunks = chunks.select("part", (F.col("c") * 10 + F.col("p")).alias("place"), F.lit("").alias("name"), "line")

    def first_three(column):
        numbers = F.transform(F.slice(column, 1, 3), lambda x: x.cast("string"))
        return F.concat(F.lit("["), F.concat_ws(" ", numbers), F.lit("]"))

    part = F.when(F.col("kind") == "DS", F.lit(2)).otherwise(F.lit(3))
    line = F.concat(
        F.format_string("  Cluster %s: N=%d, SUM[:3]=", "cluster", "n"), first_three("sum"),
        F.lit(", SUMSQ[:3]="), first_three("sumsq"),
    )
    listed = clusters.select(part.alias("part"), F.lit(1).cast("bigint").alias("place"), F.col("cluster").alias("name"), line.alias("line"))
    counts = clusters.agg(F.count_if(F.col("kind") == "DS").alias("ds"), F.count_if(F.col("kind") == "CS").alias("cs"))

    def row(part, place, text):
        return F.struct(F.lit(part).alias("part"), F.lit(place).cast("bigint").alias("place"), F.lit("").alias("name"), text.alias("line"))

    final = counts.select(
        F.inline(
            F.array(
                row(1, 0, F.lit("")),
                row(1, 1, F.lit("=== FINAL REPORT ===")),
                row(1, 2, F.format_string("DS clusters: %d", "ds")),
                row(1, 3, F.format_string("CS clusters: %d", "cs")),
                row(1, 4, F.lit(f"RS points: {retained_points}")),
                row(2, -1, F.lit("")),
                row(2, 0, F.format_string("Discard Set (DS) contains %d clusters:", "ds")),
                row(3, -1, F.lit("")),
                row(3, 0, F.format_string("Compression Set (CS) contains %d clusters:", "cs")),
            )
        )
    )
    return chunks.unionByName(final).unionByName(listed)


def write_run_log(
    report: DataFrame, clusters: DataFrame, retained: DataFrame, path: str, single: bool = False
) -> None:
    """Chunk by chunk, then the final sets; a run of very many chunks is sorted and written by several tasks."""
    write_lines(run_log_lines(report, clusters, retained.count()), path, ["part", "place", "name"], single)


def write_profile_report(report: DataFrame, path: str, single: bool = False) -> None:
    """Numbered clusters first, then named ones; within a cluster the best label first."""
    write_lines(report, path, [*cluster_order(), "place"], single)


def write_study(results: DataFrame, path: str) -> None:
    """One row per configuration."""
    results.write.mode("overwrite").parquet(path)
