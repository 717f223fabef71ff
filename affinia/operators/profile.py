"""Label profile of clusters, column profile of tables, subset and completeness filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.functions.vectors import incomplete


def missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the column is floating point."""
    value = F.col(column)
    if df.schema[column].dataType.typeName() in ("double", "float"):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def cluster_order() -> list[Column]:
    """Numbered clusters by number first, then named ones by name."""
    number = F.expr("try_cast(cluster AS BIGINT)")
    return [number.asc_nulls_last(), F.col("cluster")]


def label_counts(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """`(cluster, label, n)` with a null label row for members without one."""
    joined = assigned.join(labels, "id")
    label = F.when(~missing(labels, "label"), F.col("label"))
    return joined.groupBy("cluster", label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def profile_clusters(counts: DataFrame, n: int = 5) -> DataFrame:
    """The `n` most frequent labels of each cluster and its number of unlabelled members.

    `(cluster, rank, label, n, n_missing)`; a cluster without labels has one row with
    rank null. Ties go to the smaller label.
    """
    order = Window.partitionBy("cluster").orderBy(F.col("n").desc(), F.col("label"))
    top = (
        counts.filter(F.col("label").isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
    )
    return top.join(missing_counts(counts), "cluster", "full").select(
        "cluster", "rank", "label", "n", F.coalesce("n_missing", F.lit(0).cast("long")).alias("n_missing")
    )


def missing_counts(counts: DataFrame) -> DataFrame:
    """`(cluster, n_missing)` for clusters that have unlabelled members."""
    return counts.filter(F.col("label").isNull()).select("cluster", F.col("n").alias("n_missing"))


def profile_report(profile: DataFrame) -> DataFrame:
    """`(cluster, place, line)`: heading, labels by rank, unlabelled members last, blank line."""
    songs = F.format_string("  %s: %d songs", "label", "n")
    heading = F.struct(F.lit(0).alias("place"), F.format_string("Cluster %s:", "cluster").alias("line"))
    none = F.struct(
        F.lit(1_000_000).alias("place"),
        F.when(F.col("n_missing") > 0, F.format_string("  ( with no genre): %d songs", "n_missing")).alias("line"),
    )
    blank = F.struct(F.lit(1_000_001).alias("place"), F.lit("").alias("line"))
    labels = profile.filter(F.col("rank").isNotNull()).select(
        "cluster", F.col("rank").alias("place"), songs.alias("line")
    )
    rest = (
        profile.select("cluster", "n_missing")
        .distinct()
        .select("cluster", F.inline(F.array(heading, none, blank)))
        .filter(F.col("line").isNotNull())
    )
    return labels.unionByName(rest)


def coverage(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct assigned ids, label rows' ids and labels that are not missing, in one row."""
    has = (~missing(labels, "label")).cast("long")
    rows = assigned.select("id", F.lit(1).alias("a"), F.lit(0).alias("l"), F.lit(0).cast("long").alias("h"))
    rows = rows.unionByName(labels.select("id", F.lit(0).alias("a"), F.lit(1).alias("l"), has.alias("h")))
    per_id = rows.groupBy("id").agg(F.max("a").alias("a"), F.max("l").alias("l"), F.sum("h").alias("h"))
    return per_id.agg(
        F.sum("a").cast("long").alias("assigned_ids"),
        F.sum("l").cast("long").alias("label_ids"),
        F.sum("h").cast("long").alias("labelled"),
    )


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column, from one pass: `(column, type, n_rows, n_non_null)`."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(~missing(df, c), F.lit(1))).alias(c) for c in df.columns],
    )
    per_column = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("n_rows"),
            F.col(field.name).alias("n_non_null"),
        )
        for field in df.schema
    ]
    return counts.select(F.inline(F.array(*per_column)))


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first `n` rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def statistic_columns(df: DataFrame, statistic: str) -> list[str]:
    """Columns named `feature__statistic__nn` that hold one statistic."""
    return [c for c in df.columns if f"__{statistic}__" in c]


def in_subset(df: DataFrame, membership: DataFrame, subset: str) -> DataFrame:
    """Rows whose id belongs to the subset: `membership (id, subset)`."""
    return df.join(membership.filter(F.col("subset") == subset).select("id"), "id", "left_semi")


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any missing value, also inside feature arrays."""
    for field in df.schema:
        bad = incomplete(F.col(field.name)) if field.dataType.simpleString() == "array<double>" else missing(df, field.name)
        df = df.filter(~bad)
    return df
