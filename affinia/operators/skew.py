"""Joins and rankings that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinia.session import store


def heavy_keys(df: DataFrame, key: str, above: int, at_most: int, weight: Column | None = None) -> list:
    """The keys with more than `above` rows (or total weight), heaviest first.

    One count pass, combined map-side; at most `at_most` keys reach the driver.
    Callers must treat every key that is not returned by the ordinary path.
    """
    weight = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = (
        df.groupBy(key)
        .agg(weight.alias("_weight"))
        .filter(F.col("_weight") > above)
        .orderBy(F.col("_weight").desc(), F.col(key))
        .limit(at_most)
        .collect()
    )
    return [row[0] for row in rows]


def spread_join(
    left: DataFrame, right: DataFrame, key: str, hot: Sequence, slices: int = 64, more: Sequence[str] = ()
) -> DataFrame:
    """Inner equi-join on `key` that spreads each hot key over `slices` tasks.

    Left rows of a hot key are cut into slices by a hash of the whole row and the
    right rows of that key are copied to every slice. All other keys join as usual. `more`
    names further columns to join on.
    """
    if not hot:
        return left.join(right, [key, *more])
    is_hot = F.col(key).isin(list(hot))
    row_hash = F.pmod(F.xxhash64(*left.columns), F.lit(slices)).cast("int")
    left = left.withColumn("_slice", F.when(is_hot, row_hash).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(slices - 1))
    right = right.withColumn(
        "_slice", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0))))
    )
    return left.join(right, [key, *more, "_slice"]).drop("_slice")


def n_slices(rows: int, size: int) -> int:
    """How many slices of about `size` rows hold `rows` rows."""
    return max(1, -(-rows // max(1, size)))


def n_parts(spark: SparkSession, rows: int | None, size: int) -> int:
    """How many partitions of about `size` rows hold `rows` rows, one for each core at least."""
    return max(spark.sparkContext.defaultParallelism, n_slices(rows or 0, size))


def ranked(
    df: DataFrame, within: Sequence[str], order: Sequence[str], name: str = "rank", tiles: int | None = None
) -> DataFrame:
    """`row_number()` of each row within its group, for groups of any size.

    A plain window sends a whole group to one task. Here the rows are range
    partitioned into tiles and written once, ranked inside their tile, and lifted
    by the number of rows of the group in earlier tiles (a table of at most
    groups + tiles rows, because the tiles follow the sort order).
    """
    tiles = tiles or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*within, *order]
    tiled = store(
        df.repartitionByRange(tiles, *keys).withColumn("_tile", F.spark_partition_id()), "tiles"
    )
    before = Window.partitionBy(*within).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tiled.groupBy(*within, "_tile")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    in_tile = Window.partitionBy(*within, "_tile").orderBy(*order)
    return (
        tiled.withColumn("_in_tile", F.row_number().over(in_tile))
        .join(offsets, [*within, "_tile"])
        .withColumn(name, F.col("_offset") + F.col("_in_tile"))
        .drop("_tile", "_in_tile", "_offset")
    )
