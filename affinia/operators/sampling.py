"""Splits and samples that depend on the row's key only, not on its partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.skew import ranked


def hash_bucket(seed: int, keys: Sequence[str], buckets: int = 100) -> Column:
    """A bucket number from the md5 of `seed:key:…`, equal in any engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def split(df: DataFrame, keys: Sequence[str], percent: int = 90, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together hold every row, about `percent` in the first."""
    in_first = hash_bucket(seed, keys) < percent
    return df.filter(in_first), df.filter(~in_first)


def sample_keys(df: DataFrame, key: str, percent: int = 10, seed: int = 42) -> DataFrame:
    """All rows of about `percent` of the keys; no join is needed, the key decides."""
    return df.filter(hash_bucket(seed, [key]) < percent)


def stratified_folds(
    df: DataFrame, id_col: str, label: str, folds: int = 10, seed: int = 42
) -> DataFrame:
    """Add `fold`: the rows of each label in hashed order, dealt out in turn.

    Fold sizes differ by at most one per label. The rank is computed in tiles, so a
    label may hold any share of the rows.
    """
    keyed = df.withColumn(
        "_order", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    )
    return (
        ranked(keyed, [label], ["_order", id_col], "_rank")
        .withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int"))
        .drop("_order", "_rank")
    )
