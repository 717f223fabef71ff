"""Column expressions over `array<double>` feature vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_VARIANCE = 1e-10  # stands in for a dimension without spread


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def centroid(n: Column, sums: Column) -> Column:
    return F.transform(sums, lambda x: x / n)


def spread(n: Column, m2: Column) -> Column:
    """The variance M2 / N of each dimension, floored so that it can be divided by."""
    return F.transform(m2, lambda x: F.greatest(x / n, F.lit(MIN_VARIANCE)))


def mahalanobis(features: Column, center: Column, spread: Column) -> Column:
    """sqrt(Σ (x - c)² / variance), the distance along independent dimensions."""
    squares = F.zip_with(features, center, lambda x, c: (x - c) * (x - c))
    return F.sqrt(total(F.zip_with(squares, spread, lambda s, v: s / v)))


def incomplete(features: Column) -> Column:
    """True where the vector is missing or holds a null or NaN."""
    return features.isNull() | F.exists(features, lambda x: x.isNull() | F.isnan(x))
