"""One round of discrete AdaBoost as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def boost_round(df: DataFrame, rate: float, miss: Column) -> tuple[float, float, Column]:
    """One weight update of discrete AdaBoost (two classes).

    With err the weight share of the missed rows, alpha = rate · ln((1 - err) / err) and
    the missed rows' weights grow by e^alpha; the new weights sum to 1. Returns err,
    alpha and the new weight as a column.
    """
    missed, weight = df.agg(F.sum(F.when(miss, F.col("weight")).otherwise(F.lit(0.0))), F.sum("weight")).first()
    err = missed / weight
    if err <= 0 or err >= 0.5:  # perfect, or no better than guessing: weights stay
        return err, 0.0, F.col("weight") / F.lit(weight)
    alpha = rate * math.log((1 - err) / err)
    scale = weight * ((1 - err) + err * math.exp(alpha))
    grown = F.col("weight") * F.when(miss, F.lit(math.exp(alpha))).otherwise(F.lit(1.0))
    return err, alpha, grown / F.lit(scale)
