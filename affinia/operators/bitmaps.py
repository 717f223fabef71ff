"""Sets of numbered members as arrays of longs, so that common members are counted by bits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def numbered(df: DataFrame, column: str, members: Sequence) -> DataFrame:
    """The rows of `df` whose `column` is one of `members`, with its number as `bit` in place of it.

    `members` is a list on the driver and so bounded; it is copied to all tasks.
    """
    kind = df.schema[column].dataType.simpleString()
    numbers = df.sparkSession.createDataFrame(list(enumerate(members)), f"bit int, _member {kind}")
    return df.join(F.broadcast(numbers), df[column] == numbers["_member"]).drop("_member", column)


def bitmaps(rows: DataFrame, key: str, n: int) -> DataFrame:
    """`(key, bits)`: the numbers below n of each key in `(key, bit)`, 64 to a long.

    Numbers are combined to words before the shuffle, so a key with very many rows is one of n / 64 words.
    """
    place, mask = F.floor(F.col("bit") / 64).cast("int"), F.expr("shiftleft(1L, bit % 64)")
    words = rows.groupBy(key, place.alias("_place")).agg(F.bit_or(mask).alias("_word"))
    found = words.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_place", "_word"))).alias("_words"))
    every = F.sequence(F.lit(0), F.lit((n - 1) // 64))
    return found.select(key, F.transform(every, lambda i: F.coalesce(F.try_element_at("_words", i), F.lit(0))).alias("bits"))


def n_common(*columns: str) -> Column:
    """How many members all of the bitmaps have in common."""
    words = F.col(columns[0])
    for other in columns[1:]:
        words = F.zip_with(words, F.col(other), lambda x, y: x.bitwiseAND(y))
    return F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))
