"""Reproducible shuffle into shards: a Feistel permutation over global row numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.operators.skew import ranked

SHARDS = 24
SEED = 0x5EED
ROUNDS = 6
WALK = 64

# Odd 31-bit factors of the round function, taken in turn.
FACTORS = (0x5851F42D, 0x2545F491, 0x6C078965)


def sides(n: int) -> tuple[int, int]:
    """The halves' sizes a, b of the permuted domain: a * b is n or more by less than a."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def round_keys(seed: int = SEED, rounds: int = ROUNDS) -> list[int]:
    """A 31-bit key for each round (a linear congruential sequence)."""
    keys, state = [], seed
    for _ in range(rounds):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        keys.append(state >> 33)
    return keys


def _mixed(half: Column, key: int, factor: int) -> Column:
    """The round function: stays below 2^62 for halves below 2^30."""
    x = half.bitwiseXOR(F.lit(key)) * F.lit(factor)
    return x.bitwiseXOR(F.shiftrightunsigned(x, 17)).bitwiseAND(F.lit((1 << 60) - 1))


def permuted_once(x: Column, n: int, seed: int = SEED) -> Column:
    """One Feistel network over the numbers below a * b, whose halves are digits of x.

    Even rounds add to the digit below a, odd rounds to the one below b, each by a function of
    the other digit, so every round can be undone and the whole is a permutation.
    """
    a, b = sides(n)
    left, right = x % F.lit(a), F.floor(x / F.lit(a)).cast("long") if a > 1 else x
    for i, key in enumerate(round_keys(seed)):
        factor = FACTORS[i % len(FACTORS)]
        if i % 2 == 0:
            left = (left + _mixed(right, key, factor)) % F.lit(a)
        else:
            right = (right + _mixed(left, key, factor)) % F.lit(b)
    return right * F.lit(a) + left


def permuted(x: Column, n: int, seed: int = SEED) -> Column:
    """A permutation of 0 .. n - 1. Numbers that land at n or above walk on along their cycle.

    Fewer than a of the a * b numbers lie there and a is about the root of n, so a second step is
    rare. WALK steps are enough for any n up to WALK^2; for larger n a longer walk has a
    probability below WALK^-WALK, and would raise an error rather than leave a wrong slot.
    """
    first = permuted_once(x, n, seed)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        first,
        lambda at, _: F.when(at < n, at).otherwise(permuted_once(at, n, seed)),
    )
    ended = F.when(walk < n, walk).otherwise(F.raise_error(F.lit("the walk did not end")).cast("long"))
    return F.when(first < n, first).otherwise(ended)


def place(row_number: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of a global row number, without any table."""
    a, b = sides(n)
    x = row_number
    while True:
        right, left = divmod(x, a)
        for i, key in enumerate(round_keys(seed)):
            factor = FACTORS[i % len(FACTORS)]
            half = right if i % 2 == 0 else left
            y = (half ^ key) * factor
            y = (y ^ (y >> 17)) & ((1 << 60) - 1)
            if i % 2 == 0:
                left = (left + y) % a
            else:
                right = (right + y) % b
        x = right * a + left
        if x < n:
            return x % shards, x // shards


def sharded(rows: DataFrame, order: Sequence[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """`rows` with `row_number` (from 0, by `order`), `shard` and `slot`.

    The permuted number modulo `shards` is the shard, and the quotient the slot: shards differ by
    one row at most and slots have no gaps. Rows equal in all of `order` are numbered in any order.
    """
    numbered = ranked(rows, [], order, "row_number").withColumn("row_number", F.col("row_number") - 1)
    n = max(1, numbered.count())
    at = permuted(F.col("row_number"), n, seed)
    return (
        numbered.withColumn("_at", at)
        .withColumn("shard", (F.col("_at") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("_at") / shards).cast("long"))
        .drop("_at")
    )


def sharded_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number) of each row.

    Rows are numbered by doc_id (nulls first), checksum and size. The law is `rows`: counts are at
    most one apart, so grown_shard is null. A null text has size 8 and a null checksum. Equal
    texts are rows like any other. Columns other than doc_id and text are not read.
    """
    text = F.col("text").cast("binary")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = sharded(rows, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
