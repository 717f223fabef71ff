"""SimHash near-duplicates: segment bit counts, a grid range-join, exact verification."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from affinia.llm.batches import bounded, give_back
from affinia.llm.components import connected
from affinia.llm.names import apart
from affinia.session import store

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2

# The embedding has 32 segments of two bits. A segment's bit count (0, 1, 2) is written as
# 00, 01, 11, so that the Manhattan distance of two embeddings is the bit count of their XOR.
EVEN = 0x5555555555555555
# The 32 coordinates fall into six groups. Vectors at a Manhattan distance of two or less
# differ in two groups at most, so four of the six agree: 15 grids, each over four groups.
GROUP_SEGMENTS = (5, 5, 5, 5, 6, 6)

# A cell with more members than this is not compared pair by pair (see `near_links`).
CELL_MEMBERS = 64

_BLOCK = 1 << 15
# Each byte as eight bytes of 0 or 1, so that many bits are added at once.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _ones(hashes: bytes) -> np.ndarray:
    """How many of the 8-byte hashes have each bit set, highest bit first."""
    spread = _SPREAD[np.frombuffer(hashes, np.uint8)].reshape(-1, 8)
    sums = np.add.reduceat(spread, np.arange(0, len(spread), 255), axis=0)  # a byte holds up to 255
    return sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a whole text, unsigned; zero without words.

    `bytes.lower` and `bytes.split` treat exactly A-Z and the six ASCII white-space
    characters. Memory beyond the words themselves is bounded by a block of shingles.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    k = min(words_in_shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
    hashes = map(xxhash.xxh64_digest, shingles, itertools.repeat(SEED))
    ones = np.zeros(64, np.int64)
    while block := b"".join(itertools.islice(hashes, _BLOCK)):
        ones += _ones(block)
    return int.from_bytes(np.packbits(ones * 2 > len(words) - k + 1).tobytes(), "big")


@arrow_udf(T.LongType())
def fingerprint_column(texts: pa.Array) -> pa.Array:
    """`fingerprint` of each text as a signed long."""
    values = [fingerprint(x.as_buffer().to_pybytes() if x.is_valid else None) for x in texts]
    give_back()
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def fingerprint_hex(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def embedding(column: Column) -> Column:
    """Bit counts of the 32 segments, packed two bits a segment as described above."""
    even = F.lit(EVEN)
    shifted = F.shiftrightunsigned(column, 1)
    some = column.bitwiseOR(shifted).bitwiseAND(even)
    both = column.bitwiseAND(shifted).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def cells(vector: Column) -> Column:
    """The 15 grid cells of an embedded fingerprint."""
    masks, at = [], 0
    for n in GROUP_SEGMENTS:
        masks.append(((1 << 2 * n) - 1) << at)
        at += 2 * n
    grids = [_signed(sum(four)) for four in itertools.combinations(masks, 4)]
    return F.array(*(F.xxhash64(F.lit(i), vector.bitwiseAND(F.lit(g))) for i, g in enumerate(grids)))


def _bits(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_links(fingerprints: DataFrame, members: int = CELL_MEMBERS) -> DataFrame:
    """Links (a, b) that connect all distinct `fingerprint`s at two or fewer differing bits.

    Every pair that shares a cell of up to `members` fingerprints is checked: first the
    Manhattan distance of the embeddings, which never exceeds the Hamming distance, then
    the Hamming distance itself. Fuller cells would cost the square of their size. Their
    fingerprints go to their 65 neighbours at one bit or less instead: two fingerprints share
    a neighbour exactly if they differ in two bits or fewer, and a neighbour never
    has more than 65 fingerprints, so this is exact as well and grows in proportion.
    All links are real ones; of a full cell they join the same groups as all pairs would.
    """
    points = fingerprints.select("fingerprint", embedding(F.col("fingerprint")).alias("vector"))
    placed = store(points.withColumn("cell", F.explode(cells(F.col("vector")))), "cells")
    counts = store(
        placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "cell_counts"
    )
    compared = placed.join(counts.filter(F.col("n") <= members).select("cell"), "cell")
    pairs = (
        compared.select("cell", F.col("fingerprint").alias("a"), F.col("vector").alias("va"))
        .join(compared.select("cell", F.col("fingerprint").alias("b"), F.col("vector").alias("vb")), "cell")
        .filter((F.col("a") < F.col("b")) & (_bits("va", "vb") <= MAX_BITS) & (_bits("a", "b") <= MAX_BITS))
        .select("a", "b")
    )
    full = placed.join(counts.filter(F.col("n") > members).select("cell"), "cell").select("fingerprint").distinct()
    flips = [F.lit(0).cast("long"), *(F.lit(_signed(1 << i)) for i in range(64))]
    around = full.withColumn(
        "neighbour", F.explode(F.array(*(F.col("fingerprint").bitwiseXOR(x) for x in flips)))
    )
    stars = (
        around.groupBy("neighbour")
        .agg(F.sort_array(F.collect_list("fingerprint")).alias("all"))
        .filter(F.size("all") > 1)
    )
    close = stars.select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, 65)).alias("b"))
    return store(pairs.union(close).distinct(), "near_links")


def with_components(fingerprints: DataFrame, members: int = CELL_MEMBERS) -> DataFrame:
    """(fingerprint, root, component_id) of each distinct fingerprint in (doc_id, fingerprint).

    component_id is the smallest doc_id reachable through links, null only if no document of
    the component has one.
    """
    distinct = store(
        fingerprints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct"
    )
    roots = connected(near_links(distinct, members)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("fingerprint", "root", "component_id")


def near_duplicates(docs: DataFrame, members: int = CELL_MEMBERS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of `docs`.

    Null and empty texts have fingerprint zero and are linked like any other. A row that
    repeats a doc_id is a row of its own. Rows without doc_id take part; their component's
    id is the smallest one it has. Columns other than doc_id and text are not read.
    """
    prints = store(bounded(docs).select("doc_id", fingerprint_column("text").alias("fingerprint")), "fingerprints")
    groups = with_components(prints, members)
    return prints.join(groups, "fingerprint").select(
        "doc_id", fingerprint_hex(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame, members: int = CELL_MEMBERS) -> DataFrame:
    """The rows of `docs` with one row of each component, as `keep_first` chooses it.

    All columns stay as they are, whatever their names. An empty table gives an empty one, and
    null and empty texts are copies of each other.
    """
    docs, named = apart(docs, ("doc_id", "text"))
    printed = store(bounded(docs).withColumn("_fingerprint", fingerprint_column("text")), "printed")
    prints = printed.select("doc_id", F.col("_fingerprint").alias("fingerprint"))
    groups = store(with_components(prints, members), "groups").withColumnRenamed("fingerprint", "_fingerprint")
    return named(keep_first(printed, groups, "_fingerprint"))


def keep_first(printed: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """One row of each root of (key, root, component_id): the one with the smallest doc_id.

    Rows with the same doc_id and component count as copies, one of them stays (the one with
    the smallest hash over all columns). A component without any doc_id keeps one row as well.
    `printed` has the key beside the columns that stay.
    """
    columns = [c for c in printed.columns if c != key]
    named = printed.select("doc_id", key).join(groups, key).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    copies = named.groupBy("root").agg(F.count(F.lit(1)).alias("_copies"))
    picked = groups.join(copies, "root").select(
        key, F.col("root").alias("_root"), F.col("component_id").alias("_component"), "_copies"
    )
    first = printed.join(picked, key).filter(F.col("doc_id").eqNullSafe(F.col("_component")))
    order = Window.partitionBy("_root").orderBy(F.xxhash64(*columns))
    repeated = first.filter("_copies > 1").withColumn("_row", F.row_number().over(order)).filter("_row = 1")
    return first.filter("_copies = 1").select(*columns).union(repeated.select(*columns))
