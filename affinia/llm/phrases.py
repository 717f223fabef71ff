"""Lempel-Ziv phrase fingerprints: how much of one text's dictionary another text shares."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.batches import bounded

PLACES = 128  # minimum hashes in a fingerprint, eight bits of each are kept
LONG_WORD = 16  # longer words are parsed in pieces of half that length
RANGES_PER_PARTITION = 4

_MASK = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15
_PROBES = np.argsort(np.random.default_rng(9).random((PLACES, PLACES)), axis=1)
EMPTY = bytes(PLACES)
DIGEST = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _words(text: str) -> Iterable[bytes]:
    words = text.encode("utf-8", "surrogatepass").split()
    if max(map(len, words), default=0) <= LONG_WORD:
        return words
    half = LONG_WORD // 2
    return [w[i : i + half] for w in words for i in range(0, len(w), half)]


def phrases(text: str) -> set[int]:
    """Hashes of the phrases of a whole text.

    LZ78 over words: a phrase is the longest phrase met before, and the word after it.
    White space only separates words. What is left at the end is a phrase met before.
    """
    seen: set[int] = set()
    add = seen.add
    state = 0
    for word in map(zlib.crc32, _words(text)):
        state = ((state + word + 1) * _FACTOR) & _MASK
        state ^= state >> 29
        if state not in seen:
            add(state)
            state = 0
    return seen


def signature(text: str) -> bytes:
    """One byte for each of PLACES parts of the hash range: of the smallest phrase hash there.

    A part without a phrase takes the byte of the first part that has one, in an order of its
    own that is the same for all texts. Without words all bytes are zero.
    """
    found = phrases(text)
    if not found:
        return EMPTY
    x = np.fromiter(found, np.uint64, len(found))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = np.sort(x ^ (x >> np.uint64(27)))
    part = (x >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    least, filled = np.zeros(PLACES, np.uint64), np.zeros(PLACES, bool)
    least[part[first]], filled[part[first]] = x[first], True
    source = _PROBES[np.arange(PLACES), filled[_PROBES].argmax(axis=1)]
    value = least[np.where(filled, np.arange(PLACES), source)] * np.uint64(_FACTOR)
    return ((value >> np.uint64(48)) % np.uint64(255) + np.uint64(1)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated share of phrases in common, 0 to 1; chance agreement is taken off."""
    if a == b:
        return 1.0
    if EMPTY in (a, b):
        return 0.0
    same = np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)) / PLACES
    return max(0.0, (same - 1 / 255) / (1 - 1 / 255))


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first as many of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, guest, doc_id, text) in order; a part ends with a guest, the row after its last."""
    last = None
    for batch in batches:
        out = []
        for part, guest, doc_id, text in zip(*(batch.column(i) for i in range(4))):
            part, text = part.as_py(), text.as_py()
            sign = signature(text)
            if last is not None and last[0] == part:
                _, own_id, own, own_sign = last
                other = edited(own, text)
                other_sign = signature(other)
                sha = hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest()
                near = likeness(own_sign, other_sign), likeness(own_sign, sign)
                out.append((own_id, len(own), sha, own_sign.hex(), other_sign.hex(), *near))
            last = None if guest.as_py() else (part, doc_id.as_py(), text, sign)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [c.split()[0] for c in DIGEST.split(", ")]
        columns = zip(*out) if out else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _parts(docs: DataFrame, ranges: int) -> DataFrame:
    """Adds `part`: ranges of doc_id of about equal size, numbered upwards; -1 without doc_id."""
    steps = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = docs.select(F.percentile_approx("doc_id", steps, 100 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return docs.withColumn("part", F.when(F.col("doc_id").isNull(), -1).otherwise(0))
    below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("doc_id")))
    return docs.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(below))


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, beside those of its edited text and of the next document.

    The order is descending doc_id, rows without one last; rows with equal doc_id by the hash
    of their text, descending. After the last row comes the first. A null text is empty.
    Columns other than doc_id and text are not read. The order is cut into ranges that are
    sorted and streamed apart; the first row of each range also ends the range before, so a
    text is shuffled once, and a task holds two texts at a time.
    """
    spark = docs.sparkSession
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = bounded(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = _parts(rows, ranges).withColumn("tie", F.xxhash64("text"))
    place = F.struct("doc_id", "tie")
    # At most one row a range: the first in order, with the range that it also ends.
    heads = sorted(rows.groupBy("part").agg(F.max(place).alias("head")).collect(), reverse=True)
    before = dict(zip((h.part for h in heads), [heads[-1].part if heads else 0, *(h.part for h in heads)]))
    ends = [(before[h.part], h.head.doc_id, h.head.tie) for h in heads]
    ends = F.broadcast(spark.createDataFrame(ends, "ends int, head_id long, head_tie long"))
    guests = (
        rows.join(ends, F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")))
        .dropDuplicates(["ends"])
        .select(F.col("ends").alias("part"), F.lit(True).alias("guest"), "doc_id", "text", "tie")
    )
    every = rows.select("part", F.lit(False).alias("guest"), "doc_id", "text", "tie").union(guests)
    order = [F.col("part"), F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("tie").desc()]
    ordered = every.repartition("part").sortWithinPartitions(*order)
    return ordered.select("part", "guest", "doc_id", "text").mapInArrow(_compared, DIGEST)
