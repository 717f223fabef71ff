"""Text quality by compression: dictionaries of good and of bad text, and a calibrated score."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from affinia.llm.batches import bounded
from affinia.llm.samples import MAX_CHARS, SCALE, remainder

PER_CLASS = 2000  # labelled texts of a class that are learned from, at most
DICTIONARY = 1 << 16  # bytes
BLOCK = 2048  # bytes that are compressed as one, so that the dictionary counts all along a text
LEVEL = 3
GOOD = 0.7  # scores from here on are predicted 1


def _dictionary(texts: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A trained dictionary; for too little text, the text itself."""
    parts = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        found = zstandard.train_dictionary(DICTIONARY, parts)
    except (zstandard.ZstdError, ValueError):
        raw = b"".join(parts)[-DICTIONARY:].ljust(8, b" ")
        found = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    found.precompute_compress(level=LEVEL)
    return found


class Compressors:
    """Compressed sizes of a text: without help, and with each of the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes, raw: tuple[bool, bool] = (False, False)):
        kinds = [zstandard.DICT_TYPE_RAWCONTENT if r else zstandard.DICT_TYPE_AUTO for r in raw]
        dictionaries = [zstandard.ZstdCompressionDict(d, dict_type=k) for d, k in zip((good, bad), kinds)]
        self.each = [zstandard.ZstdCompressor(LEVEL, write_content_size=False, write_checksum=False)]
        for d in dictionaries:
            d.precompute_compress(level=LEVEL)
            self.each.append(
                zstandard.ZstdCompressor(
                    dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def features(self, text: bytes) -> np.ndarray:
        """Of a whole text: the normalised difference of the compressed sizes with the bad and
        the good dictionary, overall and at its worst block, and how far the text compresses alone."""
        if not text:
            return np.zeros(3)
        sizes = np.array(
            [[len(c.compress(text[i : i + BLOCK])) for c in self.each] for i in range(0, len(text), BLOCK)], float
        )
        alone, good, bad = sizes.sum(axis=0)
        blocks = (sizes[:, 2] - sizes[:, 1]) / sizes.max(axis=1)
        return np.array([(bad - good) / max(good, bad), blocks.min(), alone / len(text)])


@dataclass
class Model:
    good: bytes
    bad: bytes
    raw: tuple[bool, bool]
    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    empty: float  # the score of a text without bytes: the share of good ones

    def score(self, compressors: Compressors, text: bytes) -> float:
        if not text:
            return self.empty
        return float(self.scores(compressors.features(text)[None])[0])

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = expand((features - self.centre) / self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ self.weight + self.bias, -30, 30)))


def expand(x: np.ndarray) -> np.ndarray:
    """The features and their squares: a text may compress too well or too badly."""
    return np.concatenate([x, x * x], axis=1)


def fit(sample: list[tuple[int, str, int]], counts: dict[int, int] | None = None) -> Model | None:
    """Dictionaries from half of the sample (by hash), calibration by logistic regression on
    the other half. None without both classes.

    `counts` has the rows of each label that the sample stands for: a drawn row counts for as
    many, so that the size of the sample does not change the share of good texts."""
    texts = {0: [], 1: []}
    for label, text, draw in sample:
        texts[1 if label else 0].append((text.encode("utf-8", "surrogatepass"), draw))
    if not texts[0] or not texts[1]:
        return None
    parts = {}
    for label, rows in texts.items():
        learn = [t for t, draw in rows if draw % 2 == 0]
        check = [t for t, draw in rows if draw % 2]
        parts[label] = (learn or check, check or learn)
    good, bad = _dictionary(parts[1][0]), _dictionary(parts[0][0])
    raw = tuple(d.dict_id() == 0 for d in (good, bad))
    compressors = Compressors(good.as_bytes(), bad.as_bytes(), raw)
    rows = [(compressors.features(t), label) for label in (0, 1) for t in parts[label][1] if t]
    x, y = np.array([f for f, _ in rows]), np.array([label for _, label in rows], float)
    counts = counts or {label: len(rows) for label, rows in texts.items()}
    each = np.array([counts[label] / max(1, (y == label).sum()) for label in (0, 1)])[y.astype(int)]
    centre = np.average(x, axis=0, weights=each)
    scale = np.sqrt(np.average((x - centre) ** 2, axis=0, weights=each)) + 1e-9
    weight, bias = _logistic(expand((x - centre) / scale), y, each)
    share = counts[1] / (counts[0] + counts[1])
    return Model(good.as_bytes(), bad.as_bytes(), raw, centre, scale, weight, bias, share)


def _logistic(
    x: np.ndarray, y: np.ndarray, each: np.ndarray | None = None, ridge: float = 1e-2, rounds: int = 30
) -> tuple[np.ndarray, float]:
    """Newton's method with a small ridge on all but the bias; `each` weighs the rows."""
    z = np.c_[x, np.ones(len(x))]
    each = np.ones(len(x)) if each is None else each * (len(x) / each.sum())
    w, penalty = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], ridge * len(x)), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (each * (p - y)) + penalty * w
        curve = (z * (each * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """Learns from labelled rows where crc32(doc_id as text) mod 4 is not 2.

    The rows are drawn among the labels, by a hash of doc_id; only then are the few drawn ones
    broadcast to the documents, so no text is shuffled.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct()
    known = known.filter(remainder("doc_id", 4) != 2)
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    share = [min(1.0, 2 * per_class / counts[q]) for q in (0, 1)]
    limit = F.when(F.col("quality") == 0, F.lit(int(share[0] * SCALE))).otherwise(F.lit(int(share[1] * SCALE)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SCALE))
    drawn = known.withColumn("draw", draw).filter(F.col("draw") < limit).orderBy("draw", "doc_id", "quality")
    drawn = F.broadcast(drawn.limit(4 * per_class + 1000))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull() & (F.length("text") <= MAX_CHARS))
    rows = texts.join(drawn, "doc_id").orderBy("draw", "quality", "text").limit(4 * per_class + 1000).collect()
    sample, taken = [], {0: 0, 1: 0}
    for row in rows:
        if taken[row.quality] < per_class:
            taken[row.quality] += 1
            sample.append((row.quality, row.text, row.draw))
    return fit(sample, counts)


def scorer(model: Model):
    """A column function: text -> score."""

    @arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        compressors = Compressors(model.good, model.bad, model.raw)
        values = [model.score(compressors, x.as_buffer().to_pybytes() if x.is_valid else b"") for x in texts]
        return pa.array(values, pa.float64())

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of `docs`.

    Only the text decides. Null and empty texts get the share of good labels as score; without
    labels of both classes every score is 0.5. Rows without doc_id count as held out. Labels other than
    0 and 1 are not learned from; a document with both labels counts for both.
    """
    model = train(docs, labels, per_class)
    score = scorer(model)("text") if model else F.lit(0.5)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(True))
    rows = bounded(docs).select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
