"""Language identification by averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

import functools
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from affinia.llm.batches import bounded, give_back
from affinia.llm.names import apart
from affinia.llm.samples import labelled_sample, remainder

PER_LANGUAGE = 1000  # documents of a language that are learned from, at most
BUCKETS = 1 << 15
DIMENSIONS = 16
EPOCHS = 4
RATE = 0.5
GRAMS = (2, 3, 4)  # letters, or letters and one word boundary
REJECTED = 0.001  # share of right answers on calibration documents that may be rejected
SMOOTHING = 0.01  # what subwords never met have in common of the expected frequencies
SHORT = 8  # subwords a text is credited with that are as usual as its language's
UNKNOWN = "und"

_PIECE = 1 << 18  # characters handled at once
_PLACES = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its small letter, or 0 if it is none."""
    small = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in map(chr, range(sys.maxunicode + 1)):
        if c.isalpha():
            low = c.lower()
            small[ord(c)] = ord(low) if len(low) == 1 else ord(c)
    return small


def subwords(text: str):
    """Bucket numbers of all subwords of a text, in arrays of bounded size.

    Anything but letters is a word boundary; a subword may begin or end with one.
    """
    longest = GRAMS[-1] - 1
    for at in range(0, len(text), _PIECE):
        piece = text[max(0, at - 1) : at + _PIECE + longest]
        code = _letters()[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if at == 0:
            code = np.r_[np.uint32(0), code]
        if at + _PIECE + longest >= len(text):
            code = np.r_[code, np.zeros(longest, np.uint32)]
        letter = code > 0
        starts = min(_PIECE, len(code) - longest)
        for n in GRAMS:
            inner = np.ones(starts, bool)
            for i in range(1, n - 1):
                inner &= letter[i : i + starts]
            if n == 2:
                inner &= letter[:starts] | letter[1 : 1 + starts]
            where = np.flatnonzero(inner)
            h = np.full(len(where), n, np.uint32)
            for i in range(n):
                h = (h ^ code[where + i]) * _PLACES[i]
                h ^= h >> np.uint32(15)
            yield (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


@dataclass
class Model:
    """A text's mean embedding gives the logits of the languages, and its mean log frequency,
    beside that of the language's own documents, the probability that it is one of them at all.

    What goes to the tasks is a row of DIMENSIONS + 1 numbers a bucket, and as many a language.
    """

    languages: list[str]
    table: np.ndarray  # of each bucket its embedding and its log frequency
    weight: np.ndarray
    bias: np.ndarray
    usual: np.ndarray  # mean log frequency in a language's documents
    temperature: float = 1.0
    familiar: tuple[float, float] = (0.0, np.inf)  # slope and intercept of the familiarity's logit
    threshold: float = 0.0

    def means(self, text: str) -> tuple[np.ndarray, int]:
        """The mean table row of a text's subwords, and their number."""
        total, n = np.zeros(self.table.shape[1]), 0
        for idx in subwords(text):
            total += self.table.take(idx, axis=0).sum(axis=0, dtype=np.float64)
            n += len(idx)
        return total / max(n, 1), n

    def logits(self, mean: np.ndarray) -> np.ndarray:
        return mean[..., :-1] @ self.weight + self.bias

    def familiarity(self, frequency, language, n):
        """How far a text's mean log frequency is above the usual one; short texts are near 0."""
        return (frequency - self.usual[language]) * n / (n + SHORT)

    def known(self, familiarity):
        """Probability that a text of this familiarity is in a learned language."""
        slope, intercept = self.familiar
        return 1 / (1 + np.exp(-np.clip(slope * familiarity + intercept, -700, 700)))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected)."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        mean, n = self.means(text)
        p = softmax(self.logits(mean) / self.temperature)
        best = int(p.argmax())
        score = float(p[best] * self.known(self.familiarity(mean[-1], best, n)))
        return self.languages[best], score, score < self.threshold


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def shuffled(text: str, rng: np.random.Generator) -> str:
    """A text with its letters in a random order: as many words, of no language."""
    chars = np.array(list(text))
    at = np.flatnonzero([c.isalpha() for c in chars])
    chars[at] = chars[rng.permutation(at)]
    return "".join(chars)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The different subwords of a text and how often each occurs."""
    parts = list(subwords(text))
    return np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int32), return_counts=True)


def fit(sample: list[tuple[str, str, int]]) -> Model:
    """Stochastic gradient descent, then the calibration. `sample` has (language, text, hash).

    One text in five, by hash, is kept out of the descent and serves for `calibrate`. Buckets
    without a training subword have no embedding. Ends with no languages if there is nothing to learn from.
    """
    languages = sorted({lang for lang, _, _ in sample})
    k = len(languages)
    place = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(0)
    embed = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weight, bias = np.zeros((DIMENSIONS, k), np.float32), np.zeros(k, np.float32)
    examples = []
    for lang, text, draw in sample:
        idx, times = counted(text)
        if len(idx):
            examples.append((idx, (times / times.sum()).astype(np.float32), place[lang], draw % 5 == 0, text, int(times.sum())))
    learn = [e for e in examples if not e[3]] or examples
    steps = max(1, EPOCHS * len(learn))
    for step in range(EPOCHS * len(learn)):
        if step % len(learn) == 0:
            order = rng.permutation(len(learn))
        idx, share, y = learn[order[step % len(learn)]][:3]
        rate = np.float32(RATE * (1 - step / steps))
        mean = share @ embed[idx]
        slope = softmax(mean @ weight + bias)
        slope[y] -= 1
        back = weight @ slope
        weight -= rate * np.outer(mean, slope)
        bias -= rate * slope
        embed[idx] -= rate * BUCKETS**0.5 * share[:, None] * back
    documents = np.bincount([e[2] for e in learn], minlength=k) if learn else np.zeros(k)
    frequency = np.zeros(BUCKETS)  # every language counts alike, and so does every text of it
    for idx, share, y, *_ in learn:
        frequency[idx] += share / documents[y]
    embed[frequency == 0] = 0
    present = max(1, np.count_nonzero(documents))
    table = np.column_stack([embed, log_frequency(frequency / present)]).astype(np.float32)
    model = Model(languages, table, weight.astype(np.float64), bias.astype(np.float64), np.zeros(k))
    if examples:
        calibrate(model, learn, [e for e in examples if e[3]] or examples, frequency, documents, rng)
    return model


def log_frequency(share: np.ndarray) -> np.ndarray:
    return np.log((1 - SMOOTHING) * share + SMOOTHING / BUCKETS)


def calibrate(model: Model, learn: list, held: list, frequency: np.ndarray, documents: np.ndarray, rng) -> None:
    """Sets the temperature, the usual frequencies, the familiarity's logit and the threshold.

    The temperature minimises the log loss on `held`. The familiarity tells these texts from two
    kinds of foreign ones: the same texts as a model without their language sees them, and
    with their letters shuffled. At most REJECTED of the right answers fall below the threshold;
    where foreign texts leave a gap below these it is in the middle of the gap. Targets are those of
    a sample with one further answer of each kind, so that separable samples have an optimum as well.
    """
    k = len(model.languages)
    y = np.array([e[2] for e in held])
    n = np.array([e[5] for e in held])
    means = np.array([e[1] @ model.table[e[0]] for e in held], np.float64)
    z = model.logits(means)
    model.temperature = best_temperature(z, y)
    for group in (learn, held):  # texts that were not learned from replace those that were
        for language in range(k):
            found = [e[1] @ model.table[e[0], -1] for e in group if e[2] == language]
            if found:
                model.usual[language] = np.mean(found)
    own = model.familiarity(means[:, -1], z.argmax(axis=1), n)
    foreign, foreign_p = [], []
    without = {}
    if np.count_nonzero(documents) > 1:
        for language in set(y.tolist()):
            gone = np.zeros(BUCKETS)
            for idx, share, label, *_ in learn:
                if label == language:
                    gone[idx] += share / documents[language]
            without[language] = log_frequency(np.maximum(frequency - gone, 0) / (np.count_nonzero(documents) - bool(documents[language])))
            for i in np.flatnonzero(y == language):
                left = np.where(np.arange(k) == language, -np.inf, z[i])
                idx, share = held[i][:2]
                foreign.append(model.familiarity(share @ without[language][idx], int(left.argmax()), n[i]))
                foreign_p.append(softmax(left / model.temperature).max())
            del without[language]
    for e in held:
        mean, count = model.means(shuffled(e[4], rng))
        p = softmax(model.logits(mean) / model.temperature)
        foreign.append(model.familiarity(mean[-1], int(p.argmax()), count))
        foreign_p.append(p.max())
    foreign = np.array(foreign)
    model.familiar = logistic(np.r_[own, foreign], np.r_[np.ones(len(own)), np.zeros(len(foreign))])
    p = softmax(z / model.temperature)
    scores = p.max(axis=1) * model.known(own)
    right = np.sort(scores[p.argmax(axis=1) == y])
    if len(right):
        lowest = float(right[int(len(right) * REJECTED)])
        highest = float(np.quantile(np.array(foreign_p) * model.known(foreign), 1 - REJECTED))
        model.threshold = min(lowest, (lowest + highest) / 2)


def best_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, where every answer is wrong once in len(y) + 2 times."""
    n, k = z.shape
    if k < 2:
        return 1.0
    target = np.full((n, k), 1 / (n + 2) / (k - 1))
    target[np.arange(n), y] = (n + 1) / (n + 2)

    def loss(t: float) -> float:
        scaled = z / t
        top = scaled.max(axis=1, keepdims=True)
        return float((target * (top + np.log(np.exp(scaled - top).sum(axis=1, keepdims=True)) - scaled)).sum())

    return float(min(np.geomspace(1e-3, 1e3, 241), key=loss))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression in which both classes weigh alike."""
    each = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    centre, scale = x.mean(), max(x.std(), 1e-9)
    u = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(2)

    def loss(w: np.ndarray) -> float:
        m = u @ w
        return float(each @ (np.logaddexp(0, m) - target * m))

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(u @ w, -500, 500)))
        slope = u.T @ (each * (p - target))
        step = np.linalg.solve((u.T * (each * p * (1 - p))) @ u + 1e-9 * len(x) * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    slope = max(0.0, w[0]) / scale
    return slope, float(w[1] - slope * centre)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learns from (doc_id, text, lang) where crc32(doc_id as text) mod 3 is not 1.

    Every language is learned, from `per_language` texts at most and from fewer where
    `labelled_sample` would take too many in all. Texts over its bound in characters are left out.
    """
    rows = docs.filter(remainder("doc_id", 3) != 1).select("lang", "text")
    return fit(labelled_sample(rows, "lang", per_language))


ANSWER = T.StructType().add("lang", T.StringType()).add("score", T.DoubleType()).add("rejected", T.BooleanType())


def predictor(model: Model):
    """A column function: text -> struct(lang, score, rejected)."""

    @arrow_udf(ANSWER)
    def predict(texts: pa.Array) -> pa.Array:
        answers = [model.predict(x.as_py()) for x in texts]
        give_back()
        lang, score, rejected = zip(*answers) if answers else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
            names=["lang", "score", "rejected"],
        )

    return predict


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected), a row for each row of `docs`.

    Only the text decides. A null text, or one without a letter, is `und` with score 0 and is
    rejected, and so is everything if no row can be learned from. A text in none of the learned
    languages still gets the nearest as `lang_pred`, with a low score, and is rejected. Rows without
    doc_id count as held out; an empty table has no answers; long texts are read whole.
    """
    predict = predictor(train(docs, per_language))
    answer = bounded(docs).select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(True)).alias("held_out"), predict("text").alias("answer"))
    return answer.select(
        "doc_id", "held_out", F.col("answer.lang").alias("lang_pred"), "answer.score", "answer.rejected"
    )


def keep_identified(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows whose language is not rejected, with all their columns, whatever those are called.

    Null texts and texts without a letter are rejected, so an empty table stays empty. Texts of
    any length are scored whole.
    """
    docs, named = apart(docs, ("doc_id", "text", "lang"))
    predict = predictor(train(docs, per_language))
    return named(bounded(docs).withColumn("_answer", predict("text")).filter("NOT _answer.rejected"))
