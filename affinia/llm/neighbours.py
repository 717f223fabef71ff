"""Nearest neighbours by inner product: randomly rotated one-bit codes with error bounds.

A vector is centred on its list's centroid, scaled to length one, rotated at random and kept as
one bit a dimension, with its length and the inner product of code and vector. From the
packed bits and these scalars follows an estimate of any inner product and a bound on its error.
Vectors whose upper bound reaches the best lower bounds are computed exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.session import store

TOP = 20
QUERY_EVERY = 20
SAMPLE = 16_384  # distinct vectors that the centroids are fitted on, at most
LISTS = 1024  # most lists; fewer for few vectors
PER_LIST = 2048  # vectors aimed at in a list
RECALL = 0.985  # share of the sample's true neighbours that lie in the lists searched
TRIALS = 200  # vectors of the sample that the number of lists is fitted on
LEAST = 64  # distinct vectors searched for a query, at least (if there are so many)
QUERY_BITS = 6  # bits of a rotated query's coordinate
SIGMAS = 3.0  # width of the error bound
BLOCK = 4096  # vectors, and queries, of a list that meet in one task

INDEX = "list int, ids array<long>, code binary, length double, fit double, vector binary"


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vector as doubles), a row for each vec_id. Null, empty and zero vectors and those
    with null or non-finite components are left out, and rows without vec_id. Of the vectors of
    a repeated vec_id the largest in array order counts."""
    v = F.col("embedding").cast("array<double>")
    infinite = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = (F.size(v) > 0) & ~F.exists(v, infinite) & F.exists(v, lambda x: x != 0)
    found = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & ok).select("vec_id", v.alias("vector"))
    return found.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def distinct_vectors(vectors: DataFrame, top: int = TOP) -> DataFrame:
    """(vector, ids): each vector once, with its top + 1 smallest ids in order.

    Copies tie, and ties go to the smaller id, so a further copy can never be among the `top`
    of any query. The ids are cut before the shuffle.
    """
    order = Window.partitionBy("vector").orderBy("vec_id")
    first = vectors.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= top + 1)
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means on the bounded sample."""
    rng = np.random.default_rng(0)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest_centroid(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest_centroid(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    norms = (centres * centres).sum(axis=1)
    return np.concatenate(
        [(norms - 2 * (x[i : i + BLOCK] @ centres.T)).argmin(axis=1) for i in range(0, len(x), BLOCK)]
        or [np.zeros(0, np.int64)]
    )


def lists_needed(sample: np.ndarray, centres: np.ndarray, top: int = TOP) -> int:
    """How many lists, by inner product with the centroid, hold RECALL of the true neighbours."""
    near = nearest_centroid(sample, centres)
    ranks = []
    for i in range(min(TRIALS, len(sample))):
        score = sample @ sample[i]
        score[i] = -np.inf
        best_ones = np.argpartition(-score, min(top, len(score) - 1))[:top]
        place = np.empty(len(centres), np.int64)
        place[np.argsort(-(centres @ sample[i]), kind="stable")] = np.arange(len(centres))
        ranks.append(place[near[best_ones]])
    return int(np.quantile(np.concatenate(ranks), RECALL, method="higher")) + 1 if ranks else 1


def rotation(dimensions: int, seed: int = 1) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """(bits, length, fit) of each vector: the signs of the rotated residual, packed; its length;
    the inner product of code and unit residual."""
    rest = (x - centre) @ turn
    length = np.linalg.norm(rest, axis=1)
    signs = rest >= 0
    fit = np.abs(rest).sum(axis=1) / (np.where(length > 0, length, 1) * math.sqrt(x.shape[1]))
    return np.packbits(signs, axis=1, bitorder="little"), length, np.where(length > 0, fit, 1.0)


def _words(bits: np.ndarray) -> np.ndarray:
    """Packed bits as 64-bit words, padded with zeros."""
    wide = -(-bits.shape[1] // 8) * 8
    return np.pad(bits, ((0, 0), (0, wide - bits.shape[1]))).view(np.uint64)


def estimate(bits, length, fit, base, turned, sigmas: float = SIGMAS):
    """Estimated inner products and error bounds, queries by codes.

    base: the queries' inner products with the centre; turned: the rotated queries. A query is
    rounded to QUERY_BITS bits a coordinate; its product with a code is then a sum of bit counts.
    """
    d = turned.shape[1]
    low = turned.min(axis=1, keepdims=True)
    step = (turned.max(axis=1, keepdims=True) - low) / ((1 << QUERY_BITS) - 1)
    step[step == 0] = 1.0
    rounded = np.rint((turned - low) / step).astype(np.int64)
    words = _words(bits)
    dot = np.zeros((len(turned), len(words)))  # of the 0/1 codes with the rounded queries
    for j in range(QUERY_BITS):
        planes = _words(np.packbits((rounded >> j & 1).astype(bool), axis=1, bitorder="little"))
        dot += (1 << j) * np.bitwise_count(words[None] & planes[:, None]).sum(axis=2, dtype=np.int64)
    ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
    whole = step * rounded.sum(axis=1, keepdims=True) + low * d
    signed = 2 * (step * dot + low * ones) - whole  # of the -1/+1 codes
    about = length * signed / (math.sqrt(d) * fit)
    size = np.linalg.norm(turned, axis=1, keepdims=True)
    spread = np.sqrt(np.maximum(0, 1 - fit**2)) / fit * size / math.sqrt(max(d - 1, 1))
    return base[:, None] + about, sigmas * length * (spread + step / math.sqrt(12) / fit) + 1e-12


def best(asked, queries, bits, length, fit, vectors, ids, centre, turn, top: int = TOP):
    """(query, [(-score, vec_id)]) of each query's best in this block, exactly scored.

    A vector stays if its upper bound reaches the best lower bounds. Copies count as one here,
    and one more than `top` is kept for the query's own.
    """
    keep, out = top + 1, []
    for at in range(0, len(queries), 64):
        some = queries[at : at + 64]
        about, error = estimate(bits, length, fit, some @ centre, some @ turn)
        for name, vector, low, high in zip(asked[at : at + 64], some, about - error, about + error):
            near = np.arange(len(low))
            if len(near) > keep:
                near = np.flatnonzero(high >= np.partition(low, len(low) - keep)[len(low) - keep])
            score = (vectors[near] * vector).sum(axis=1)
            if len(near) > keep:
                least = np.partition(score, len(score) - keep)[len(score) - keep]
                near, score = near[score >= least], score[score >= least]
            pairs = sorted((-x, int(i)) for n, x in zip(near.tolist(), score.tolist()) for i in ids[n])
            out.append((name, pairs[:keep]))
    return out


def _matrix(binary) -> np.ndarray:
    rows = [np.frombuffer(b, np.float64) for b in binary]
    return np.stack(rows) if rows else np.zeros((0, 1))


def nearest(rows: DataFrame, top: int = TOP, query_every: int = QUERY_EVERY, probes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` rows found for each query, nearest first.

    Takes (vec_id, embedding). Queries are the rows whose vec_id is divisible by `query_every`,
    candidates all rows but the query's own. Ties go to the smaller vec_id. Only vectors with as
    many components as most have take part (see `usable` for the others). `probes` lists are searched
    for a query; without it the sample tells how many it takes to find RECALL of the neighbours.
    """
    spark = rows.sparkSession
    vectors = store(usable(rows), "usable")
    sizes = vectors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    d = sizes.d
    whole = store(distinct_vectors(vectors.filter(F.size("vector") == d), top), "vectors")
    n = whole.count()
    share = min(1.0, SAMPLE / n)
    drawn = whole.withColumn("draw", F.xxhash64("vector")).filter(F.pmod("draw", F.lit(1 << 30)) <= int(share * (1 << 30)))
    drawn = drawn.orderBy("draw").limit(SAMPLE).select("vector").collect()
    sample = np.array([r.vector for r in drawn])
    centres = fit_centroids(sample, max(1, min(LISTS, n // PER_LIST)))
    probes = probes or lists_needed(sample, centres, top)
    turn = rotation(d)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(len(batch), d)
            near = nearest_centroid(x, centres)
            bits, length, fit = encode(x, centres[near], turn)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(near.astype(np.int32)), batch.column(1),
                    pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length), pa.array(fit),
                    pa.array([v.tobytes() for v in x], pa.binary()),
                ],
                names=["list", "ids", "code", "length", "fit", "vector"],
            )

    index = store(whole.select("vector", "ids").mapInArrow(place, INDEX), "index")
    sizes = {r.list: r["count"] for r in index.groupBy("list").count().collect()}  # at most LISTS rows
    filled = np.array(sorted(sizes))
    count = np.array([sizes[i] for i in filled])
    centred = centres[filled]
    blocks = {int(i): -(-sizes[i] // BLOCK) for i in sizes}

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(len(batch), d)
            promise = x @ centred.T
            found = []
            for i in range(len(x)):
                order = np.argsort(-promise[i], kind="stable")
                enough = int(np.searchsorted(np.cumsum(count[order]), LEAST)) + 1
                for j in order[: max(probes, enough)].tolist():
                    name, at = batch.column(0)[i].as_py(), int(filled[j])
                    found += [(at, b, name, x[i].tobytes()) for b in range(blocks[at])]
            columns = list(zip(*found)) if found else [()] * 4
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["list", "block", "query", "vector"]
            )

    asked = vectors.filter((F.size("vector") == d) & (F.pmod("vec_id", F.lit(query_every)) == 0))
    named = store(asked.withColumn("query", F.xxhash64("vector")), "queries")
    once = named.groupBy("query").agg(F.first("vector").alias("vector"))  # equal queries are answered once
    asked_lists = once.select("query", "vector").mapInArrow(probe, "list int, block int, query long, vector binary")
    probed = store(asked_lists, "probes")
    # Queries of a list are cut into slices of about BLOCK; the list's vectors go to each of them.
    load = probed.groupBy("list", "block").agg(F.count(F.lit(1)).alias("asked"))
    slices = load.select("list", "block", F.ceil(F.col("asked") / BLOCK).cast("int").alias("slices"))
    cut = probed.join(slices, ["list", "block"]).withColumn("slice", F.pmod(F.col("query"), F.col("slices")).cast("int"))
    many = [F.lit(x) for kv in blocks.items() if kv[1] > 1 for x in kv]
    parts = F.coalesce(F.element_at(F.create_map(*many), F.col("list")), F.lit(1)) if many else F.lit(1)
    spread = index.withColumn("block", F.pmod(F.xxhash64("vector"), parts).cast("int")).join(slices, ["list", "block"])
    spread = spread.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))

    def search(key, asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        bits = np.stack([np.frombuffer(b, np.uint8) for b in block["code"]]) if len(block) else None
        found = []
        if bits is not None and len(asked):
            arrays = bits, block["length"].to_numpy(), block["fit"].to_numpy(), _matrix(block["vector"])
            names, queries = asked["query"].tolist(), _matrix(asked["vector"])
            found = best(names, queries, *arrays, block["ids"].tolist(), centres[int(key[0])], turn, top)
        best_ones = [[{"far": far, "vec_id": i} for far, i in pairs] for _, pairs in found]
        return pd.DataFrame({"query": np.array([q for q, _ in found], np.int64), "best": best_ones})

    columns = ["list", "block", "slice"]
    found = (
        cut.select(*columns, "query", "vector")
        .groupBy(*columns)
        .cogroup(spread.select(*columns, "ids", "code", "length", "fit", "vector").groupBy(*columns))
        .applyInPandas(search, "query long, best array<struct<far: double, vec_id: long>>")
    )
    # At most lists * (top + 1) entries for a query; they sort by score, then by id.
    every = found.groupBy("query").agg(F.array_sort(F.flatten(F.collect_list("best"))).alias("best"))
    ahead = every.select("query", F.slice("best", 1, top + 1).alias("best"))
    others = F.filter("best", lambda x: x["vec_id"] != F.col("query_id"))
    ranks = (
        named.select(F.col("vec_id").alias("query_id"), "query")
        .join(ahead, "query")
        .select("query_id", F.posexplode(F.slice(others, 1, top)).alias("place", "x"))
    )
    return ranks.select(
        "query_id", (F.col("place") + 1).alias("rank"), "x.vec_id", (-F.col("x.far")).alias("score")
    )
