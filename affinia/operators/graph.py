"""Recommend new connections by the number of mutual neighbours."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.operators.bitmaps import bitmaps, n_common, numbered
from affinia.operators.skew import heavy_keys, n_parts, n_slices, ranked, spread_join
from affinia.session import store

BROADCAST_ROWS = 2_000_000  # path ends, 16 MB
ROUND = 256  # times as many path ends are shuffled by a job
PATHS = 2_000_000  # paths that a task counts and ranks
LIST = 100_000  # links of a middle that are one list
ROUND_BYTES = 16 << 20  # vertices that one job of `_hub_best` compares all open sources with, at most
PIECE_BYTES = 1 << 20  # vertices that a source is compared with at once
HUB_LIMIT = 4096  # hubs have bits in blocks of 64, so a vertex has at most this many bits
BLOCK_BYTES = 8 << 20  # vertices that the first round of `_hub_best` compares all sources with


def mutual_neighbours(
    edges: DataFrame,
    n: int = 10,
    hub_paths: int = 100_000_000,
    busy_paths: int = 1_000_000,
    max_hubs: int = HUB_LIMIT,
    broadcast_rows: int = BROADCAST_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The best `n` candidates per vertex: `(src, candidate, n_mutual, rank)`.

    A candidate is a neighbour of a neighbour that is neither the vertex itself nor
    already its neighbour. Edges `(src, dst)` are directed, so a friend's own list
    decides. Order: most mutual neighbours first, then the smaller id.

    Two-step paths through ordinary vertices are counted where they arise: the lists of a source's neighbours
    are shuffled to it, about ROUND times `broadcast_rows` path ends at a time (0: all paths are joined and shuffled). Paths through
    hubs (in-degree times out-degree above `hub_paths`) are never
    written out, since they grow with the square of the degree: each vertex keeps
    bitmaps of the hubs it reaches and is reached from, and a pair's mutual hubs
    are the common bits. Middles above `busy_paths` are joined in slices.
    """
    links = store(edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct(), "links")
    hubs, busy, total = _large_middles(links, hub_paths, busy_paths, max_hubs)
    reach = reached = None
    if hubs:
        into = numbered(links.select(F.col("src"), "dst"), "dst", hubs)
        out_of = numbered(links.select(F.col("dst"), "src"), "src", hubs)
        reach = store(bitmaps(into, "src", len(hubs)).withColumnRenamed("bits", "reach"), "reach")
        reached = store(bitmaps(out_of, "dst", len(hubs)).withColumnRenamed("bits", "reached"), "reached")
    n_rounds = n_slices(total, ROUND * broadcast_rows) if broadcast_rows else 1
    rounds = _count_paths(links, hubs, busy, total, n_rounds if broadcast_rows else 0, reach, reached)
    if hubs or n_rounds > 1:  # each round keeps its best, so that the lists of one round are on disk at a time
        rounds = (store(_best(r, n).select("src", F.col("candidate").alias("dst"), "n_mutual"), "best") for r in rounds)
    by_path = functools.reduce(DataFrame.union, rounds)
    if not hubs:
        return _best(by_path, n)
    # A vertex that no path reaches is among the best only if it is among the best by hubs alone. One that paths
    # reach too, but that is not kept above, has n better ones there.
    by_hub = _hub_best(links, reach, reached, n, block_bytes).join(by_path, ["src", "dst"], "left_anti")
    return _best(by_path.unionByName(by_hub), n)


def _large_middles(links: DataFrame, hub_paths: int, busy_paths: int, max_hubs: int):
    degree = (
        links.select(F.col("dst").alias("v"), F.lit(1).alias("i"), F.lit(0).alias("o"))
        .unionByName(links.select(F.col("src").alias("v"), F.lit(0).alias("i"), F.lit(1).alias("o")))
        .groupBy("v")
        .agg((F.sum("i").cast("double") * F.sum("o")).alias("paths"))
    )
    degree = store(degree, "degrees")
    hubs = heavy_keys(degree, "v", hub_paths, max_hubs, F.col("paths"))
    large = heavy_keys(degree, "v", min(hub_paths, busy_paths), max_hubs + 1000, F.col("paths"))
    past = degree.filter(~F.col("v").isin(hubs)) if hubs else degree
    total = past.agg(F.sum("paths")).first()[0] or 0
    return hubs, [v for v in large if v not in set(hubs)], int(total)


def _count_paths(
    links: DataFrame, hubs: list, busy: list, total: int, rounds: int, reach: DataFrame | None, reached: DataFrame | None
) -> Iterator[DataFrame]:
    """`(src, dst, n_mutual)` for pairs that are not linked but on paths past the hubs, in disjoint rounds.

    The mutual hubs of these pairs are counted as well, by their bitmaps; only pairs of a vertex that reaches a hub and
    one that is reached from a hub are looked up.

    Every vertex also counts as its own neighbour, without a score: a path that ends in
    its middle tells that the pair is linked, which spares an anti-join. The links of each middle are one list, or
    several if there are more than LIST. A link fetches the list of its end, and the lists are shuffled by source, in
    parts of about PATHS of the `total` paths, so that paths never leave their task and nothing passes the driver. A round takes
    its share of the sources. Without rounds (0) the links are joined, path by path.
    """
    first = links.withColumnRenamed("dst", "mid")
    onward = links.filter(~F.col("src").isin(hubs)) if hubs else links
    own = links.select("dst").distinct().select(F.col("dst").alias("src"), "dst")
    second = onward.unionByName(own).withColumnRenamed("src", "mid")
    if not rounds:
        yield _with_hubs(_unlinked(spread_join(first, second, "mid", busy)), reach, reached)
        return
    if hubs:
        second = second.join(reached.select("dst", F.lit(True).alias("_near")), "dst", "left").fillna(False, "_near")
        first = first.join(reach.select("src", F.lit(True).alias("_by_hub")), "src", "left").fillna(False, "_by_hub")
    else:
        second, first = second.withColumn("_near", F.lit(False)), first.withColumn("_by_hub", F.lit(False))
    long = heavy_keys(second, "mid", LIST, 1000)
    part = F.when(F.col("mid").isin(long), F.pmod(F.xxhash64("dst"), F.lit(64))).otherwise(F.lit(0)) if long else F.lit(0)
    ends = [F.collect_list(F.when(F.col("_near") == near, F.col("dst"))).alias(name) for near, name in ((False, "_far"), (True, "_near"))]
    lists = store(second.groupBy("mid", part.alias("_part")).agg(*ends).drop("_part"), "lists")
    n = n_parts(links.sparkSession, total // rounds, PATHS)
    for k in range(rounds):
        some = first if rounds == 1 else first.filter(F.pmod(F.xxhash64("src"), F.lit(rounds)) == k)
        met = spread_join(some, lists, "mid", busy)
        all_ends = F.when(F.col("_by_hub"), F.col("_far")).otherwise(F.concat("_far", "_near")) if hubs else F.col("_far")
        pairs = _paths(met.select("src", "mid", all_ends.alias("_ends")), n)
        if hubs:
            near = _paths(met.filter("_by_hub").select("src", "mid", F.col("_near").alias("_ends")), n)
            pairs = pairs.unionByName(_with_hubs(near, reach, reached))
        yield pairs


def _paths(met: DataFrame, n: int) -> DataFrame:
    dealt = met.filter(F.size("_ends") > 0).repartition(n, "src")
    return _unlinked(dealt.select("src", "mid", F.explode("_ends").alias("dst")))


def _with_hubs(pairs: DataFrame, reach: DataFrame | None, reached: DataFrame | None) -> DataFrame:
    if reach is None:
        return pairs
    mutual = F.coalesce(n_common("reach", "reached"), F.lit(0).cast("long"))
    both = pairs.join(reach, "src", "left").join(reached, "dst", "left")
    return both.select("src", "dst", (F.col("n_mutual") + mutual).alias("n_mutual"))


def _unlinked(paths: DataFrame) -> DataFrame:
    linked = F.col("mid") == F.col("dst")
    return (
        paths.filter(F.col("src") != F.col("dst"))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n_mutual"), F.max(linked).alias("_linked"))
        .filter(~F.col("_linked"))
        .drop("_linked")
    )


def _hub_best(links: DataFrame, reach: DataFrame, reached: DataFrame, n: int, block_bytes: int) -> DataFrame:
    """`(src, dst, n_mutual)`: the best n of each source by mutual hubs alone, neither itself nor linked.

    A threshold algorithm. Targets are ranked by the number of hubs that lead to them, then by id, and cut into
    blocks of bounded size. A source is compared with block after block until no later block can
    change its list: a later target shares at most as many hubs as lead to it, and among equals the smaller
    id wins. Sources that are done leave the table. Each round takes twice as many blocks, up to ROUND_BYTES, so that
    small blocks do not make many jobs.
    """
    total = F.aggregate("reached", F.lit(0), lambda n, w: n + F.bit_count(w)).cast("int")
    counted = reached.select("dst", "reached", total.alias("total"), (-total).alias("order"))
    words = len(reached.first()["reached"])
    size = max(1, block_bytes // (8 * words + 12))
    targets = ranked(counted, [], ["order", "dst"], "place").withColumn("block", F.floor((F.col("place") - 1) / size).cast("int"))
    targets = store(targets.select("block", "place", "dst", "total", "reached"), "targets")
    ends = targets.groupBy("block").agg(F.max("total"), F.min("dst")).orderBy("block").collect()
    most, least = np.array([e[1] for e in ends]), np.array([e[2] for e in ends])
    own = reach.select("src", F.col("src").alias("dst"))
    linked = links.join(reach.select("src"), "src").join(reached.select("dst"), "dst").select("src", "dst").union(own)
    lists = linked.groupBy("src").agg(F.sort_array(F.collect_list("dst")).alias("linked"))
    none = {"scores": F.array().cast("array<int>"), "ids": F.array().cast("array<long>"), "open": F.lit(True)}
    state = store(reach.join(lists, "src").withColumns(none), "sources")
    schema, done = state.schema, []
    start, step, piece = 0, 1, max(1, PIECE_BYTES // max(1, block_bytes))
    while start < len(ends):
        stop = min(len(ends), start + step)
        rows = targets.filter(F.col("block").between(start, stop - 1)).orderBy("place").select("dst", "reached").toArrow()
        ids = rows["dst"].to_numpy()
        bits = rows["reached"].combine_chunks().flatten().to_numpy().reshape(len(ids), words).view(np.uint64)
        del rows  # the tasks need the arrays only
        # (first row, row after the last, block after the last) of what is compared at once
        pieces = [((at - start) * size, (end - start) * size, end) for at in range(start, stop, piece) for end in [min(stop, at + piece)]]

        def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                reaches = batch.column("reach").flatten().to_numpy().reshape(len(batch), words).view(np.uint64)
                out_scores, out_ids, open_ = [], [], []
                for own, linked, scores, best in zip(reaches, batch.column("linked"), batch.column("scores"), batch.column("ids")):
                    skip, used, n_own = linked.values.to_numpy(), np.flatnonzero(own), np.bitwise_count(own).sum()
                    scores, best = scores.values.to_numpy(), best.values.to_numpy()
                    for first, last, after in pieces:
                        # words without a hub of the source have no common bits
                        found = np.bitwise_count(bits[first:last, used] & own[used]).sum(axis=1, dtype=np.int64)
                        at = np.flatnonzero(found > 0)
                        near = ids[first:last][at]
                        place = np.minimum(np.searchsorted(skip, near), len(skip) - 1)
                        fresh = skip[place] != near
                        scores, best = np.r_[scores, found[at][fresh]], np.r_[best, near[fresh]]
                        order = np.lexsort((best, -scores))[:n]
                        scores, best = scores[order], best[order]
                        bound = np.minimum(n_own, most[after:])
                        more = bool(len(bound)) and bool(
                            len(best) < n or ((bound > scores[-1]) | ((bound == scores[-1]) & (least[after:] < best[-1]))).any()
                        )
                        if not more:
                            break
                    open_.append(more)
                    out_scores.append(scores.astype(np.int32))
                    out_ids.append(best)
                for name, values, kind in (
                    ("scores", out_scores, pa.list_(pa.int32())), ("ids", out_ids, pa.list_(pa.int64())), ("open", open_, pa.bool_()),
                ):
                    batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(values, kind))
                yield batch

        state = store(state.mapInArrow(compare, schema), "sources")
        done.append(state.filter("NOT open"))
        state = state.filter("open")
        if state.isEmpty():
            break
        start, step = stop, max(1, min(2 * step, ROUND_BYTES // max(1, block_bytes)))
    best = functools.reduce(DataFrame.union, done)
    pairs = best.select("src", F.explode(F.arrays_zip("ids", "scores")).alias("p"))
    return pairs.select("src", F.col("p.ids").alias("dst"), F.col("p.scores").cast("long").alias("n_mutual"))


def _best(scored: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("src").orderBy(F.col("n_mutual").desc(), F.col("dst"))
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("src", F.col("dst").alias("candidate"), "n_mutual", "rank")
    )


def recommend_friends(vertices: DataFrame, edges: DataFrame, n: int = 10, **limits) -> DataFrame:
    """One row `(id, recs array)` per vertex, best candidate first, empty if there is none."""
    best = mutual_neighbours(edges, n, **limits)
    lists = best.groupBy("src").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "candidate"))), lambda r: r["candidate"]
        ).alias("recs")
    )
    return vertices.join(lists, vertices["id"] == lists["src"], "left").select(
        "id", F.coalesce("recs", F.array().cast("array<long>")).alias("recs")
    )
