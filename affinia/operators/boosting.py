"""Boosted trees for many models at once: level-wise histograms, running scores, every prefix kept.

All folds and settings of a study advance together. The rows are binned once, and rows that share
bins, label and fold become one with a weight. A model gives one score to all rows of the same bins (a kind),
so it is fitted on kinds, each with its training weight by class. A level of the current tree of every model is
one job: tasks add up histograms of (weight, gradient, Hessian) for each open node, feature and bin,
whose size depends on the trees and not on the rows, and the best split of each node is read off the
sums. A kind's scores are an array, one running sum a
model, so a fit of 300 rounds also gives the predictions of 100 and 200.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.session import shared_dir, store

BINS = 256
STORE_EVERY = 10  # rounds after which scores are brought up to date, which bounds what a task recomputes
CHECKPOINT_EVERY = 5  # of these, after which they are written to the shared folder
ONE_BLOCK = 4_000_000  # bins (bytes) of a table that every task may hold
MOST_SUMS = 4_000_000  # numbers that one job adds up; a level with more open nodes takes several
WORK = 4_000_000  # (row, model, feature) triples a task adds up, roughly
SLICE = 500_000  # (row, model) pairs held in memory at once
DIGITS = 9  # gains and least Hessians are compared to this many decimals, so that the order of a sum decides nothing


# -- binning ------------------------------------------------------------------


def quantiles(df: DataFrame, bins: int = BINS) -> list[list[float]]:
    """The distinct quantiles of each feature, ascending; the first and last are its extremes.

    They are exact to a ten-thousandth of the rows, and `bins` numbers a feature reach the driver.
    """
    shares = F.array(*[F.lit(i / (bins - 1)) for i in range(bins)])
    values = df.select(F.posexplode(vector_to_array("features")).alias("feature", "value"))
    found = values.groupBy("feature").agg(F.percentile_approx("value", shares, 10_000).alias("q")).collect()
    edges: list[list[float]] = [[] for _ in found]
    for row in found:
        edges[row.feature] = sorted(set(row.q))
    return edges


def cut_points(df: DataFrame, bins: int = BINS) -> list[list[float]]:
    """Where each feature may be split: all its quantiles but the largest value."""
    return [e[:-1] for e in quantiles(df, bins)]


def binned(df: DataFrame, cuts: Sequence[Sequence[float]]) -> DataFrame:
    """(bins, label, fold, weight): a byte a feature, the number of its cuts below the value.

    Rows alike in all of these are one row with a weight.
    """
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().reshape(len(batch), len(edges))
            found = np.empty(values.shape, np.uint8)
            for j, edge in enumerate(edges):
                found[:, j] = np.searchsorted(edge, values[:, j])
            packed = pa.array([row.tobytes() for row in found], pa.binary())
            yield pa.RecordBatch.from_arrays([packed, batch.column(1), batch.column(2)], names=["bins", "label", "fold"])

    rows = df.select(vector_to_array("features").alias("x"), F.col("label").cast("int"), F.col("fold").cast("int"))
    packed = rows.mapInArrow(run, "bins binary, label int, fold int")
    return packed.groupBy("bins", "label", "fold").agg(F.count(F.lit(1)).alias("weight"))


# -- objectives ---------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class Objective:
    """What a round fits. Statistics of a kind are (n, g, h), sums of them decide splits and leaf values."""

    stats: Callable  # (weight of class 0, of class 1, scores, positive weight) -> n, g, h
    gain: Callable  # (n, g, h of the left side, n, g, h of the node) -> gain, -inf where not allowed
    value: Callable  # (n, g, h) -> leaf value
    multiplier: str = "rate"  # or "vote": the leaf is a class and the tree's say follows from its error


LAMBDA, GAMMA, LEAST_HESSIAN = 1.0, 0.0, 1.0


def _logistic(n0, n1, scores, positive):
    """Gradient and Hessian of the log loss; the weights of both classes count in both."""
    w1 = n1 * positive
    p = _sigmoid(scores)
    return n0 + n1, n0 * p + w1 * (p - 1), (n0 + w1) * p * (1 - p)


def _second_order_gain(nl, gl, hl, n, g, h):
    gr, hr = g - gl, h - hl
    gain = 0.5 * (gl**2 / (hl + LAMBDA) + gr**2 / (hr + LAMBDA) - g**2 / (h + LAMBDA)) - GAMMA
    return np.where((np.round(hl, DIGITS) >= LEAST_HESSIAN) & (np.round(hr, DIGITS) >= LEAST_HESSIAN), gain, -np.inf)


def _variance_gain(nl, gl, hl, n, g, h):
    """How much the squared error of the gradient falls."""
    nr, gr = n - nl, g - gl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl**2 / nl + gr**2 / nr - g**2 / n
    return np.where((nl > 0) & (nr > 0), gain, -np.inf)


def _vote_stats(n0, n1, scores, positive):
    """Weights of discrete AdaBoost: missed rows have grown by e^alpha, up to a common factor."""
    w0, w1 = n0 * np.exp(0.5 * scores), n1 * np.exp(-0.5 * scores)
    return w0 + w1, w1, np.zeros_like(w1)


def _gini_gain(nl, gl, hl, n, g, h):
    nr, gr = n - nl, g - gl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (2 * g * (n - g) / n - 2 * gl * (nl - gl) / nl - 2 * gr * (nr - gr) / nr) / n
    return np.where((nl > 0) & (nr > 0), gain, -np.inf)


OBJECTIVES = {
    "second_order": Objective(_logistic, _second_order_gain, lambda n, g, h: -g / (h + LAMBDA)),
    "first_order": Objective(_logistic, _variance_gain, lambda n, g, h: -g / max(h, 1e-150)),
    "vote": Objective(_vote_stats, _gini_gain, lambda n, g, h: 1.0 if 2 * g > n else -1.0, "vote"),
}


@dataclass(frozen=True)
class Model:
    """One of the models that advance together: the rows of `fold` are kept out of its fit."""

    fold: int
    rate: float
    depth: int
    start: float = 0.0
    positive: float = 1.0


# -- trees --------------------------------------------------------------------


@dataclass
class Trees:
    """The trees of one round, a row a model. Node 0 is the root, the right child follows the left one."""

    feature: np.ndarray  # -1: a leaf
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(nodes: Sequence[Sequence[tuple]]) -> Trees:
        """From lists of (feature, cut, left child, value)."""
        width = max((len(n) for n in nodes), default=1) or 1
        out = Trees(*(np.full((len(nodes), width), x, t) for x, t in ((-1, np.int16), (0, np.uint8), (0, np.int32), (0.0, float))))
        for m, tree in enumerate(nodes):
            for i, (f, cut, child, value) in enumerate(tree):
                out.feature[m, i], out.cut[m, i], out.child[m, i], out.value[m, i] = f, cut, child, value
        return out

    def step(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The next node of each row and model; leaves stay."""
        rows, models = np.arange(len(bins))[:, None], np.arange(len(self.feature))[None, :]
        feature = self.feature[models, at]
        right = bins[rows, np.maximum(feature, 0)] > self.cut[models, at]
        return np.where(feature >= 0, self.child[models, at] + right, at)

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in, by row and model."""
        at = np.zeros((len(bins), len(self.feature)), np.int32)
        while True:
            below = self.step(bins, at)
            if np.array_equal(below, at):
                return at
            at = below

    def values(self, bins: np.ndarray) -> np.ndarray:
        return self.value[np.arange(len(self.feature))[None, :], self.leaves(bins)]


@dataclass
class Block:
    """Some rows of a task: arrays of bins (a row each), label, fold and weight, and their kinds.

    A kind is what rows of the same bins have in common: `kinds` has their bins, `of` the kind of each row, and
    `scores` has a row for each kind.
    """

    bins: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    weight: np.ndarray
    kinds: np.ndarray
    of: np.ndarray
    scores: np.ndarray

    def counts(self, folds: Sequence[int]) -> np.ndarray:
        """The weight of each kind by fold and class; rows of other folds are left out."""
        folds = np.asarray(folds)
        own = np.minimum(np.searchsorted(folds, self.fold[:, 0]), len(folds) - 1)
        here = folds[own] == self.fold[:, 0]
        place = (self.of * len(folds) + own) * 2 + self.label[:, 0]
        sums = np.bincount(place[here], self.weight[here, 0], minlength=len(self.kinds) * len(folds) * 2)
        return sums.reshape(len(self.kinds), len(folds), 2)

    def weights(self, folds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By kind and model, the weight by class of the rows outside the model's fold."""
        every, at = np.unique(folds, return_inverse=True)
        both = np.bincount(self.of * 2 + self.label[:, 0], self.weight[:, 0], minlength=2 * len(self.kinds)).reshape(-1, 1, 2)
        train = (both - self.counts(every))[:, at]
        return train[..., 0], train[..., 1]


def _entries(kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The bins other than 0 of all kinds: where a kind's begin, how many it has, and their places in a histogram.

    What a node's histogram has in bin 0 of a feature is the rest of the node, so flags cost nothing where they are not set.
    """
    row, feature = np.nonzero(kinds)
    many = np.bincount(row, minlength=len(kinds))
    return np.cumsum(many) - many, many, offsets[feature] + kinds[row, feature]


def _block(packed: Sequence[bytes], label, fold, weight, starts: np.ndarray) -> Block:
    bins = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    names, of = np.unique(np.array([bytes(p) for p in packed], object), return_inverse=True)
    kinds = np.frombuffer(b"".join(names), np.uint8).reshape(len(names), -1)
    label, fold, weight = (np.asarray(x, np.int64)[:, None] for x in (label, fold, weight))
    return Block(bins, label, fold, weight.astype(float), kinds, of, np.tile(starts, (len(names), *[1] * starts.ndim)))


def _blocks(starts: np.ndarray, size: int):
    """Rows (bins, label, fold, weight) of a partition in blocks."""

    def run(rows: Iterable) -> Iterator[Block]:
        rows = iter(rows)
        while part := list(itertools.islice(rows, size)):
            yield _block([bytes(r[0]) for r in part], *([r[i] for r in part] for i in (1, 2, 3)), starts)

    return run


def rows_in_blocks(rows: DataFrame, starts: np.ndarray, models: int, features: int, at_once: int | None = None) -> RDD:
    """The rows (bins, label, fold, weight) as kept blocks of arrays, each with `starts` as scores of its kinds.

    The number of tasks follows from the work for each row and from the memory that rows take. Rows of the same bins
    come one after the other, so that a block has few kinds. `at_once` is how many numbers a row takes in memory, if not
    one for each model.
    """
    spark, n, work = rows.sparkSession, rows.count(), max(1, models * features)
    parallel = spark.sparkContext.defaultParallelism + n * (features + 8 * starts.size) // (64 << 20)
    parts = max(1, min(-(-n * work // WORK), parallel))
    dealt = rows.select("bins", "label", "fold", "weight").repartition(parts, "bins").sortWithinPartitions("bins", "label", "fold")
    laid_out = store(dealt, "blocks").coalesce(parts)
    return laid_out.rdd.mapPartitions(_blocks(starts, max(1, SLICE // max(1, at_once or models)))).persist(StorageLevel.MEMORY_AND_DISK)


def fits_one_block(rows: DataFrame, features: int, one_block: int) -> bool:
    """Whether a task may hold the whole table: its kinds have up to `one_block` bins, and its rows are few as well."""
    if rows.count() * 4 > one_block:
        return False
    return rows.select("bins").distinct().count() * features <= one_block


def whole_block(rows: DataFrame, scores: int = 0) -> Block:
    """A table of checked size on the driver."""
    found = rows.select("bins", "label", "fold", "weight").toArrow()
    return _block(found["bins"].to_pylist(), *(found[c].to_numpy() for c in ("label", "fold", "weight")), np.zeros(scores))


@dataclass
class Booster:
    """Rounds of `objective` for all `models` over a table of (bins, label, fold, weight).

    `trees` holds what each round found; `splits` the statistics of its nodes as rows
    (round, model, node, feature, cut, gain, n, g, h, value), node 1 being the root and 2i, 2i + 1 the children of i.

    A fit is thousands of short jobs. They run over blocks of arrays, kept by the executors and
    made again from the stored table if one is lost; a job's sums are added up pairwise
    on the executors and have a size that depends on the open nodes alone.
    """

    objective: str
    models: list[Model]
    cuts: list[list[float]]
    store_every: int | None = None
    trees: list[Trees] = field(default_factory=list)
    says: list[np.ndarray] = field(default_factory=list)
    splits: list[tuple] = field(default_factory=list)

    def __post_init__(self):
        self.live = np.ones(len(self.models), bool)
        # deep trees take several jobs a round, each of which adds what is pending
        self.store_every = self.store_every or max(1, STORE_EVERY // max(m.depth for m in self.models))
        self.pending: list[Trees] = []
        self.blocks: RDD | None = None
        self.block: Block | None = None  # instead of `blocks` where one block is the whole table
        self.weights = self.entries = self.stats = self.at = None  # of that block, the last two in this round
        self.advances = 0

    # the scores

    def begin(self, rows: DataFrame) -> Booster:
        """Takes (bins, label, fold, weight) and gives each row the start of every model."""
        shared_dir(rows.sparkSession)
        starts = np.array([m.start for m in self.models], float)
        self.blocks = rows_in_blocks(rows, starts, len(self.models), len(self.cuts))
        return self

    def advance(self) -> None:
        """Adds all rounds so far to the kept scores."""
        if self.pending:
            pending, before = list(self.pending), self.blocks

            def add(block: Block) -> Block:
                return replace(block, scores=block.scores + sum(t.values(block.kinds) for t in pending))

            self.pending = []
            if self.block is not None:  # whose kinds stand in the leaves of the one tree
                every = np.arange(len(self.models))[None, :]
                self.block.scores = self.block.scores + pending[0].value[every, pending[0].step(self.block.kinds, self.at)]
                return
            self.blocks = before.map(add).persist(StorageLevel.MEMORY_AND_DISK)
            self.advances += 1
            if self.advances % CHECKPOINT_EVERY == 0:
                self.blocks.checkpoint()
            self.blocks.count()
            before.unpersist()

    def _summed(self, part: Callable[[Iterable[Block]], Iterator[np.ndarray]]) -> np.ndarray:
        """The sums that `part` makes of some blocks, over all blocks."""
        if self.block is not None:
            return next(part([self.block]))
        return self.blocks.mapPartitions(part).treeReduce(np.add)

    def hold(self, block: Block) -> Booster:
        """Takes the whole table as one block, not shared with other boosters, which holds the starts of every model."""
        starts = np.array([m.start for m in self.models], float)
        self.block, self.store_every = replace(block, scores=np.tile(starts, (len(block.kinds), 1))), 1
        self.weights = self.block.weights(np.array([m.fold for m in self.models]))
        self.entries = _entries(block.kinds, np.cumsum([0, *(len(c) + 1 for c in self.cuts)]))
        return self

    def scores(self) -> dict[tuple[bytes, int, int], np.ndarray]:
        """The scores of all rows on the driver, for small tables."""
        self.advance()
        keyed = self.blocks.flatMap(lambda b: [((b.bins[i].tobytes(), int(b.label[i, 0]), int(b.fold[i, 0])), b.scores[b.of[i]]) for i in range(len(b.bins))])
        return dict(keyed.collect())

    def end(self) -> None:
        self.blocks.unpersist()

    # one level

    def _best_splits(self, tree: Trees, open_: list[tuple[int, int]]) -> list[tuple]:
        """(feature, cut, gain, nl, gl, hl, n, g, h) for each open (model, node), in turn."""
        objective, features = OBJECTIVES[self.objective], len(self.cuts)
        pending, count = list(self.pending), len(open_)
        offsets = np.cumsum([0, *(len(c) + 1 for c in self.cuts)])
        width, folds = int(offsets[-1]), np.array([m.fold for m in self.models])
        positive = np.array([m.positive for m in self.models])[None, :]
        slots = np.full(tree.feature.shape, -1, np.int64)
        slots[tuple(np.array(open_).T)] = np.arange(count)
        every = np.arange(len(self.models))[None, :]
        held, entries = ((self.stats, self.at), self.entries) if self.block is not None else (None, None)

        def histograms(blocks: Iterable[Block]) -> Iterator[np.ndarray]:
            """Sums of n, g and h for each open node, feature and bin."""
            sums = np.zeros((3, count, width))
            for b in blocks:
                if held:
                    stats, at = held
                else:
                    scores = b.scores + sum(t.values(b.kinds) for t in pending)
                    stats, at = objective.stats(*b.weights(folds), scores, positive), tree.leaves(b.kinds)
                slot = slots[every, at]
                row, model = np.nonzero((slot >= 0) & (stats[0] > 0))
                slot, first, many, place = slot[row, model], *(entries or _entries(b.kinds, offsets))
                each = many[row]
                at = np.repeat(first[row] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                place = np.repeat(slot * width, each) + place[at]
                for total, stat in zip(sums, stats):
                    stat = stat[row, model]
                    found = np.bincount(place, np.repeat(stat, each), minlength=count * width).reshape(count, width)
                    all_ = np.bincount(slot, stat, minlength=count)
                    found[:, offsets[:-1]] = all_[:, None] - np.add.reduceat(found, offsets[:-1], axis=1)
                    total += found
            yield sums

        sums = self._summed(histograms)
        totals = sums[:, :, : offsets[1]].sum(axis=2)
        widths, cut_at = np.diff(offsets), offsets[:-1] - np.arange(features)  # a feature has a cut less than bins
        gains, under = np.full((count, width - features), -np.inf), np.zeros((3, count, width - features))
        for bins in np.unique(widths[widths > 1]):  # features with as many bins together
            own = np.flatnonzero(widths == bins)
            left = np.cumsum(sums[:, :, offsets[own][:, None] + np.arange(bins)], axis=-1)[..., :-1]
            cuts = cut_at[own][:, None] + np.arange(bins - 1)
            gains[:, cuts] = np.round(objective.gain(*left, *(x[:, None, None] for x in totals)), DIGITS)
            under[:, :, cuts] = left
        if not gains.shape[1]:
            return [(0, 0, -np.inf, 0.0, 0.0, 0.0, *total) for total in totals.T.tolist()]
        at, rows = gains.argmax(axis=1), np.arange(count)
        feature = np.searchsorted(cut_at, at, side="right") - 1
        return list(zip(feature.tolist(), (at - cut_at[feature]).tolist(), gains[rows, at].tolist(), *under[:, rows, at].tolist(), *totals.tolist()))

    # rounds

    def round(self) -> None:
        """One more tree for every model."""
        objective, width = OBJECTIVES[self.objective], len(self.models)
        nodes: list[list[tuple]] = [[] for _ in self.models]  # feature, cut, child, value
        sums: list[list[tuple]] = [[] for _ in self.models]  # n, g, h
        names: list[list[int]] = [[1] for _ in self.models]
        open_: list[list[int]] = [[0] if self.live[m] else [] for m in range(width)]
        for m in range(width):
            nodes[m].append((-1, 0, 0, 0.0))
        if self.block is not None:
            positive = np.array([m.positive for m in self.models])[None, :]
            self.stats = objective.stats(*self.weights, self.block.scores, positive)
            self.at = np.zeros(self.block.scores.shape, np.int32)
        for depth in range(max(m.depth for m in self.models)):
            asked = [(m, node) for m, o in enumerate(open_) if self.models[m].depth > depth for node in o]
            if not asked:
                break
            tree, found = Trees.of(nodes), []
            if self.block is not None:
                self.at = tree.step(self.block.kinds, self.at)
            step = max(1, MOST_SUMS // (3 * sum(len(c) + 1 for c in self.cuts)))
            for at in range(0, len(asked), step):
                found += self._best_splits(tree, asked[at : at + step])
            for (m, node), (feature, place, gain, nl, gl, hl, n, g, h) in zip(asked, found):
                if not sums[m]:
                    sums[m].append((n, g, h))
                    nodes[m][0] = (-1, 0, 0, objective.value(n, g, h))
                open_[m].remove(node)
                name, cut = names[m][node], (None, None, None)
                if gain > 0:
                    child = len(nodes[m])
                    nodes[m][node] = (feature, place, child, nodes[m][node][3])
                    for side, part in enumerate(((nl, gl, hl), (n - nl, g - gl, h - hl))):
                        nodes[m].append((-1, 0, 0, objective.value(*part)))
                        sums[m].append(part)
                        names[m].append(2 * name + side)
                    open_[m] += [child, child + 1]
                    cut = (feature, self.cuts[feature][place], gain)
                self.splits.append((len(self.trees), m, name, *cut, n, g, h, nodes[m][node][3]))
        for m, o in enumerate(open_):  # children at the depth limit
            for node in o:
                self.splits.append((len(self.trees), m, names[m][node], None, None, None, *sums[m][node], nodes[m][node][3]))
        self._close(nodes, sums)

    def _close(self, nodes: list[list[tuple]], sums: list[list[tuple]]) -> None:
        """Scales the trees of a round by their rate, or by their say, and adds them."""
        says = np.array([m.rate for m in self.models])
        if OBJECTIVES[self.objective].multiplier == "vote":
            for m, model in enumerate(self.models):
                says[m] = 0.0
                if self.live[m] and sums[m]:
                    ends = [s for s, node in zip(sums[m], nodes[m]) if node[0] < 0]
                    err = sum(min(g, n - g) for n, g, _ in ends) / sums[m][0][0]
                    self.live[m] = 0 < err < 0.5 - 1e-12
                    says[m] = 1.0 if err <= 0 else model.rate * math.log((1 - err) / err) if self.live[m] else 0.0
        tree = Trees.of(nodes)
        tree.value = tree.value * says[:, None]
        self.trees.append(tree)
        self.says.append(says)
        self.pending.append(tree)
        if len(self.pending) >= self.store_every:
            self.advance()

    def confusion(self) -> list[tuple[int, int, int, int]]:
        """(tp, fp, fn, tn) of each model on its own fold, after the rounds so far."""
        self.advance()
        folds = np.array([m.fold for m in self.models])

        def count(blocks: Iterable[Block]) -> Iterator[np.ndarray]:
            sums = np.zeros((4, folds.size))
            for b in blocks:
                names, at = np.unique(folds, return_inverse=True)
                own, guess = b.counts(names)[:, at], b.scores > 0
                cases = (own[..., 1] * guess, own[..., 0] * guess, own[..., 1] * ~guess, own[..., 0] * ~guess)
                sums += [case.sum(axis=0) for case in cases]
            yield sums

        return [tuple(int(x) for x in column) for column in self._summed(count).T]

    def staged(self, lengths: Sequence[int]) -> Iterator[tuple[int, list[tuple[int, int, int, int]]]]:
        """(rounds, confusion counts of each model) at each of the lengths."""
        for turn in range(1, max(lengths) + 1):
            self.round()
            if turn in lengths:
                yield turn, self.confusion()


def fold_models(rows: DataFrame, objective: str, configs: Sequence[dict]) -> list[tuple[Model, dict]]:
    """A model for each configuration and fold of (bins, label, fold, weight), beside its configuration.

    The first-order booster starts at the log-odds of its training rows, the second-order one weighs positive rows
    by the ratio of the classes in the whole table.
    """
    counts: dict[int, list[int]] = {}
    for fold, label, n in rows.groupBy("fold", "label").agg(F.sum("weight")).collect():
        counts.setdefault(fold, [0, 0])[label] += n
    both = [sum(c[i] for c in counts.values()) for i in (0, 1)]
    models = []
    for config in configs:
        for fold in sorted(counts):
            n0, n1 = (both[i] - counts[fold][i] for i in (0, 1))
            prior = math.log(n1 / n0) if objective == "first_order" and n0 and n1 else 0.0
            positive = both[0] / both[1] if objective == "second_order" and both[0] and both[1] else 1.0
            models.append((Model(fold, config["rate"], config["depth"], prior, positive), config))
    return models


def boosted_counts(
    df: DataFrame, objective: str, configs: Sequence[dict], lengths: Sequence[int], bins: int = BINS, one_block: int = ONE_BLOCK
) -> Iterator[tuple[dict, int, int, tuple]]:
    """(config, rounds, fold, confusion counts) of every configuration, length and fold from one run.

    `df` is (label 0/1, features vector, fold). `configs` are (rate, depth) settings; every fold
    of each is a model. With up to `one_block` bins (kinds times features) the models are fitted side by side, each over
    the whole table, else together over the dealt rows, with the same result.
    """
    cuts = cut_points(df, bins)
    if not cuts:  # no rows
        return
    rows = store(binned(df, cuts), "binned")
    models = fold_models(rows, objective, configs)
    if not models:
        return
    found = _side_by_side if fits_one_block(rows, len(cuts), one_block) else _together
    every = [m for m, _ in models]
    for m, turn, counts in found(objective, every, cuts, rows, lengths):
        yield models[m][1], turn, every[m].fold, counts


def _together(objective: str, models: list[Model], cuts, rows: DataFrame, lengths: Sequence[int]) -> Iterator[tuple]:
    """(model, rounds, counts): the rows are dealt over the tasks, which advance all models together."""
    booster = Booster(objective, models, cuts).begin(rows)
    for turn, counts in booster.staged(lengths):
        for m, found in enumerate(counts):
            yield m, turn, found
    booster.end()


def _side_by_side(objective: str, models: list[Model], cuts, rows: DataFrame, lengths: Sequence[int]) -> Iterator[tuple]:
    """The same for a table of one block, of checked size: it is copied to the tasks and the models are dealt over them."""
    context = rows.sparkSession.sparkContext
    copied = context.broadcast(whole_block(rows))

    def fit(m: int) -> list[tuple]:
        booster = Booster(objective, [models[m]], cuts).hold(copied.value)
        return [(m, turn, counts[0]) for turn, counts in booster.staged(lengths)]

    found = context.parallelize(range(len(models)), len(models)).flatMap(fit).collect()
    copied.destroy()
    yield from sorted(found)
