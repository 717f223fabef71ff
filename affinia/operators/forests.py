"""Forests of randomised trees, all folds grown together: drawn cuts, or bootstrap samples and best cuts.

Trees grow level by level. One aggregation finds the range of each feature in each open node; the
features that a node tries are then drawn by a hash of (fold, tree, node, feature). In extremely randomised
trees so is the cut of each, and a second aggregation counts what falls left of it. In a random forest the second
aggregation is a histogram of the tried features between their ends in the node, every cut of which is compared, and
how often a tree sees a row is a hashed Poisson number. Draws depend on nothing but their keys. Once they are drawn a
tree knows rows of the same bins (a kind) by two numbers, how often it sees each class, so all sums are whole numbers and
the order of adding up decides nothing. Trees are grown in
groups that end at the asked lengths, and a kind keeps the running sum of its trees' votes at each
asked depth: a tree cut off at a depth is the tree that a fit to that depth would have grown.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.operators.boosting import (
    DIGITS, MOST_SUMS, ONE_BLOCK, Block, binned, fits_one_block, quantiles, rows_in_blocks, whole_block,
)
from affinia.session import shared_dir, store

DEEPEST = 30  # the depth of "unlimited" trees
PRIME = (1 << 31) - 1
FACTOR = 739982445
NO_CUT = 255  # the last bin, after which nothing can be cut
TREES = 50  # that a task grows where it holds the whole table
SLICE = 500_000  # (kind, tree) pairs that a task holds at once


def drawn(seed: int, fold, tree, node, feature) -> np.ndarray:
    """Whole numbers in [0, PRIME) that look random, from 64-bit arithmetic that any engine has."""
    x = (np.asarray(tree, np.int64) * 1000003 + np.asarray(fold, np.int64) * 10007 + np.asarray(feature, np.int64) * 101 + seed) % PRIME
    x = (x * 48271 + np.asarray(node, np.int64)) % PRIME
    for _ in range(3):
        x = ((x ^ (x >> 15)) * FACTOR) % PRIME
    return x


@dataclass
class Grove:
    """Trees of one group, their nodes in common arrays: root i is tree i, a right child follows the left one."""

    fold: np.ndarray  # of each tree: the fold kept out of it
    number: np.ndarray  # of each tree within its fold
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int16))  # -1: a leaf
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))
    child: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    share: np.ndarray = field(default_factory=lambda: np.zeros(0))  # weight share of class 1
    name: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # 1, then 2i and 2i + 1 under i
    tree: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    def add(self, name, tree) -> np.ndarray:
        """New leaves; returns their places."""
        n, at = len(name), len(self.feature)
        for column, more in (
            ("feature", np.full(n, -1, np.int16)), ("cut", np.zeros(n, np.uint8)), ("child", np.zeros(n, np.int32)),
            ("share", np.zeros(n)), ("name", np.asarray(name, np.int64)), ("tree", np.asarray(tree, np.int32)),
        ):
            setattr(self, column, np.r_[getattr(self, column), more])
        return np.arange(at, at + n)

    def step(self, bins: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The next node of each (row, node); leaves stay."""
        feature = self.feature[at]
        inner = feature >= 0
        right = bins[row, np.maximum(feature, 0)] > self.cut[at]
        return np.where(inner, self.child[at] + right, at)


@dataclass
class Pairs:
    """Kinds in open nodes, one row a kind and tree: the kind's bins, the node's place and how often each class is seen."""

    bins: np.ndarray  # of all kinds
    kind: np.ndarray
    slot: np.ndarray
    seen: tuple[np.ndarray, np.ndarray]

    def part(self, which) -> Pairs:
        return Pairs(self.bins, self.kind[which], self.slot[which], (self.seen[0][which], self.seen[1][which]))

    def sorted(self) -> Pairs:
        return self.part(np.argsort(self.slot, kind="stable"))


def poisson(u: np.ndarray, other: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Poisson numbers for uniform u: by the distribution function, beyond 30 by its normal limit."""
    out, at = np.zeros(len(u)), np.flatnonzero(mean <= 30)
    mean_, u_, term = mean[at], u[at], np.exp(-mean[at])
    sum_ = term.copy()
    for k in range(1, 120):
        more = u_ > sum_
        if not more.any():
            break
        at, mean_, u_, term, sum_ = (x[more] for x in (at, mean_, u_, term, sum_))
        out[at] += 1
        term = term * mean_ / k
        sum_ += term
    if len(large := np.flatnonzero(mean > 30)):
        u, other, mean = u[large], other[large], mean[large]
        normal = np.sqrt(-2 * np.log(np.maximum(u, 1e-12))) * np.cos(2 * np.pi * other)
        out[large] = np.maximum(0, np.round(mean + np.sqrt(mean) * normal))
    return out


@dataclass
class Trees:
    """Grows trees over (bins, label, fold, weight) and adds up their votes at `depths`.

    `blocks` are the rows as arrays over the tasks, or `block` is the whole table. What a level adds up has a size that
    depends on the open nodes, a bounded number of which share a job.
    """

    edges: list[list[float]]  # the values a feature's bins end at
    depths: Sequence[int | None]
    folds: list[int]
    class_weight: np.ndarray  # of each fold: by class, both weigh the same in the rows it is not kept from
    seed: int = 42
    best_cuts: bool = False  # bootstrap samples and best cuts, else all rows and drawn cuts
    block: Block | None = None
    blocks: RDD | None = None
    splits: list[tuple] = field(default_factory=list)

    def __post_init__(self):
        self.tried = max(1, math.isqrt(len(self.edges)))  # features with a range that a node tries
        self.table = np.full((len(self.edges), max(map(len, self.edges), default=1)), np.inf)
        for j, e in enumerate(self.edges):
            self.table[j, : len(e)] = e

    def _summed(self, pairs: Pairs | None, placed: Callable, part: Callable, join: Callable) -> np.ndarray:
        """What `part` makes of the pairs in open nodes: of those given, or of the blocks by way of `placed`."""
        if pairs is not None:
            return part([pairs])
        return self.blocks.mapPartitions(lambda blocks: [part(placed(blocks))]).treeReduce(join)

    def seen(self, block: Block, fold: int, numbers: Sequence[int]) -> Iterator[np.ndarray]:
        """For each of the trees how often it sees each kind, by class."""
        if not self.best_cuts:
            rest = np.array(self.folds)[np.array(self.folds) != fold]
            sums = block.counts(rest).sum(axis=1) if len(rest) else np.zeros((len(block.kinds), 2))
            for _ in numbers:
                yield sums
            return
        train = np.flatnonzero(block.fold[:, 0] != fold)
        rows = np.c_[block.bins[train], block.label[train].astype(np.uint8), block.fold[train].astype(np.uint8)]
        name = np.array([zlib.crc32(x.tobytes()) >> 1 for x in rows], np.int64)
        weight, place = block.weight[train, 0], block.of[train] * 2 + block.label[train, 0]
        large = np.flatnonzero(weight > 30)
        for number in numbers:
            u, other = drawn(self.seed, fold, number, name, len(self.edges)) / PRIME, np.zeros(len(name))
            other[large] = drawn(self.seed + 1, fold, number, name[large], len(self.edges)) / PRIME
            times = np.bincount(place, poisson(u, other, weight), minlength=2 * len(block.kinds))
            yield times.reshape(-1, 2)

    def roots(self, block: Block, grove: Grove, some: Sequence[int]) -> Pairs:
        """All kinds that these trees of a grove see, in their roots, ordered by tree."""
        found = []
        for fold in dict.fromkeys(grove.fold[some].tolist()):
            trees = [t for t in some if grove.fold[t] == fold]
            for tree, sums in zip(trees, self.seen(block, fold, grove.number[trees].tolist())):
                kind = np.flatnonzero(sums.any(axis=1))
                found.append((kind, np.full(len(kind), tree), *sums[kind].T))
        kind, tree, *seen = (np.concatenate(x) for x in zip(*found))
        return Pairs(block.kinds, kind, tree, tuple(seen))

    # growth

    def grow(self, folds: Sequence[int], numbers: Sequence[int]) -> Grove:
        """The trees with these numbers of these folds."""
        grove = Grove(np.repeat(folds, len(numbers)), np.tile(numbers, len(folds)))
        open_ = grove.add(np.ones(len(grove.fold)), np.arange(len(grove.fold)))
        deepest = max(DEEPEST if d is None else d for d in self.depths)
        if self.block is not None:  # pairs go down with their nodes
            pairs = self.roots(self.block, grove, range(len(grove.fold))).sorted()
            for depth in range(deepest + 1):
                open_ = self._level(grove, open_, depth, depth == deepest, pairs)
                if not len(open_):
                    break
                at = grove.step(self.block.kinds, pairs.kind, names[pairs.slot] if depth else pairs.slot)
                pairs, names = self._open(replace(pairs, slot=at), open_, len(grove.feature)).sorted(), open_
            return grove
        step = max(1, MOST_SUMS // (2 * (len(self.edges) + 1)))
        for depth in range(deepest + 1):
            children = [self._level(grove, open_[i : i + step], depth, depth == deepest) for i in range(0, len(open_), step)]
            open_ = np.concatenate(children) if children else open_
            if not len(open_):
                break
        return grove

    @staticmethod
    def _open(pairs: Pairs, open_: np.ndarray, nodes: int) -> Pairs:
        """The pairs whose slot is one of the open nodes, with its place among these."""
        slots = np.full(nodes, -1, np.int64)
        slots[open_] = np.arange(len(open_))
        slot = slots[pairs.slot]
        return replace(pairs, slot=slot).part(slot >= 0)

    def _level(self, grove: Grove, open_: np.ndarray, depth: int, last: bool, pairs: Pairs | None = None) -> np.ndarray:
        """Splits the open nodes that are not pure; returns their children."""
        features, count, best_cuts = len(self.edges), len(open_), self.best_cuts
        lean, opened = replace(self, blocks=None, block=None, splits=[]), self._open

        def placed(blocks: Iterable[Block]) -> Iterator[Pairs]:
            """The pairs of the open nodes, a bounded number at a time, ordered by node."""
            for b in blocks:
                size = max(1, SLICE // len(b.kinds))
                for i in range(0, len(grove.fold), size):
                    found = lean.roots(b, grove, range(i, min(i + size, len(grove.fold))))
                    at = found.slot
                    for _ in range(depth):
                        at = grove.step(b.kinds, found.kind, at)
                    yield opened(replace(found, slot=at), open_, len(grove.feature)).sorted()

        def ranges(parts: Iterable[Pairs]) -> np.ndarray:
            """The least bin of each feature and 255 - bin, and the same of the label: one minimum gives both ends."""
            ends = np.full((count, 2 * (features + 1)), 255, np.uint8)
            for p in parts:
                for i in range(0, len(p.kind), SLICE):
                    kind, slot, low, high = (x[i : i + SLICE] for x in (p.kind, p.slot, p.seen[0] == 0, p.seen[1] > 0))
                    first = np.flatnonzero(np.diff(slot, prepend=-1))
                    bins = p.bins[kind]
                    least = np.minimum.reduceat(np.c_[bins, low.astype(np.uint8)], first)
                    most = np.maximum.reduceat(np.c_[bins, high.astype(np.uint8)], first)
                    at = slot[first]
                    ends[at] = np.minimum(ends[at], np.c_[least, 255 - most])
            return ends

        ends = self._summed(pairs, placed, ranges, np.minimum)
        chosen, cut, least, most = self._drawn(grove, open_, ends)
        class_weight = self.class_weight[np.searchsorted(self.folds, grove.fold[grove.tree[open_]])]
        best, at, share = np.full(count, -np.inf), np.zeros(count, int), np.zeros(count)
        widths = (np.where(cut == NO_CUT, 0, most - least + 1) if best_cuts else np.ones(cut.shape, int)).sum(axis=1) + 1
        turn = (np.cumsum(widths) - 1) // (MOST_SUMS // 2)
        for first in np.flatnonzero(np.diff(turn, prepend=-1)):
            of = slice(first, first + int((turn == turn[first]).sum()))
            parts = pairs and pairs.part(slice(*np.searchsorted(pairs.slot, [of.start, of.stop])))
            layout = (of, chosen[of], cut[of], least[of], most[of])
            sums = self._summed(parts, placed, lambda found: _added(found, best_cuts, *layout), np.add)
            n = of.stop - of.start
            total, sums = sums[:, :n].T * class_weight[of], sums[:, n:]
            share[of] = total[:, 1] / np.maximum(total.sum(axis=1), 1e-300)
            for j in range(cut.shape[1]):
                own = np.flatnonzero(cut[of, j] != NO_CUT)
                if not len(own):
                    continue
                size = (most - least)[of][own, j] + 1 if best_cuts else np.ones(len(own), int)
                left, sums = sums[:, : size.sum()], sums[:, size.sum() :]
                where = np.repeat(own, size)
                if best_cuts:  # from counts in bins to counts up to them, node by node; nothing is cut after the last bin
                    start = np.cumsum(size) - size
                    under = np.cumsum(left, axis=1)
                    left = under - np.repeat(under[:, start] - left[:, start], size, axis=1)
                gain = self._gains(total[where], left.T * class_weight[of][where])
                if best_cuts:
                    place = np.arange(len(where)) - np.repeat(start, size)
                    gain[start + size - 1] = -np.inf
                    top = np.maximum.reduceat(gain, start)
                    place = np.minimum.reduceat(np.where(gain == np.repeat(top, size), place, len(where)), start)
                    cut[of.start + own, j] = least[of][own, j] + place
                    gain = top
                better = gain > best[of][own]
                best[of.start + own[better]], at[of.start + own[better]] = gain[better], j
        grove.share[open_] = share
        goes = np.isfinite(best) & (not last)
        where, j, names, trees = open_[goes], at[goes], grove.name[open_[goes]], grove.tree[open_[goes]]
        grove.feature[where], grove.cut[where] = chosen[goes, j], cut[goes, j]
        children = grove.add(np.c_[2 * names, 2 * names + 1].ravel(), np.repeat(trees, 2))
        grove.child[where] = children[::2]
        for o, g, x in zip(where, best[goes], share[goes]) if self.keep_splits else ():
            tree, f = grove.tree[o], grove.feature[o]
            row = (int(grove.fold[tree]), int(grove.number[tree]), int(grove.name[o]), int(f))
            self.splits.append((*row, float(self.table[f, grove.cut[o]]), float(g), float(x)))
        return children

    keep_splits = False

    @staticmethod
    def _gains(total: np.ndarray, left: np.ndarray) -> np.ndarray:
        """How much the Gini impurity falls, -inf where a side is empty; the last axis is the class."""
        right = total - left
        parts = [(x.sum(axis=-1), 2 * x[..., 0] * x[..., 1]) for x in (total, left, right)]
        (n, all_), (nl, low), (nr, high) = [(m, y / np.maximum(m, 1e-300)) for m, y in parts]
        gain = np.round((all_ - low - high) / np.maximum(n, 1e-300), DIGITS)
        return np.where((nl > 1e-12) & (nr > 1e-12), gain, -np.inf)

    def _drawn(self, grove: Grove, open_: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """The features that each node tries, the bins they are cut after (NO_CUT: none left to try), and their ends.

        Features come in hashed order, those without a range in the node are passed over, and the cut lies anywhere
        between the least and the largest value there. Pure nodes try nothing.
        """
        features = len(self.edges)
        least, most = ends[:, :features].astype(int), 255 - ends[:, features + 1 : -1].astype(int)
        mixed = ends[:, features] != 255 - ends[:, -1]
        tree = grove.tree[open_]
        key = (grove.fold[tree][:, None], grove.number[tree][:, None], grove.name[open_][:, None])
        turn = np.where((most > least) & mixed[:, None], drawn(self.seed, *key, np.arange(features)[None, :]), PRIME)
        chosen = np.argsort(turn, axis=1, kind="stable")[:, : self.tried]
        none = np.take_along_axis(turn, chosen, 1) == PRIME
        least, most = (np.take_along_axis(x, chosen, 1) for x in (least, most))
        cut = np.where(none, NO_CUT, 0)
        if not self.best_cuts:
            low, high = (_values(self.table, chosen, x, none) for x in (least, most))
            threshold = low + drawn(self.seed + 1, *key, chosen) / PRIME * (high - low)
            for f in range(features):
                here = (chosen == f) & ~none
                cut[here] = np.searchsorted(self.table[f], threshold[here], side="right") - 1
        return chosen, cut, least, most

    # votes

    def votes(self, grove: Grove, kinds: np.ndarray) -> np.ndarray:
        """For each of the kinds the summed votes of the trees that keep a fold out, by fold and depth."""
        depths = [DEEPEST if d is None else d for d in self.depths]
        out = np.zeros((len(kinds), len(self.folds), len(depths)))
        size = max(1, SLICE // max(1, len(kinds)))
        for f, fold in enumerate(self.folds):
            trees = np.flatnonzero(grove.fold == fold)
            for i in range(0, len(trees), size):
                row, at = np.tile(np.arange(len(kinds)), len(trees[i : i + size])), np.repeat(trees[i : i + size], len(kinds))
                for depth in range(max(depths) + 1):
                    for j, d in enumerate(depths):
                        if d == depth:
                            out[:, f, j] += np.bincount(row, grove.share[at], minlength=len(kinds))
                    if depth < max(depths):
                        below = grove.step(kinds, row, at)
                        if np.array_equal(below, at):
                            for j, d in enumerate(depths):
                                if d > depth:
                                    out[:, f, j] += np.bincount(row, grove.share[at], minlength=len(kinds))
                            break
                        at = below
        return out


def _added(parts: Iterable[Pairs], best_cuts: bool, of: slice, chosen, cut, least, most) -> np.ndarray:
    """By class, how often the nodes `of` see it in all, then for one tried feature after the other, and in it for each
    node that can be cut there: in each bin between the ends, or left of the drawn cut."""
    n, tried = cut.shape
    able = cut != NO_CUT
    size = np.where(able, most - least + 1 if best_cuts else 1, 0)
    start = n + (np.cumsum(size.T.ravel()) - size.T.ravel()).reshape(tried, n).T
    sums = np.zeros((2, n + int(size.sum())))
    for p in parts:
        p = p.part((p.slot >= of.start) & (p.slot < of.stop))
        slot = p.slot - of.start
        for c in (0, 1):
            sums[c, :n] += np.bincount(slot, p.seen[c], minlength=n)
        for j in range(tried):
            here = np.flatnonzero(able[slot, j])
            if not len(here):
                continue
            s = slot[here]
            bins = p.bins[p.kind[here], chosen[s, j]].astype(np.int64)
            if best_cuts:
                place = start[s, j] + bins - least[s, j]
            else:
                left = bins <= cut[s, j]
                here, place = here[left], start[s[left], j]
            low, high = int(start[:, j].min()), int((start[:, j] + size[:, j]).max())
            for c in (0, 1):
                sums[c, low:high] += np.bincount(place - low, p.seen[c][here], minlength=high - low)
    return sums


def _values(table: np.ndarray, feature: np.ndarray, bin_: np.ndarray, lone: np.ndarray) -> np.ndarray:
    """The values that bins end at; 0 where a node has no range."""
    return np.where(lone, 0.0, table[feature, np.where(lone, 0, bin_)])


def confusion(block: Block, folds: Sequence[int], length: int) -> np.ndarray:
    """(tp, fp, fn, tn) by fold and depth from the votes in `scores`."""
    own, guess = block.counts(folds)[:, :, None], block.scores > 0.5 * length
    cases = (own[..., 1] * guess, own[..., 0] * guess, own[..., 1] * ~guess, own[..., 0] * ~guess)
    return np.array([case.sum(axis=0) for case in cases]).transpose(1, 2, 0)


def forest_counts(
    df: DataFrame, lengths: Sequence[int], depths: Sequence[int | None], best_cuts: bool, seed: int = 42, one_block: int = ONE_BLOCK
) -> Iterator[tuple]:
    """(length, depth, fold, (tp, fp, fn, tn)) over (label 0/1, features vector, fold), from one growth.

    With up to `one_block` bins (kinds times features) the trees are dealt over tasks that each hold the whole
    table, else the rows are dealt and all trees of a length grow together; the trees are the same. `best_cuts` tells
    random forests from extremely randomised trees.
    """
    edges = quantiles(df)
    if not edges:  # no rows
        return
    rows = store(binned(df, [e[:-1] for e in edges]), "binned")
    maker = trees_of(rows, edges, depths, best_cuts, seed)
    spans = list(zip([0, *sorted(lengths)], sorted(lengths)))
    found = _side_by_side if fits_one_block(rows, len(edges), one_block) else _together
    for length, counts in found(maker, rows, spans):
        for f, fold in enumerate(maker.folds):
            for j, depth in enumerate(depths):
                yield length, depth, fold, tuple(int(x) for x in counts[f, j])


def trees_of(
    rows: DataFrame, edges: list[list[float]], depths: Sequence[int | None], best_cuts: bool = False, seed: int = 42
) -> Trees:
    """The grower for (bins, label, fold, weight), still without rows."""
    totals: dict[int, list[int]] = {}
    for fold, label, n in rows.groupBy("fold", "label").agg(F.sum("weight")).collect():
        totals.setdefault(fold, [0, 0])[label] += n
    folds = sorted(totals)
    train = np.array([np.sum(list(totals.values()), axis=0) - totals[f] for f in folds], float)
    weight = train.sum(axis=1, keepdims=True) / (2 * np.maximum(train, 1))
    return Trees(edges, depths, folds, weight, seed, best_cuts)


def _together(maker: Trees, rows: DataFrame, spans: Sequence[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    shared_dir(rows.sparkSession)
    starts = np.zeros((len(maker.folds), len(maker.depths)))
    work = len(maker.folds) * max(b - a for a, b in spans)
    blocks = rows_in_blocks(rows, starts, work, len(maker.edges), at_once=starts.size)
    for before, length in spans:
        maker.blocks = blocks
        grove = maker.grow(maker.folds, range(before, length))
        lean = replace(maker, blocks=None, splits=[])

        def add(block: Block) -> Block:
            return replace(block, scores=block.scores + lean.votes(grove, block.kinds))

        older, blocks = blocks, blocks.map(add).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.checkpoint()
        folds = maker.folds
        yield length, blocks.map(lambda b: confusion(b, folds, length)).treeReduce(np.add)
        older.unpersist()
    blocks.unpersist()


def _side_by_side(maker: Trees, rows: DataFrame, spans: Sequence[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """A task grows some trees of one fold over the whole table, which is of checked size."""
    context = rows.sparkSession.sparkContext
    block = whole_block(rows)
    copied = context.broadcast(block)
    parts = [
        (length, f, list(range(a, min(a + TREES, length))))
        for before, length in spans for f in range(len(maker.folds)) for a in range(before, length, TREES)
    ]

    def fit(part: tuple) -> tuple[int, int, np.ndarray]:
        length, f, numbers = part
        own = replace(maker, block=copied.value, blocks=None, splits=[])
        found, size = 0, max(1, SLICE // len(copied.value.kinds))
        for i in range(0, len(numbers), size):
            grove = own.grow(own.folds[f : f + 1], numbers[i : i + size])
            found = found + replace(own, folds=own.folds[f : f + 1]).votes(grove, copied.value.kinds[tested(copied.value, f)])
        return length, f, found[:, 0]

    def tested(block: Block, f: int) -> np.ndarray:
        return np.unique(block.of[block.fold[:, 0] == folds[f]])

    folds = maker.folds
    votes = context.parallelize(parts, len(parts)).map(fit).collect()
    copied.destroy()
    scores = np.zeros((len(block.kinds), len(folds), len(maker.depths)))
    for _, length in spans:
        for _, f, found in (v for v in votes if v[0] == length):
            scores[tested(block, f), f] += found
        yield length, confusion(replace(block, scores=scores), folds, length)
