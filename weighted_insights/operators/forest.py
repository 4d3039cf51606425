"""A random forest for a weighted binary label, over the blocks and histograms of ``boosting.py``.

A row counts in a tree as often as a Poisson draw from (seed, tree, row key) says, so trees do not depend on how rows are dealt to
partitions.  All trees of a group grow level by level in shared scans.  A table of one partition is handed to several tasks, each
of which grows a share of the trees by the same code.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from . import boosting as B
from .boosting import Block, Layout, Rows, Tree

#: Bytes of histograms that a scan adds up, trees that grow together, and tasks that share the trees of a small table.
SCAN_BYTES = 64 << 20
TOGETHER = 50
TASKS = 8
#: Chances of being drawn at most 0, 1, 2, ... times.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


@dataclass(frozen=True)
class Forest:
    """``features`` is how many features a node may test: the root of their number (``sqrt``) or all."""

    trees: int = 300
    depth: int = 12
    min_rows: int = 5
    features: str = "sqrt"
    bins: int = 255


def times_drawn(key: np.ndarray, draw: int) -> np.ndarray:
    """How often each row counts in a tree: a Poisson draw of mean one, the same wherever the row lies."""
    drawn = (B.mix(key ^ B.mix(np.array([draw], np.uint64))) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.searchsorted(POISSON, drawn, side="right")


@dataclass(frozen=True)
class Scan:
    """What one scan adds up: positives, weight and rows per wanted node of several trees (``slots`` by tree and leaf)."""

    sizes: np.ndarray
    trees: Sequence[Tree]
    slots: Sequence[np.ndarray]
    draws: Sequence[int]
    wanted: int
    scale: float

    def __call__(self, blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        out = np.zeros((3, self.wanted, int(self.sizes.sum())))
        for block in blocks:
            for tree, slots, draw in zip(self.trees, self.slots, self.draws):
                self.rows(block, draw).add(tree, slots, self.sizes, out)
        yield out

    def rows(self, block: Block, draw: int) -> Rows:
        """The rows that a tree draws, with the weight of the positives and of all."""
        times = times_drawn(block.key, draw)
        kept = np.flatnonzero(times)
        weight = np.rint(block.w[kept] * self.scale) * times[kept]
        return Rows(block.codes[:, kept], weight * block.y[kept], weight, np.zeros(len(kept), np.int64))


@dataclass
class Planter:
    """Grows trees by number; what a tree draws depends on seed and number only."""

    layout: Layout
    forest: Forest
    scale: float
    seed: int

    def grow(self, numbers: Sequence[int], scan: Callable[[Scan], np.ndarray]) -> list[Tree]:
        column, code, ordered, feature = self.layout.places()
        features = np.unique(feature[feature >= 0])
        wanted = len(features) if self.forest.features == "all" else max(1, math.isqrt(len(features)))
        draws = [int(np.random.Generator(np.random.PCG64((self.seed, n))).integers(1 << 63)) for n in numbers]
        trees = [Tree() for _ in numbers]
        for tree in trees:
            tree.add()
        most = max(1, SCAN_BYTES // (24 * len(column)))
        level = [(t, 0) for t in range(len(trees))]
        for _ in range(self.forest.depth):
            following: list[tuple[int, int]] = []
            for start in range(0, len(level), most):
                part = level[start : start + most]
                slots = [np.full(len(tree.column), -1) for tree in trees]
                for slot, (t, node) in enumerate(part):
                    slots[t][node] = slot
                used = sorted({t for t, _ in part})
                sums = scan(Scan(self.layout.sizes, [trees[t] for t in used], [slots[t] for t in used], [draws[t] for t in used], len(part), self.scale))
                gains, left, right = self._gains(sums, ordered, feature)
                for slot, (t, node) in enumerate(part):
                    trees[t].value[node] = _share(sums[:, slot, : self.layout.sizes[0]].sum(1))
                    place = self._choose(gains[slot], feature, features, wanted, numbers[t], node)
                    if place is None:
                        continue
                    c = int(column[place])
                    pair = trees[t].split(node, c, int(code[place]), not ordered[place], int(feature[place]), self.layout.threshold(c, int(code[place])))
                    for child, side in zip(pair, (left[:, slot, place], right[:, slot, place])):
                        trees[t].value[child] = _share(side)
                        if 0 < side[0] < side[1] and side[2] >= 2 * self.forest.min_rows:
                            following.append((t, child))
            level = following
        return trees

    def _gains(self, sums: np.ndarray, ordered: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What every split takes off the impurity (times weight), and the sums of its sides."""
        first = self.layout.starts[np.repeat(np.arange(len(self.layout.sizes)), self.layout.sizes)]
        whole = sums[:, :, : self.layout.sizes[0]].sum(2)[:, :, None]
        running = np.cumsum(sums, axis=2)
        before = np.concatenate((np.zeros(running.shape[:2] + (1,)), running), axis=2)[:, :, first]
        left = np.where(ordered, running - before, whole - sums)
        right = whole - left

        def purity(side: np.ndarray) -> np.ndarray:
            p, w = side[0] / self.scale, side[1] / self.scale
            return (p * p + (w - p) ** 2) / np.maximum(w, 1e-300)

        gain = purity(left) + purity(right) - purity(whole)
        gain[(left[2] < self.forest.min_rows) | (right[2] < self.forest.min_rows) | (feature < 0)] = -np.inf
        return gain, left, right

    def _choose(self, gain: np.ndarray, feature: np.ndarray, features: np.ndarray, wanted: int, number: int, node: int) -> int | None:
        """The best place among the first ``wanted`` features, in a drawn order, that split the node at all."""
        useful = np.unique(feature[gain > 1e-12])
        if not len(useful):
            return None
        order = np.random.Generator(np.random.PCG64((self.seed, number, node))).permutation(features)
        drawn = order[np.isin(order, useful)][:wanted]
        return int(np.where(np.isin(feature, drawn), gain, -np.inf).argmax())


def _share(sums: np.ndarray) -> float:
    return float(sums[0] / sums[1]) if sums[1] > 0 else 0.5


def plant(
    train: DataFrame,
    forest: Forest = Forest(),
    features: str = "features",
    label: str = "y",
    weight: str = "w",
    key: str | None = None,
    groups: Sequence[tuple[int, int]] = (),
    seed: int = 42,
) -> list[Tree]:
    """The trees; the value of a leaf is its share of positives.  Arguments and cases without anything to learn are those of ``boost``."""
    read = B.prepared(train, features, label, weight, key, groups, forest.bins)
    if read is None or not 0 < read.positive < read.whole:
        return [_constant(0.5 if read is None else read.positive / read.whole)]
    # A row may count several times.
    planter = Planter(read.layout, forest, read.scale / len(POISSON), seed)
    blocks = B.encode(read.table.coalesce(read.parts), read.layout, 0.0)
    numbers = list(range(forest.trees))
    if read.parts == 1:
        shares = [numbers[i::TASKS] for i in range(TASKS)]
        copies = blocks.flatMap(lambda block: [(i, block) for i in range(TASKS)]).partitionBy(TASKS, int)

        def some(i: int, held: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, Tree]]:
            mine = [block for _, block in held]
            for number in shares[i]:
                growing: list[Rows] = []

                def scan(wanted: Scan) -> np.ndarray:
                    # One tree after the other; its rows go on from where the last scan left them.
                    growing.extend(wanted.rows(block, wanted.draws[0]) for block in (() if growing else mine))  # noqa: B023
                    out = np.zeros((3, wanted.wanted, int(wanted.sizes.sum())))
                    for rows in growing:  # noqa: B023
                        rows.add(wanted.trees[0], wanted.slots[0], wanted.sizes, out)
                    return out

                yield number, planter.grow([number], scan)[0]

        return [tree for _, tree in sorted(copies.mapPartitionsWithIndex(some).collect(), key=lambda found: found[0])]
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        made: list[Tree] = []
        for start in range(0, len(numbers), TOGETHER):
            made += planter.grow(numbers[start : start + TOGETHER], lambda scan: _summed(blocks, scan))
        return made
    finally:
        blocks.unpersist()


def _summed(blocks: RDD, scan: Scan) -> np.ndarray:
    return B.summed(blocks, scan)


def _constant(share: float) -> Tree:
    tree = Tree()
    tree.value[tree.add()] = share
    return tree
