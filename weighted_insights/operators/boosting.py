"""Second-order boosted trees for a weighted binary label, over histograms of binned columns.

Rows become blocks of small codes: a number is the position of its bin, a one-hot group is the position of its one.  A tree
grows by requests for histograms: every task adds up gradient and curvature of its rows per wanted node, column and code, and the
sums of all tasks choose the splits.  The larger child of a split is its parent less the smaller one.

Gradients are rounded to whole multiples of a power of two that keeps every sum below 2 ** 53, so sums do not depend on their
order; rows are drawn by a hash of their key, borders come from exact counts.  The same rows give the same trees however
they are dealt to partitions.  Where no rows are drawn, those with the same codes are one to every tree: a block holds their codes and
margin once, beside how many rows have each label and weight.  A scan is a job over all partitions; a table that fills only one (``PART_ROWS`` rows) grows its trees
inside that one's task by the same code, as a job per scan would be nothing but waiting.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from ..storage import settle, shared_folder
from .merging import reduced

#: Rows of a block, and rows that a partition is made for.
BLOCK_ROWS = 1 << 16
PART_ROWS = 1 << 18
#: Parts that a table of more rows has at least, so that a cluster shares its scans.
LEAST_PARTS = 16
#: Trees after which the blocks' margins are renewed, and renewals after which the lineage is cut.
RENEW = 1
CUT = 32
#: Rounds that a table of one partition grows in one job.
TOGETHER = 50


@dataclass(frozen=True)
class Growth:
    """How trees grow.

    ``shape`` is ``levels`` (all nodes down to ``depth``), ``leaves`` (best leaf first, up to ``leaves`` of them) or ``symmetric``
    (one test for a whole level).  ``rows`` and ``columns`` are the shares drawn per tree; a column of a one-hot group is drawn on
    its own.  ``penalty`` is added to the curvature of a leaf; a child needs ``min_curvature`` and ``min_rows``.
    """

    rounds: int
    shape: str = "levels"
    rate: float = 0.05
    depth: int = 6
    leaves: int = 31
    penalty: float = 1.0
    rows: float = 1.0
    columns: float = 1.0
    min_curvature: float = 0.0
    min_rows: int = 1
    from_mean: bool = True
    bins: int = 255

    def __post_init__(self) -> None:
        if self.shape not in ("levels", "leaves", "symmetric"):
            raise ValueError(f"trees grow by levels, leaves or symmetric, not {self.shape!r}")


# Codes ------------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of a multiplicative hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sortable(x: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles; its own inverse on integers."""
    bits = (x + 0.0).view(np.int64) if x.dtype == np.float64 else x
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


@dataclass(frozen=True)
class Layout:
    """Which features make which columns, and where a column's codes lie in a histogram.

    The first columns are numbers (``numbers``: their features), with ``borders``; a value belongs to the first border that is not below
    it.  Then come one-hot groups (``groups``: first feature and the one behind the last); code 0 is none of the group.
    """

    numbers: tuple[int, ...]
    groups: tuple[tuple[int, int], ...]
    borders: tuple[np.ndarray, ...] = ()

    @property
    def sizes(self) -> np.ndarray:
        """Codes per column."""
        return np.array([len(b) + 1 for b in self.borders] + [stop - start + 1 for start, stop in self.groups], np.int64)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.sizes)))

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per place of a histogram: column, code, whether columns are ordered, and the feature it stands for (-1: no split)."""
        column = np.repeat(np.arange(len(self.sizes)), self.sizes)
        code = np.arange(len(column)) - self.starts[column]
        ordered = column < len(self.numbers)
        feature = np.full(len(column), -1)
        for c, f in enumerate(self.numbers):
            # The last bin has nothing to its right.
            feature[self.starts[c] : self.starts[c + 1] - 1] = f
        for g, (start, stop) in enumerate(self.groups):
            c = len(self.numbers) + g
            feature[self.starts[c] + 1 : self.starts[c + 1]] = np.arange(start, stop)
        return column, code, ordered, feature

    def threshold(self, column: int, code: int) -> float:
        return float(self.borders[column][code]) if column < len(self.numbers) else 0.5


def layout_of(width: int, groups: Sequence[tuple[int, int]]) -> Layout:
    grouped = {f for start, stop in groups for f in range(start, stop)}
    return Layout(tuple(f for f in range(width) if f not in grouped), tuple(groups))


def read_rows(train: DataFrame, features: str, label: str, weight: str, key: str | None, layout: Layout) -> DataFrame:
    """A settled table of blocks: the numbers, the codes of the groups, label, weight and key of some rows, as bytes."""
    ship_package(train.sparkSession)
    row = F.xxhash64(key) if key else F.xxhash64(vector_to_array(features), label, weight)
    rows = train.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), row.alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                n = part.num_rows
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                numbers = np.ascontiguousarray(x[:, list(layout.numbers)].T)
                codes = [np.where((found := x[:, a:b] != 0).any(1), found.argmax(1) + 1, 0) for a, b in layout.groups]
                kind = np.min_scalar_type(max([0, *(b - a for a, b in layout.groups)]))
                parts = [numbers, np.array(codes, kind).reshape(len(codes), n), *(part.column(c).to_numpy() for c in ("y", "w", "key"))]
                yield pa.RecordBatch.from_arrays([pa.array([n]), *(pa.array([p.tobytes()], pa.binary()) for p in parts), pa.array([kind.str])], names)

    names = ["n", "numbers", "codes", "y", "w", "key", "kind"]
    return settle(rows.mapInArrow(run, "n long, numbers binary, codes binary, y binary, w binary, key binary, kind string"), "training-blocks")


def fit_borders(table: DataFrame, layout: Layout, bins: int) -> Layout:
    """Borders that cut every number into at most ``bins`` bins of nearly even counts.

    Counts per leading bits of the (sortable) numbers are exact; where a prefix holds more than its share, its next eight bits are
    counted in the next pass.  What reaches the driver are counts per prefix, at most 256 per refined one.
    """
    columns, n = len(layout.numbers), table.agg(F.sum("n").alias("n")).first()["n"] or 0
    if not columns or not n:
        return Layout(layout.numbers, layout.groups, tuple(np.zeros(0) for _ in range(columns)))
    final: list[list[tuple[int, int, int]]] = [[] for _ in range(columns)]
    heavy: list[np.ndarray] | None = None
    for shift in range(48, -1, -8):

        def run(batches, shift=shift, heavy=heavy):
            for batch in batches:
                for size, raw in zip(batch.column("n").to_pylist(), batch.column("numbers").to_pylist()):
                    for c, values in enumerate(np.frombuffer(raw, np.float64).reshape(columns, size)):
                        keys = sortable(values) >> shift
                        keys = keys if heavy is None else keys[np.isin(keys >> 8, heavy[c])]
                        prefix, count = np.unique(keys, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(prefix), c), pa.int32()), pa.array(prefix), pa.array(count)], ["c", "prefix", "count"])

        counted = table.select("n", "numbers").mapInArrow(run, "c int, prefix long, count long").groupBy("c", "prefix").agg(F.sum("count").alias("count"))
        following: list[list[int]] = [[] for _ in range(columns)]
        for c, prefix, count in counted.collect():
            if shift and count * bins > n:
                following[c].append(prefix)
            else:
                final[c].append((prefix << shift, ((prefix + 1) << shift) - 1, count))
        if not any(following):
            break
        heavy = [np.array(sorted(f), np.int64) for f in following]
    borders = []
    for ranges in final:
        ranges.sort()
        # A cut behind the range in which the running count passes another share.
        passed = np.cumsum([r[2] for r in ranges]) * bins // n if len(ranges) > bins else np.arange(len(ranges))
        cuts = [r[1] for r, a, b in zip(ranges, np.concatenate(([0], passed[:-1])), passed) if len(ranges) <= bins or b > a]
        cuts = [cut for cut in cuts if cut != ranges[-1][1]]
        borders.append(sortable(np.array(cuts, np.int64)).view(np.float64))
    return Layout(layout.numbers, layout.groups, tuple(borders))


@dataclass
class Block:
    """Codes (columns x rows), label, weight, key and margin of some rows.

    With ``of``, codes and margin are those of merged rows: label and weight stand for ``n`` equal rows, whose codes are the ``of``-th.
    """

    codes: np.ndarray
    y: np.ndarray
    w: np.ndarray
    key: np.ndarray | None
    margin: np.ndarray
    of: np.ndarray | None = None
    n: np.ndarray | None = None


def _codes(row: Mapping, layout: Layout) -> np.ndarray:
    """The codes (columns x rows) of a row of the table of :func:`read_rows`."""
    kind = np.min_scalar_type(int(max([1, *layout.sizes])) - 1)
    numbers = np.frombuffer(row["numbers"], np.float64).reshape(len(layout.numbers), row["n"])
    codes = [np.searchsorted(b, x, side="left") for b, x in zip(layout.borders, numbers)]
    codes += list(np.frombuffer(row["codes"], row["kind"]).reshape(len(layout.groups), row["n"]))
    return np.array(codes, kind).reshape(len(codes), row["n"])


def encode(table: DataFrame, layout: Layout, start: float) -> RDD:
    def run(row) -> Block:
        y, w = (np.frombuffer(row[c], np.float64) for c in ("y", "w"))
        return Block(_codes(row, layout), y, w, np.frombuffer(row["key"], np.uint64), np.full(row["n"], start))

    return table.rdd.map(run)


def merged(table: DataFrame, layout: Layout, start: float) -> tuple[RDD, int]:
    """Blocks of merged rows for growing without draws, and the number of their partitions."""
    columns, kind = len(layout.sizes), np.min_scalar_type(int(max([1, *layout.sizes])) - 1)
    equal = np.dtype([("codes", kind, (columns,)), ("y", np.float64), ("w", np.float64)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows = np.empty(row["n"], equal)
                rows["codes"] = _codes(row, layout).T
                rows["y"], rows["w"] = (np.frombuffer(row[c], np.float64) for c in ("y", "w"))
                rows, n = np.unique(rows.view(f"V{equal.itemsize}"), return_counts=True)
                fixed = pa.Array.from_buffers(pa.binary(equal.itemsize), len(rows), [None, pa.py_buffer(rows.tobytes())])
                yield pa.RecordBatch.from_arrays([fixed.cast(pa.binary()), pa.array(n, pa.int64())], ["equal", "n"])

    counted = table.select("n", "numbers", "codes", "y", "w", "kind").mapInArrow(count, "equal binary, n long")
    counted = settle(counted.groupBy("equal").agg(F.sum("n").alias("n")), "training-counts")
    parts = parts_for(counted.count())
    dealt = counted.coalesce(1) if parts == 1 else counted.repartition(parts, "equal")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                size += batch.num_rows
            if size >= BLOCK_ROWS or (batch is None and size):
                rows = b"".join(chain.from_iterable(part.column("equal").to_pylist() for part in held))
                n = np.concatenate([part.column("n").to_numpy() for part in held])
                yield pa.RecordBatch.from_arrays([pa.array([rows], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["equal", "n"])
                held, size = [], 0

    def run(row) -> Block:
        # Rows of the same codes stand together.
        rows, n = np.frombuffer(row["equal"], equal), np.frombuffer(row["n"], np.int64).astype(np.float64)
        codes = np.ascontiguousarray(rows["codes"].T)
        new = np.ones(len(rows), bool)
        new[1:] = (codes[:, 1:] != codes[:, :-1]).any(0)
        y, w = np.ascontiguousarray(rows["y"]), np.ascontiguousarray(rows["w"])
        return Block(np.ascontiguousarray(codes[:, new]), y, w, None, np.full(int(new.sum()), start), np.cumsum(new) - 1, n)

    gathered = dealt.sortWithinPartitions("equal").mapInArrow(gather, "equal binary, n binary")
    return gathered.rdd.map(run), parts


# Trees ------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Tests and values.  A row goes right if its value is above ``cut`` (a one-hot code: equals it).

    ``left`` and ``right`` are nodes, -1 at a leaf; a symmetric tree has none, its test ``d`` gives bit ``d`` of the leaf's number.
    ``feature`` and ``threshold`` say the same about feature vectors.
    """

    symmetric: bool = False
    column: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    equals: list[bool] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, column: int = -1, cut: int = 0, equals: bool = False, feature: int = -1, threshold: float = 0.0) -> int:
        """A test (of a symmetric tree) or a leaf."""
        for name, value in (("column", column), ("cut", cut), ("equals", equals), ("feature", feature), ("threshold", threshold)):
            getattr(self, name).append(value)
        if not self.symmetric:
            self.left.append(-1)
            self.right.append(-1)
            self.value.append(0.0)
        return len(self.column) - 1

    def split(self, node: int, column: int, cut: int, equals: bool, feature: int, threshold: float) -> tuple[int, int]:
        self.column[node], self.cut[node], self.equals[node], self.feature[node], self.threshold[node] = column, cut, equals, feature, threshold
        self.left[node], self.right[node] = self.add(), self.add()
        return self.left[node], self.right[node]

    def _reach(self, leaf: np.ndarray, tests: int, value: Callable[[np.ndarray, np.ndarray], np.ndarray], cut: np.ndarray, equals: np.ndarray) -> np.ndarray:
        """The leaf of each row, from where it stood after so many ``tests``; ``value`` gives what the rows hold where their tests look."""
        rows = np.arange(len(leaf))
        if self.symmetric:
            for d in range(tests, len(self.column) or len(self.feature)):
                leaf |= self._right(value(d, rows), cut[d], equals[d]).astype(np.int64) << d
            return leaf
        left, right = np.array(self.left), np.array(self.right)
        # All rows go down one level at a time, until none is left at a test.
        while len(rows := rows[left[leaf[rows]] >= 0]):
            node = leaf[rows]
            leaf[rows] = np.where(self._right(value(node, rows), cut[node], equals[node]), right[node], left[node])
        return leaf

    @staticmethod
    def _right(values: np.ndarray, cut: np.ndarray, equals: np.ndarray) -> np.ndarray:
        return np.where(equals, values == cut, values > cut)

    def leaves(self, codes: np.ndarray, leaf: np.ndarray | None = None, tests: int = 0) -> np.ndarray:
        """The leaf of every row of a block; ``leaf``, which is changed, says where they stood when the tree had so many ``tests``."""
        column, n = np.array(self.column, np.int64), codes.shape[1]
        flat, leaf = codes.ravel(), np.zeros(n, np.int64) if leaf is None else leaf
        return self._reach(leaf, tests, lambda test, rows: flat[column[test] * n + rows], np.array(self.cut), np.array(self.equals, bool))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The value of every feature vector (features x rows)."""
        feature = np.array(self.feature, np.int64)
        above = np.zeros(len(feature), bool)
        leaf = np.zeros(x.shape[1], np.int64)
        return np.array(self.value)[self._reach(leaf, 0, lambda test, rows: x[feature[test], rows], np.array(self.threshold), above)]


# Histograms -------------------------------------------------------------------------------------


@dataclass
class Rows:
    """The rows of a block that count in a growing tree, what they add to its histograms, and the leaf that each has come to."""

    codes: np.ndarray
    first: np.ndarray
    second: np.ndarray
    leaf: np.ndarray
    tests: int = 0
    n: np.ndarray | None = None  # of merged rows

    def add(self, tree: Tree, slots: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> None:
        """Add the rows to the histograms (``out``) of the slots of their leaves; they go on from the leaves of the last call."""
        self.leaf, self.tests = tree.leaves(self.codes, self.leaf, self.tests), len(tree.column)
        slot, wanted = slots[self.leaf], out.shape[1]
        rows = np.flatnonzero(slot >= 0)
        # All rows are taken as they lie.
        rows = slice(None) if len(rows) == len(slot) else rows
        slot, measures, at = slot[rows], (self.first[rows], self.second[rows], None if self.n is None else self.n[rows]), 0
        for codes, size in zip(self.codes, sizes.tolist()):
            key = slot * size + codes[rows]
            for k, measure in enumerate(measures):
                out[k, :, at : at + size] += np.bincount(key, measure, wanted * size).reshape(wanted, size)
            at += size


@dataclass(frozen=True)
class Request:
    """What one scan adds up: the histograms of the wanted nodes of a growing tree."""

    sizes: np.ndarray
    trees: tuple[Tree, ...]  # since the margins were renewed
    tree: Tree
    slots: np.ndarray  # by leaf of the growing tree; -1: not wanted
    wanted: int
    scale: float
    draw: int
    share: float

    def rows(self, block: Block) -> Rows:
        """The drawn rows, with gradient and curvature."""
        codes, y, w, margin = block.codes, block.y, block.w, renewed(block, self.trees)
        if self.share < 1:
            drawn = mix(block.key ^ mix(np.array([self.draw], np.uint64))) >> np.uint64(11)
            kept = np.flatnonzero(drawn < np.uint64(int(self.share * (1 << 53))))
            codes, y, w, margin = codes[:, kept], y[kept], w[kept], margin[kept]
        p = 1 / (1 + np.exp(-margin))
        if block.of is None:
            return Rows(codes, *self.slopes(p, y, w), np.zeros(len(y), np.int64))
        first, second, n = (np.bincount(block.of, part * block.n, len(p)) for part in (*self.slopes(p[block.of], y, w), 1.0))
        return Rows(codes, first, second, np.zeros(len(p), np.int64), n=n)

    def slopes(self, p: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.rint((p - y) * w * self.scale), np.rint(p * (1 - p) * w * self.scale)

    def sums(self, parts: Iterable[Rows]) -> np.ndarray:
        out = np.zeros((3, self.wanted, int(self.sizes.sum())))
        for rows in parts:
            rows.add(self.tree, self.slots, self.sizes, out)
        return out

    def __call__(self, blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        yield self.sums(map(self.rows, blocks))


def renewed(block: Block, trees: Sequence[Tree]) -> np.ndarray:
    margin = block.margin
    for tree in trees:
        margin = margin + np.array(tree.value)[tree.leaves(block.codes)]
    return margin


def summed(blocks: RDD, request: Callable[[Iterator[Block]], Iterator[np.ndarray]]) -> np.ndarray:
    return reduced(blocks.mapPartitions(request), np.add)


class Choice:
    """Gains of all places of histograms (nodes x places) that share a layout."""

    def __init__(self, layout: Layout, growth: Growth, scale: float):
        self.layout, self.growth, self.scale = layout, growth, scale
        self.column, self.code, self.ordered, self.feature = layout.places()
        self.first = layout.starts[self.column]
        self.allowed = self.feature >= 0

    def draw(self, random: np.random.Generator) -> None:
        """The features that the next tree may test."""
        features = np.unique(self.feature[self.feature >= 0])
        kept = max(1, round(self.growth.columns * len(features)))
        chosen = features if kept >= len(features) else random.choice(features, kept, replace=False)
        self.allowed = np.isin(self.feature, chosen) & (self.feature >= 0)

    def totals(self, histogram: np.ndarray) -> np.ndarray:
        """Gradient, curvature and rows of every node: the sum over any one column."""
        return histogram[:, :, : self.layout.sizes[0]].sum(2)

    def gains(self, histogram: np.ndarray) -> np.ndarray:
        whole = self.totals(histogram)[:, :, None]
        running = np.cumsum(histogram, axis=2)
        before = np.concatenate((np.zeros(running.shape[:2] + (1,)), running), axis=2)[:, :, self.first]
        left = np.where(self.ordered, running - before, whole - histogram)
        right = whole - left
        penalty = self.growth.penalty

        def worth(side: np.ndarray) -> np.ndarray:
            g, h = side[0] / self.scale, side[1] / self.scale
            return g * g / np.maximum(h + penalty, 1e-300)

        gain = worth(left) + worth(right) - worth(whole)
        symmetric = self.growth.shape == "symmetric"
        for side in (left, right):
            # A symmetric tree may leave a leaf empty.
            poor = (side[1] < self.growth.min_curvature * self.scale) | (side[2] < self.growth.min_rows)
            gain[poor] = 0.0 if symmetric else -np.inf
        gain[:, ~self.allowed] = -np.inf
        return gain

    def test(self, place: int) -> dict:
        c, code = int(self.column[place]), int(self.code[place])
        return {"column": c, "cut": code, "equals": not self.ordered[place], "feature": int(self.feature[place]), "threshold": self.layout.threshold(c, code)}

    def value(self, totals: np.ndarray) -> np.ndarray:
        """The step of leaves with these sums."""
        g, h = totals[0] / self.scale, totals[1] / self.scale
        return np.where(totals[2] > 0, -self.growth.rate * g / np.maximum(h + self.growth.penalty, 1e-300), 0.0)


Scan = Callable[[Tree, list[int]], np.ndarray]


def _children(scan: Scan, choice: Choice, tree: Tree, histograms: dict[int, np.ndarray], parents: list[int]) -> None:
    """Histograms of the children of ``parents``: the smaller one is added up, the other one is the rest."""
    smaller, sides = [], [(tree.left[p], tree.right[p]) for p in parents]
    for p, (left, right) in zip(parents, sides):
        column, cut = tree.column[p], tree.cut[p]
        start = choice.layout.starts[column]
        rows = histograms[p][2]
        above = rows[start + cut] if tree.equals[p] else rows[start + cut + 1 : start + choice.layout.sizes[column]].sum()
        smaller.append(right if 2 * above <= choice.totals(histograms[p][:, None])[2, 0] else left)
    found = scan(tree, smaller)
    for k, (p, (left, right)) in enumerate(zip(parents, sides)):
        other = left if smaller[k] == right else right
        histograms[smaller[k]] = found[:, k]
        histograms[other] = histograms[p] - found[:, k]


def _best(choice: Choice, histograms: dict[int, np.ndarray], nodes: list[int]) -> dict[int, tuple[float, int]]:
    """Gain and place of the best split of every node; the lowest place of equals."""
    gains = choice.gains(np.stack([histograms[n] for n in nodes], 1))
    places = gains.argmax(1)
    return {n: (float(gains[i, p]), int(p)) for i, (n, p) in enumerate(zip(nodes, places))}


def _finish(choice: Choice, tree: Tree, histograms: dict[int, np.ndarray], nodes: list[int]) -> None:
    values = choice.value(choice.totals(np.stack([histograms[n] for n in nodes], 1)))
    for n, v in zip(nodes, values.tolist()):
        tree.value[n] = v


def by_levels(scan: Scan, choice: Choice) -> Tree:
    """Every node with a gain is split, down to the depth."""
    tree = Tree()
    tree.add()
    histograms = {0: scan(tree, [0])[:, 0]}
    level = [0]
    for depth in range(choice.growth.depth):
        best = _best(choice, histograms, level)
        parents = [n for n in level if best[n][0] > 1e-12]
        if not parents:
            break
        for n in parents:
            tree.split(n, **choice.test(best[n][1]))
        if depth + 1 < choice.growth.depth:
            _children(scan, choice, tree, histograms, parents)
            level = [child for n in parents for child in (tree.left[n], tree.right[n])]
        else:
            _last(choice, tree, histograms, {n: best[n][1] for n in parents})
    _finish(choice, tree, histograms, [n for n in histograms if tree.left[n] < 0])
    return tree


def _last(choice: Choice, tree: Tree, histograms: dict[int, np.ndarray], places: dict[int, int]) -> None:
    """Sums of the last children, as histograms of one place: the parent's histogram tells them without a scan."""
    for n, place in places.items():
        histogram, first, size = histograms[n], choice.first[place], choice.layout.sizes[choice.column[place]]
        whole = histogram[:, first : first + size].sum(1)
        right = histogram[:, place] if not choice.ordered[place] else histogram[:, place + 1 : first + size].sum(1)
        for child, sums in ((tree.left[n], whole - right), (tree.right[n], right)):
            histograms[child] = np.zeros_like(histogram)
            histograms[child][:, 0] = sums


def by_leaves(scan: Scan, choice: Choice) -> Tree:
    """The leaf with the largest gain is split next.

    A scan adds up the children of all leaves that could still be among the splits to come, so there are about as many scans as the
    tree is deep.  What it adds up too many is dropped: a node counts as split only when its turn comes.
    """
    trial = Tree()
    trial.add()
    histograms = {0: scan(trial, [0])[:, 0]}
    best = _best(choice, histograms, [0])
    splits: list[int] = []
    # Lowest node first among equal gains.
    queue = [(-best[0][0], 0)]
    while queue and len(splits) + 1 < choice.growth.leaves:
        minus, node = queue[0]
        if -minus <= 1e-12:
            break
        if trial.left[node] < 0:
            left = choice.growth.leaves - 1 - len(splits)
            open_ = [n for gain, n in heapq.nsmallest(left, queue) if -gain > 1e-12 and trial.left[n] < 0]
            for n in open_:
                trial.split(n, **choice.test(best[n][1]))
            _children(scan, choice, trial, histograms, open_)
            best |= _best(choice, histograms, [child for n in open_ for child in (trial.left[n], trial.right[n])])
        heapq.heappop(queue)
        splits.append(node)
        for child in (trial.left[node], trial.right[node]):
            heapq.heappush(queue, (-best[child][0], child))
    tree, at = Tree(), {0: 0}
    tree.add()
    for node in splits:
        pair = tree.split(at[node], **choice.test(best[node][1]))
        at |= dict(zip((trial.left[node], trial.right[node]), pair))
    kept = {new: histograms[old] for old, new in at.items()}
    _finish(choice, tree, kept, [n for n in kept if tree.left[n] < 0])
    return tree


def symmetric(scan: Scan, choice: Choice) -> Tree:
    """One test per level, the one whose gains over all leaves add up to most."""
    tree = Tree(symmetric=True)
    histogram = scan(tree, [0])
    for depth in range(choice.growth.depth):
        gains = choice.gains(histogram).sum(0)
        place = int(gains.argmax())
        if not gains[place] > 1e-12:
            break
        tree.add(**choice.test(place))
        if depth + 1 < choice.growth.depth:
            right = scan(tree, [n + (1 << depth) for n in range(1 << depth)])
            histogram = np.concatenate((histogram - right, right), axis=1)
        else:
            first, size = choice.first[place], choice.layout.sizes[choice.column[place]]
            right = histogram[:, :, place] if not choice.ordered[place] else histogram[:, :, place + 1 : first + size].sum(2)
            totals = np.concatenate((choice.totals(histogram) - right, right), axis=1)
            tree.value = choice.value(totals).tolist()
            return tree
    tree.value = choice.value(choice.totals(histogram)).tolist()
    return tree


SHAPES = {"levels": by_levels, "leaves": by_leaves, "symmetric": symmetric}


@dataclass
class Grower:
    """Grows the tree of any round by scans; draws depend on seed and round only."""

    layout: Layout
    growth: Growth
    scale: float
    seed: int

    def grow(self, nth: int, scan: Callable[[Request], np.ndarray]) -> Tree:
        random = np.random.Generator(np.random.PCG64((self.seed, nth)))
        choice = Choice(self.layout, self.growth, self.scale)
        choice.draw(random)
        draw = int(random.integers(1 << 63))

        def sums(tree: Tree, nodes: list[int]) -> np.ndarray:
            slots = np.full(1 << len(tree.column) if tree.symmetric else len(tree.column), -1)
            slots[nodes] = np.arange(len(nodes))
            return scan(Request(self.layout.sizes, (), tree, slots, len(nodes), self.scale, draw, self.growth.rows))

        return SHAPES[self.growth.shape](sums, choice)


@dataclass
class Alone:
    """Several rounds inside the task that holds all rows of a table of one partition: no job per scan, the same trees."""

    grower: Grower
    first: int
    last: int

    def __call__(self, blocks: Iterator[Block]) -> Iterator[Tree]:
        held = list(blocks)
        for nth in range(self.first, self.last):
            growing: list[Rows] = []

            def scan(request: Request) -> np.ndarray:
                # What a scan found out about the rows, the next one of this tree goes on from.
                growing.extend(map(request.rows, () if growing else held))  # noqa: B023
                return request.sums(growing)  # noqa: B023

            tree = self.grower.grow(nth, scan)
            yield tree
            if len(tree.value) > 1:
                held = [replace(block, margin=renewed(block, [tree])) for block in held]


@dataclass(frozen=True)
class Prepared:
    """A training table as blocks, its layout with borders, parts, weight of the positives and of all, and the scale of exact sums."""

    table: DataFrame
    layout: Layout
    parts: int
    positive: float
    whole: float

    @property
    def scale(self) -> float:
        # Powers of two below the bound; the slack keeps the last bits of the sum from mattering.
        return 2.0 ** math.floor(52 - math.log2(self.whole * (1 + 1e-9)))


def parts_for(rows: int) -> int:
    """One part, or as many as share the scans of a large table."""
    return 1 if rows < PART_ROWS else max(1 + rows // PART_ROWS, LEAST_PARTS)


def prepared(train: DataFrame, features: str, label: str, weight: str, key: str | None, groups: Sequence[tuple[int, int]], bins: int) -> Prepared | None:
    """None for a table without rows or weight."""
    shared_folder(train.sparkSession)
    first = train.select(vector_to_array(features).alias("x")).first()
    if first is None:
        return None
    bare = layout_of(len(first["x"]), groups)
    table = read_rows(train, features, label, weight, key, bare)
    layout = fit_borders(table, bare, bins)
    parts = parts_for(table.agg(F.sum("n").alias("n")).first()["n"] or 0)
    if parts > 1 and table.rdd.getNumPartitions() < parts:
        table = table.repartition(parts)

    def weights(row) -> tuple[float, float]:
        y, w = (np.frombuffer(row[c], np.float64) for c in ("y", "w"))
        return float(w.sum()), float(w @ y)

    whole, positive = (math.fsum(s) for s in zip(*table.select("y", "w").rdd.map(weights).collect()))
    return Prepared(table, layout, parts, positive, whole) if whole > 0 else None


def boost(
    train: DataFrame,
    growth: Growth,
    features: str = "features",
    label: str = "y",
    weight: str = "w",
    key: str | None = None,
    groups: Sequence[tuple[int, int]] = (),
    seed: int = 42,
) -> tuple[float, list[Tree]]:
    """The starting margin and the trees.

    ``groups`` are ranges of features of which at most one is not zero (one-hot).  Rows are drawn by ``key``; without one, by their
    content, so that equal rows are drawn together.  Rows without weight teach nothing; without any weight, or with one class only, there
    is no tree.
    """
    read = prepared(train, features, label, weight, key, groups, growth.bins)
    if read is None:
        return 0.0, []
    mean = round(read.positive * 2**20 / read.whole) / 2**20 if growth.from_mean else 0.5
    mean = min(max(mean, 2.0**-20), 1 - 2.0**-20)
    start = math.log(mean / (1 - mean))
    if not 0 < read.positive < read.whole or not len(read.layout.sizes):
        return start, []
    table, layout, parts, scale = read.table, read.layout, read.parts, read.scale
    if growth.rows < 1:
        blocks = encode(table.coalesce(parts), layout, start)
    else:
        blocks, parts = merged(table.coalesce(parts), layout, start)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    grower = Grower(layout, growth, scale, seed)
    trees: list[Tree] = []
    done, recent, before = 0, [], None
    while done < growth.rounds:
        if parts == 1:
            last = min(done + TOGETHER, growth.rounds)
            fresh = blocks.mapPartitions(Alone(grower, done, last)).collect()
        else:
            last = done + 1

            def scan(request: Request) -> np.ndarray:
                return summed(blocks, replace(request, trees=tuple(recent)))  # noqa: B023

            fresh = [grower.grow(done, scan)]
        if before:
            # The scans have filled the blocks that were made from these.
            before.unpersist()
            before = None
        kept = [tree for tree in fresh if len(tree.value) > 1]
        if len(kept) < len(fresh) and growth.columns >= 1 and growth.rows >= 1:
            # Nothing left to learn.  (With draws, other columns and rows may come next.)
            trees += kept
            break
        trees, recent, done = trees + kept, recent + kept, last
        if len(recent) >= RENEW and done < growth.rounds:
            renewals = len(trees) // RENEW
            before, blocks, recent = blocks, _renew(blocks, tuple(recent), cut=parts == 1 or renewals % CUT == 0), []
    blocks.unpersist()
    return start, trees


def _renew(blocks: RDD, trees: tuple[Tree, ...], cut: bool) -> RDD:
    """The blocks with the margins after ``trees``, made by the scan that reads them first; ``cut`` writes them to the shared folder."""

    def run(block: Block) -> Block:
        return replace(block, margin=renewed(block, trees))

    fresh = blocks.map(run).persist(StorageLevel.MEMORY_AND_DISK)
    if cut:
        fresh.checkpoint()
    return fresh
