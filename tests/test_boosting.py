"""Boosted trees against a plain version, whatever the partitions, and as a saved stage."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from weighted_insights.operators import boosting as B
from weighted_insights.plans.boosted import BoostedTrees, BoostedTreesModel


def sample(n=300, seed=0, groups=True):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 3)).round(2)
    x[:, 2] = draw.integers(0, 4, n)
    kind = draw.integers(0, 5, n)  # 4: none of the group
    hot = np.eye(5)[kind][:, :4]
    chance = 1 / (1 + np.exp(-(x[:, 0] * 2 + x[:, 1] * (kind == 1) * 3 - (x[:, 2] == 2) + (kind == 3))))
    return np.hstack([x, hot]), (draw.random(n) < chance).astype(int), draw.uniform(0.5, 3, n).round(1)


def frame(spark, x, y, w, parts=3):
    rows = [(i, int(b), float(c), Vectors.dense(a.tolist())) for i, (a, b, c) in enumerate(zip(x, y, w))]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    fields = [T.StructField("id", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("w", T.DoubleType()), T.StructField("features", VectorUDT())]
    return spark.createDataFrame(rows, T.StructType(fields)).repartition(parts)


class PlainBooster:
    """Every split of every node tried on the rows themselves, in floating point."""

    def __init__(self, x, y, w, growth):
        self.x, self.g = x, growth
        self.margin = np.full(len(y), math.log((m := (w @ y) / w.sum()) / (1 - m)) if growth.from_mean else 0.0)
        self.tests = [(f, t) for f in range(x.shape[1]) for t in np.unique(x[:, f])[:-1]]
        for _ in range(growth.rounds):
            p = 1 / (1 + np.exp(-self.margin))
            self.a, self.b = (p - y) * w, p * (1 - p) * w
            self.margin = self.margin + {"levels": self.levels, "leaves": self.leaves, "symmetric": self.symmetric}[growth.shape]()

    def worth(self, rows):
        return self.a[rows].sum() ** 2 / (self.b[rows].sum() + self.g.penalty)

    def gain(self, rows, test):
        right = rows & (self.x[:, test[0]] > test[1])
        left = rows & ~right
        if any(s.sum() < self.g.min_rows or self.b[s].sum() < self.g.min_curvature for s in (left, right)):
            return 0.0 if self.g.shape == "symmetric" else -math.inf
        return self.worth(left) + self.worth(right) - self.worth(rows)

    def best(self, rows):
        return max(((self.gain(rows, t), -i) for i, t in enumerate(self.tests)), default=(-math.inf, 0))

    def split(self, rows, test):
        right = rows & (self.x[:, test[0]] > test[1])
        return [rows & ~right, right]

    def step(self, leaves):
        out = np.zeros(len(self.x))
        for rows in leaves:
            if rows.any():
                out[rows] = -self.g.rate * self.a[rows].sum() / (self.b[rows].sum() + self.g.penalty)
        return out

    def levels(self):
        level, done = [np.ones(len(self.x), bool)], []
        for _ in range(self.g.depth):
            following = []
            for rows in level:
                gain, i = self.best(rows)
                if gain > 1e-9:
                    following += self.split(rows, self.tests[-i])
                else:
                    done.append(rows)
            level = following
        return self.step(done + level)

    def leaves(self):
        found = [np.ones(len(self.x), bool)]
        while len(found) < self.g.leaves:
            (gain, i), at = max((self.best(rows), -k) for k, rows in enumerate(found))
            if gain <= 1e-9:
                break
            found[-at : -at + 1] = self.split(found[-at], self.tests[-i])
        return self.step(found)

    def symmetric(self):
        level = [np.ones(len(self.x), bool)]
        for _ in range(self.g.depth):
            gain, i = max((sum(self.gain(rows, t) for rows in level if rows.any()), -i) for i, t in enumerate(self.tests))
            if gain <= 1e-9:
                break
            level = [part for rows in level for part in self.split(rows, self.tests[-i])]
        return self.step(level)


GROWTHS = [
    B.Growth(rounds=4, shape="levels", rate=0.3, depth=4, min_curvature=1.0),
    B.Growth(rounds=4, shape="leaves", rate=0.3, leaves=12, min_rows=5),
    B.Growth(rounds=4, shape="symmetric", rate=0.3, depth=4, penalty=3.0, from_mean=False),
]


def margins(spark, x, y, w, growth, groups, parts=3):
    start, trees = B.boost(frame(spark, x, y, w, parts), growth, key="id", groups=groups)
    return start + sum(tree.score(x.T) for tree in trees), trees


@pytest.mark.parametrize("growth", GROWTHS, ids=lambda g: g.shape)
def test_same_as_all_splits_tried(spark, growth):
    x, y, w = sample()
    found, trees = margins(spark, x, y, w, growth, [(3, 7)])
    assert len(trees) == growth.rounds
    assert np.allclose(found, PlainBooster(x, y, w, growth).margin, atol=1e-5)


def test_leaves_grow_deeper_than_levels(spark):
    x = np.arange(400.0)[:, None] ** 3
    y = (np.floor(np.log2(np.arange(400) + 1)) % 2).astype(int)
    _, trees = margins(spark, x, y, np.ones(400), B.Growth(rounds=1, shape="leaves", leaves=9), [])

    def depth(tree, node=0):
        return 0 if tree.left[node] < 0 else 1 + max(depth(tree, tree.left[node]), depth(tree, tree.right[node]))

    assert sum(c < 0 for c in trees[0].left) == 9 and depth(trees[0]) > 4


def test_symmetric_tree_is_a_list_of_tests(spark):
    x, y, w = sample()
    _, trees = margins(spark, x, y, w, B.Growth(rounds=2, shape="symmetric", depth=3), [(3, 7)])
    assert all(len(t.feature) == 3 and len(t.value) == 8 and not t.left for t in trees)
    bits = sum((x[:, f] > c).astype(int) << d for d, (f, c) in enumerate(zip(trees[0].feature, trees[0].threshold)))
    assert np.allclose(trees[0].score(x.T), np.array(trees[0].value)[bits])


@pytest.mark.parametrize("growth", GROWTHS, ids=lambda g: g.shape)
def test_partitions_do_not_matter(spark, growth, monkeypatch):
    from dataclasses import replace

    monkeypatch.setattr(B, "RENEW", 2)
    monkeypatch.setattr(B, "CUT", 1)
    monkeypatch.setattr(B, "TOGETHER", 3)
    x, y, w = sample(600, 1)
    x[:, 0] = np.random.default_rng(2).normal(size=600)
    growth = replace(growth, rounds=5, rows=0.8, columns=0.6, bins=32)
    one = B.boost(frame(spark, x, y, w, 2), growth, key="id", groups=[(3, 7)])
    monkeypatch.setattr(B, "PART_ROWS", 60)
    two = B.boost(frame(spark, x, y, w, 8), growth, key="id", groups=[(3, 7)])
    assert one == two and len(one[1]) == 5


@pytest.mark.parametrize("growth", GROWTHS, ids=lambda g: g.shape)
def test_equal_rows_are_merged(spark, growth, monkeypatch):
    """Where few rows differ, no scan is a job, however many rows there are; trees are those of the single rows, in one part or in many."""
    x, y, w = sample(500, 6)
    x[:, 0], x[:, 1], w = x[:, 0].round(0), x[:, 1].round(0), np.ceil(w)
    x, y, w = np.tile(x, (6, 1)), np.tile(y, 6), np.tile(w, 6)
    monkeypatch.setattr(B, "PART_ROWS", 1000)
    with monkeypatch.context() as patch:
        patch.setattr(B, "summed", None)
        one = B.boost(frame(spark, x, y, w, 4), growth, key="id", groups=[(3, 7)])
    assert len(one[1]) == growth.rounds
    with monkeypatch.context() as patch:
        patch.setattr(B, "merged", lambda table, layout, start: (B.encode(table, layout, start), 3))
        assert B.boost(frame(spark, x, y, w, 4), growth, key="id", groups=[(3, 7)]) == one
    monkeypatch.setattr(B, "PART_ROWS", 60)
    assert B.boost(frame(spark, x, y, w, 4), growth, key="id", groups=[(3, 7)]) == one


def test_groups_are_the_same_as_their_columns(spark):
    x, y, w = sample(seed=4)
    grouped, plain = (margins(spark, x, y, w, GROWTHS[0], groups)[0] for groups in ([(3, 7)], []))
    assert np.allclose(grouped, plain)


def test_many_partitions_are_summed_in_a_tree(spark, monkeypatch):
    x, y, w = sample()
    want = margins(spark, x, y, w, GROWTHS[0], [])[0]
    monkeypatch.setattr(B, "PART_ROWS", 10)
    assert (margins(spark, x, y, w, GROWTHS[0], [], parts=20)[0] == want).all()


def test_columns_are_drawn_per_tree(spark):
    x, y, w = sample()
    _, trees = margins(spark, x, y, w, B.Growth(rounds=6, columns=0.3), [(3, 7)])
    used = [{f for f in t.feature if f >= 0} for t in trees]
    assert all(len(u) <= 2 for u in used) and len(set().union(*used)) > 2


@pytest.mark.parametrize("bins", [4, 16, 255])
def test_borders(spark, bins):
    draw = np.random.default_rng(3)
    columns = [draw.normal(size=3000), np.where(draw.random(3000) < 0.9, 0.0, draw.exponential(size=3000)), draw.integers(-3, 4, 3000).astype(float), np.full(3000, -0.0), 1e9 + draw.random(3000)]
    x = np.stack(columns, 1)
    layout = B.layout_of(5, [])
    found = []
    for parts in (2, 5):
        table = B.read_rows(frame(spark, x, x[:, 0] > 0, np.ones(3000), parts), "features", "y", "w", "id", layout)
        found.append(B.fit_borders(table, layout, bins))
    assert all((a == b).all() for a, b in zip(found[0].borders, found[1].borders))
    for c, borders in enumerate(found[0].borders):
        code = np.searchsorted(borders, x[:, c], side="left")
        counts = np.bincount(code, minlength=len(borders) + 1)
        largest = max(np.unique(x[:, c], return_counts=True)[1])
        assert len(counts) <= bins + 1 and (counts[:-1] > 0).all() and counts.max() <= 2 * 3000 / bins + largest
    assert len(found[0].borders[2]) == (6 if bins > 7 else 3) and len(found[0].borders[3]) == 0


def test_sortable_numbers():
    x = np.array([-np.inf, -1e300, -2.5, -1e-310, 0.0, 1e-310, 1.0, np.inf])
    keys = B.sortable(x)
    assert (np.diff(keys) > 0).all() and (B.sortable(keys).view(np.float64) == x).all() and B.sortable(np.array([-0.0]))[0] == 0


def test_nothing_to_learn(spark):
    x, y, w = sample(40)
    growth = B.Growth(rounds=3)
    assert B.boost(frame(spark, x, y, w).limit(0), growth) == (0.0, [])
    start, trees = B.boost(frame(spark, x, np.ones(40), w), growth)
    assert trees == [] and start > 10
    assert B.boost(frame(spark, x, y, np.zeros(40)), growth) == (0.0, [])
    constant = B.boost(frame(spark, np.ones((40, 2)), y, w), growth)
    assert constant[1] == [] and constant[0] == pytest.approx(math.log((w @ y) / (w @ (1 - y))), abs=1e-4)


def test_rows_without_weight_teach_nothing(spark):
    x, y, w = sample(200)
    extra = np.vstack([x, x[:50]]), np.append(y, 1 - y[:50]), np.append(w, np.zeros(50))
    assert np.allclose(margins(spark, *extra, GROWTHS[0], [(3, 7)])[0][:200], margins(spark, x, y, w, GROWTHS[0], [(3, 7)])[0], atol=1e-6)


def test_saved_stage(spark, tmp_path):
    x, y, w = sample()
    rows = frame(spark, x, y, w)
    for growth in GROWTHS:
        model = BoostedTrees(growth, row="id", groups=[(3, 7)]).fit(rows)
        path = str(tmp_path / growth.shape)
        PipelineModel([model]).write().overwrite().save(path)
        again = PipelineModel.load(path)
        assert isinstance(again.stages[0], BoostedTreesModel)
        first, second = (m.transform(rows).orderBy("id").select("probability", "rawPrediction", "prediction").collect() for m in (model, again))
        assert first == second
        start, trees = model.read_trees()
        margin = start + sum(tree.score(x.T) for tree in trees)
        assert np.allclose([r["rawPrediction"][1] for r in first], margin) and np.allclose([r["probability"][1] for r in first], 1 / (1 + np.exp(-margin)))
        assert [r["prediction"] for r in first] == (margin > 0).astype(float).tolist()
    assert model.transform(rows.limit(0)).count() == 0
    named = model.copy().setProbabilityCol("p")
    assert {"p"} <= set(named.transform(rows).columns) and model.getProbabilityCol() == "probability"


def test_rows_are_drawn_by_key(spark):
    keys = np.arange(100_000).astype(np.uint64)
    drawn = [B.mix(keys ^ B.mix(np.array([d], np.uint64))) >> np.uint64(11) < np.uint64(int(0.8 * 2**53)) for d in (1, 2)]
    assert all(abs(d.mean() - 0.8) < 0.01 for d in drawn) and abs((drawn[0] & drawn[1]).mean() - 0.64) < 0.01


def test_unknown_shape():
    with pytest.raises(ValueError):
        B.Growth(rounds=1, shape="round")


@pytest.mark.parametrize("growth", GROWTHS, ids=lambda g: g.shape)
def test_rows_go_on_from_the_last_scan(growth):
    """Inside a task rows take each test of a growing tree once; every scan from the root gives the same trees."""
    draw = np.random.default_rng(3)
    layout = B.Layout((0,), ((1, 5),), (np.arange(1.0, 12.0),))
    codes = np.array([draw.integers(0, 12, 900), draw.integers(0, 5, 900)]).astype(np.uint8)
    y = (draw.random(900) < 0.2 + 0.6 * ((codes[0] > 5) ^ (codes[1] == 2))).astype(float)
    cuts = ((0, 400), (400, 900))
    blocks = [B.Block(codes[:, a:b], y[a:b], np.ones(b - a), np.arange(a, b, dtype=np.uint64), np.zeros(b - a)) for a, b in cuts]
    grower, asked, tests = B.Grower(layout, growth, 2.0**30, 7), [], []
    want = grower.grow(0, lambda request: asked.append(request) or next(request(iter(blocks))))
    plain = B.Tree.leaves
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(B.Tree, "leaves", lambda tree, codes, leaf=None, done=0: tests.append(done) or plain(tree, codes, leaf, done))
        assert next(B.Alone(grower, 0, 1)(iter(blocks))) == want
    assert len(asked) > 2 and len(tests) == 2 * len(asked) and max(tests) > 0


def test_one_merged_value_reaches_the_driver(spark):
    from weighted_insights.operators.merging import reduced

    for parts in (1, 5, 40):
        values = spark.sparkContext.parallelize(range(parts), parts)
        assert reduced(values, lambda a, b: a + b) == parts * (parts - 1) // 2
