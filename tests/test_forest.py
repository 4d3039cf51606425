"""The random forest against a plain tree, whatever the partitions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_boosting import frame, sample

from weighted_insights.operators import boosting as B
from weighted_insights.operators import forest as R
from weighted_insights.plans.boosted import BoostedTreesModel, RandomForest

GROUPS = [(3, 7)]


def plain_tree(x, y, w, times, depth, min_rows):
    """Shares of positives in the leaves of a tree that tries every split, on rows that count ``times``."""
    out, weight = np.zeros(len(x)), w * times
    tests = [(f, t) for f in range(x.shape[1]) for t in np.unique(x[:, f])[:-1]]

    def purity(rows):
        p, whole = (weight * y)[rows].sum(), weight[rows].sum()
        return (p * p + (whole - p) ** 2) / whole if whole else 0.0

    def grow(rows, left):
        drawn = rows & (times > 0)
        out[rows] = (weight * y)[drawn].sum() / weight[drawn].sum()
        if not left or len(set(y[drawn])) < 2 or drawn.sum() < 2 * min_rows:
            return
        best, at = 1e-9, None
        for i, (f, t) in enumerate(tests):
            right = x[:, f] > t
            if min((drawn & right).sum(), (drawn & ~right).sum()) >= min_rows:
                gain = purity(drawn & right) + purity(drawn & ~right) - purity(drawn)
                if gain > best + 1e-9:
                    best, at = gain, right
        if at is not None:
            grow(rows & ~at, left - 1)
            grow(rows & at, left - 1)

    grow(np.ones(len(x), bool), depth)
    return out


def test_trees_are_those_of_all_splits_tried(spark):
    x, y, w = sample(250, 5)
    rows = frame(spark, x, y, w)
    keys = np.array([r[0] for r in rows.orderBy("id").select(F.xxhash64("id")).collect()]).view(np.uint64)
    trees = R.plant(rows, R.Forest(trees=6, depth=5, features="all"), key="id", groups=GROUPS, seed=9)
    for n, tree in enumerate(trees):
        draw = int(np.random.Generator(np.random.PCG64((9, n))).integers(1 << 63))
        times = R.times_drawn(keys, draw)
        assert np.allclose(tree.score(x.T), plain_tree(x, y, w, times, 5, 5), atol=1e-6), n


@pytest.mark.parametrize("features", ["sqrt", "all"])
def test_partitions_do_not_matter(spark, features, monkeypatch):
    x, y, w = sample(500, 6)
    forest = R.Forest(trees=12, depth=6, features=features, bins=32)
    one = R.plant(frame(spark, x, y, w, 2), forest, key="id", groups=GROUPS)
    monkeypatch.setattr(B, "PART_ROWS", 60)
    monkeypatch.setattr(R, "TOGETHER", 5)
    monkeypatch.setattr(R, "SCAN_BYTES", 20_000)
    two = R.plant(frame(spark, x, y, w, 8), forest, key="id", groups=GROUPS)
    assert one == two and len(one) == 12
    assert len({tuple(t.feature) for t in one}) > 6


def test_draws_are_poisson():
    times = R.times_drawn(np.arange(200_000).astype(np.uint64), 3)
    assert abs(times.mean() - 1) < 0.01 and abs(times.var() - 1) < 0.02 and abs((times == 0).mean() - np.exp(-1)) < 0.005


def test_forest_as_a_stage(spark, tmp_path):
    x, y, w = sample(600, 7)
    rows = frame(spark, x, y, w)
    model = RandomForest(R.Forest(trees=30), row="id", groups=GROUPS).fit(rows)
    p = np.array([r["probability"][1] for r in model.transform(rows).orderBy("id").select("probability").collect()])
    _, trees = model.read_trees()
    assert np.allclose(p, np.mean([t.score(x.T) for t in trees], 0))
    assert p[y == 1].mean() > p[y == 0].mean() + 0.2
    model.write().overwrite().save(str(tmp_path / "forest"))
    again = BoostedTreesModel.load(str(tmp_path / "forest"))
    assert again.transform(rows).select("probability").collect() == model.transform(rows).select("probability").collect()


def test_nothing_to_learn(spark):
    x, y, w = sample(40)
    for rows, share in ((frame(spark, x, y, w).limit(0), 0.5), (frame(spark, x, np.ones(40), w), 1.0), (frame(spark, x, y, np.zeros(40)), 0.5)):
        (tree,) = R.plant(rows)
        assert tree.score(x.T).tolist() == [share] * 40
    constant = R.plant(frame(spark, np.ones((40, 2)), y, w), R.Forest(trees=3))
    assert all(len(t.value) == 1 for t in constant)
