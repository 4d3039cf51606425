"""Weighted k-means, its building blocks and the elbow rule."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from weighted_insights.operators import centres as Z
from weighted_insights.operators import lloyd
from weighted_insights.operators.lloyd import best_per_k, fit_trials
from weighted_insights.plans import clustering as C

# Published weighted inertias of the survey for k = 3..9.
PUBLISHED = [
    6148204184.921318,
    5345945226.915219,
    4911083502.867549,
    4538441774.899248,
    4221824342.068879,
    4029556059.9264407,
    3850307734.110748,
]


def elbow(spark, inertias, first=3):
    return spark.createDataFrame(list(enumerate(inertias, first)), "k int, inertia double")


@pytest.fixture(scope="module")
def line(spark):
    rows = spark.createDataFrame([([0.0], 1.0), ([1.0], 3.0), ([10.0], 1.0), ([11.0], 1.0)], "v array<double>, w double")
    return rows.withColumn("features", array_to_vector("v"))


def test_published_inertias_suggest_eight(spark):
    published = elbow(spark, PUBLISHED)
    assert Z.suggest_k(published).first().suggested_k == 8
    assert Z.suggest_k(published, "max").first().suggested_k == 4
    with pytest.raises(ValueError):
        Z.suggest_k(published, "other")


def test_two_values_of_k_suggest_the_first(spark):
    assert Z.suggest_k(elbow(spark, [5.0, 4.0])).first().suggested_k == 3


def test_weighted_clusters_of_four_points(line):
    fit = C.fit_best(line, 2, restarts=3)
    assert sorted(c[0] for c in fit.model.clusterCenters()) == pytest.approx([0.75, 10.5])
    assert fit.inertia == pytest.approx(1.25)
    trial = best_per_k(fit_trials(line, [2], restarts=3))[2]
    assert sorted(trial.centres[:, 0]) == pytest.approx([0.75, 10.5])
    assert trial.inertia == pytest.approx(1.25)


def test_assignment_update_and_inertia(line):
    assigned = Z.assign(line, "v", [(0, [0.75]), (1, [10.5])])
    assert [r.cluster for r in assigned.orderBy(F.col("v")[0]).collect()] == [0, 0, 1, 1]
    assert Z.inertia(assigned).first().inertia == pytest.approx(1.25)
    means = Z.collect_centres(Z.centre_means(assigned, "v"))
    assert means == [(0, [0.75]), (1, [10.5])]


def test_ties_go_to_the_smaller_cluster(line):
    assigned = Z.assign(line.limit(1), "v", [(3, [1.0]), (2, [-1.0])])
    assert assigned.first().cluster == 2


def test_sweep_is_one_table_and_agrees_with_single_fits(spark):
    random = np.random.default_rng(0)
    points = np.vstack([random.normal(c, 0.2, (60, 3)) for c in ([0, 0, 0], [4, 0, 0], [0, 4, 0], [0, 0, 4])])
    rows = spark.createDataFrame([(p.tolist(), float(i % 3)) for i, p in enumerate(points)], "v array<double>, w double")
    rows = rows.repartition(4).select(array_to_vector("v").alias("features"), "w")
    found = {r.k: r.inertia for r in C.sweep(rows, range(2, 6), restarts=4).collect()}
    assert list(found) == [2, 3, 4, 5]
    assert found[2] > found[3] > found[4] > found[5] > 0
    assert found[4] == pytest.approx(C.fit_best(rows, 4, restarts=4).inertia, rel=1e-6)


def test_fewer_distinct_points_than_clusters(spark):
    rows = spark.createDataFrame([([float(i % 2)], 1.0) for i in range(6)], "v array<double>, w double")
    trial = best_per_k(fit_trials(rows.select(array_to_vector("v").alias("features"), "w"), [3], restarts=1))[3]
    assert len(trial.centres) == 2 and trial.inertia == 0.0


def test_choice_of_k(line):
    swept = C.segment(line, k_min=1, k_max=3, default_k=2, restarts=2)
    assert swept.k == 2 and swept.suggested_k == 2 and swept.elbow.count() == 3
    fixed = C.segment(line, k=3, restarts=1)
    assert fixed.k == 3 and fixed.elbow is None and fixed.suggested_k is None


def test_sweep_does_not_depend_on_partitions(spark):
    rows = spark.range(2000).select(F.array(F.randn(1), F.randn(2)).alias("v"), F.lit(1.0).alias("w"), "id").persist()
    rows = rows.select(array_to_vector("v").alias("features"), "w", "id")
    one, two = ([t.inertia for t in fit_trials(rows.repartition(n), [3, 4], restarts=2, row_id="id")] for n in (2, 5))
    assert one == pytest.approx(two, rel=1e-9)
    assert C.fit_best(rows.repartition(2), 3, restarts=2).inertia == pytest.approx(C.fit_best(rows.repartition(5), 3, restarts=2).inertia, rel=1e-9)


def test_sweep_runs_from_any_folder(tmp_path):
    """In a process of its own whose folder has no package."""
    code = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.ml.functions import array_to_vector
from weighted_insights.operators import lloyd
from weighted_insights.operators.lloyd import fit_trials
from weighted_insights.session import local_session
spark = local_session(2)
rows = spark.createDataFrame([([float(i % 5)], 1.0) for i in range(50)], "v array<double>, w double").select(array_to_vector("v").alias("features"), "w")
print(len(fit_trials(rows, [2], restarts=1)[0].centres))
"""
    repository = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    made = subprocess.run([sys.executable, "-c", code, repository], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert made.stdout.split()[-1:] == ["2"], made.stderr[-2000:]


def vectors(spark, points, parts=3):
    rows = spark.createDataFrame([(i, [float(v) for v in p], 1.0) for i, p in enumerate(points)], "id long, v array<double>, w double")
    return rows.repartition(parts).select("id", array_to_vector("v").alias("features"), "w")


def test_a_centre_without_rows_moves_to_the_farthest_one(spark):
    """Plain iterations from these centres keep the third one empty for good."""
    points = [[0.0], [1.0], [2.0], [20.0], [21.0], [50.0], [50.0]]
    rows = vectors(spark, points)
    prepared = _prepared(rows)
    trial = lloyd.Trial(3, 0, np.array([[1.0], [30.0], [1000.0]]))
    plain = trial.centres.copy()
    for _ in range(10):
        near = ((np.array(points)[:, None, :] - plain) ** 2).sum(2).argmin(1)
        plain = np.array([np.array(points)[near == j].mean(0) if (near == j).any() else plain[j] for j in range(3)])
    assert plain[2] == 1000.0
    for _ in range(10):
        trial.centres = lloyd._moved(prepared, [trial])[0]
    assert sorted(trial.centres.ravel().tolist()) == [1.0, 20.5, 50.0]


def test_several_empty_centres_take_different_rows(spark):
    points = [[0.0]] * 5 + [[7.0]] * 20 + [[9.0]] * 20
    trial = lloyd.Trial(3, 0, np.array([[0.0], [100.0], [200.0]]))
    prepared = _prepared(vectors(spark, points, 5))
    moved = lloyd._moved(prepared, [trial])[0]
    assert sorted(moved[1:].ravel().tolist()) == [7.0, 9.0]


def _prepared(rows):
    return lloyd.read_blocks(rows, "w", "features", "id", 0)


def test_greedy_draws_lower_the_cost(spark):
    """Cost right after seeding: on average lower than that of single draws."""
    random = np.random.default_rng(1)
    points = np.vstack([random.normal(c, 0.3, (40, 2)) for c in random.uniform(-10, 10, (8, 2))])
    prepared = _prepared(vectors(spark, points))

    def seeded(candidates):
        original, lloyd._candidates = lloyd._candidates, candidates
        try:
            trials = [lloyd.Trial(8, a, np.empty((0, 2))) for a in range(12)]
            for step in range(8):
                lloyd._draw_centres(prepared, trials, 3, step)
        finally:
            lloyd._candidates = original
        return np.mean([((points[:, None, :] - t.centres) ** 2).sum(2).min(1).sum() for t in trials])

    assert seeded(lloyd._candidates) < 0.9 * seeded(lambda k, step: 1)


def test_hot_vector_draws_by_row(spark):
    """A vector that a third of the rows hold is drawn with a third of the mass."""
    points = [[0.0, 0.0]] * 500 + [[float(i), 1.0] for i in range(1000)]
    prepared = _prepared(vectors(spark, points, 4))
    trials = [lloyd.Trial(1, a, np.empty((0, 2))) for a in range(300)]
    lloyd._draw_centres(prepared, trials, 1, 0)
    share = np.mean([t.centres[0][1] == 0.0 for t in trials])
    assert 0.22 < share < 0.45


def test_model_has_the_best_centres(spark):
    points = np.random.default_rng(2).normal(size=(300, 3))
    rows = vectors(spark, points)
    best = best_per_k(fit_trials(rows, [4], restarts=3, row_id="id"))[4]
    model = C.as_model(spark, best)
    assert sorted(map(tuple, np.array(model.clusterCenters()).tolist())) == sorted(map(tuple, best.centres.tolist()))
    fit = C.fit_best(rows, 4, restarts=3, row_id="id")
    assert fit.inertia == pytest.approx(best.inertia, rel=1e-9)
    assert fit.model.transform(rows).groupBy("cluster").count().count() == 4


def test_first_of_equally_near_centres():
    """Rows as near to two centres count with the first one; every trial counts each row once."""

    class Held:
        def mapPartitions(self, run):
            self.found = list(run(iter([block])))
            return self

        getNumPartitions = staticmethod(lambda: 1)

        def collect(self):
            return self.found

    x = np.array([[0.0, 1.0], [3.0, 0.0], [1.0, 1.0], [0.0, 5.0]])
    at = [np.flatnonzero(row) for row in x]
    block = lloyd.Block(np.array([1, 1, 2, 1], np.int32), np.concatenate(at).astype(np.int32), x[x != 0], np.array([1.0, 2, 3, 4]), np.arange(4))
    same, apart = np.array([[1.0, 1.0], [1.0, 1.0], [9.0, 9.0]]), np.array([[0.0, 1.0], [0.0, 5.0]])
    found = lloyd._assign_and_sum(Held(), [lloyd.Trial(3, 0, same), lloyd.Trial(2, 0, apart)])
    assert sorted(found) == [0, 3, 4]
    assert found[0][:2] == (10.0, 1 + 2 * 5 + 4 * 17) and np.allclose(found[0][2], [0.9, 2.4])
    assert found[3][:2] == (6.0, 2 * 10 + 3) and found[4][:2] == (4.0, 0.0)
