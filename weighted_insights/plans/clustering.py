"""Weighted k-means with restarts, the elbow sweep and the choice of k."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from ..operators.centres import suggest_k
from ..operators.lloyd import Trial, best_per_k, fit_trials

DEFAULT_K = 6
K_MIN, K_MAX = 3, 9
RESTARTS = 10
SEED = 42


@dataclass(frozen=True)
class Fit:
    k: int
    model: KMeansModel
    inertia: float


def as_model(spark: SparkSession, trial: Trial, features: str = "features", seed: int = SEED) -> KMeansModel:
    """A stock model with the trial's centres, which saves, loads and assigns like any other.

    The learner is given the centres as its rows and starts from all of them, so there is nothing left to move.
    """
    places = [(Vectors.dense(c.tolist()),) for c in trial.centres]
    rows = spark.createDataFrame(places, StructType([StructField(features, VectorUDT())])).coalesce(1)
    learner = KMeans(k=max(2, len(places)), seed=seed, initMode="random", maxIter=1, featuresCol=features, predictionCol="cluster")
    return learner.fit(rows)


def fit_best(
    rows: DataFrame,
    k: int,
    weight: str = "w",
    features: str = "features",
    restarts: int = RESTARTS,
    seed: int = SEED,
    max_iter: int = 300,
    tol: float = 1e-4,
    row_id: str | None = None,
) -> Fit:
    """The restart of lowest weighted inertia; all restarts advance in the same scans."""
    best = best_per_k(fit_trials(rows, [k], restarts, weight, features, seed, max_iter, tol, row_id))[k]
    return Fit(k, as_model(rows.sparkSession, best, features, seed), float(best.inertia))


def sweep(
    rows: DataFrame,
    ks: Sequence[int],
    weight: str = "w",
    features: str = "features",
    restarts: int = RESTARTS,
    seed: int = SEED,
    row_id: str | None = None,
) -> DataFrame:
    """``(k, inertia)``: the lowest weighted inertia over the restarts of every k."""
    return _elbow(rows.sparkSession, best_per_k(fit_trials(rows, ks, restarts, weight, features, seed, row_id=row_id)), ks)


def _elbow(spark: SparkSession, best: dict[int, Trial], ks: Sequence[int]) -> DataFrame:
    return spark.createDataFrame([(k, float(best[k].inertia)) for k in ks], "k int, inertia double")


@dataclass(frozen=True)
class Segmentation:
    model: KMeansModel
    k: int
    elbow: DataFrame | None
    suggested_k: int | None


def segment(
    rows: DataFrame,
    k: int = 0,
    k_min: int = K_MIN,
    k_max: int = K_MAX,
    default_k: int = DEFAULT_K,
    weight: str = "w",
    features: str = "features",
    restarts: int = RESTARTS,
    seed: int = SEED,
    rule: str = "min_second_diff",
    row_id: str | None = None,
) -> Segmentation:
    """A positive ``k`` is used as it is; otherwise the sweep runs and suggests, but ``default_k`` is used.

    The sweep's own fit of ``default_k`` is the one that is kept.  Rows are told apart by ``row_id`` in the draws.
    """
    if k > 0:
        return Segmentation(fit_best(rows, k, weight, features, restarts, seed, row_id=row_id).model, k, None, None)
    ks = range(k_min, k_max + 1)
    best = best_per_k(fit_trials(rows, sorted({*ks, default_k}), restarts, weight, features, seed, row_id=row_id))
    elbow = _elbow(rows.sparkSession, best, ks)
    suggested = suggest_k(elbow, rule).first()["suggested_k"]
    return Segmentation(as_model(rows.sparkSession, best[default_k], features, seed), default_k, elbow, suggested)
