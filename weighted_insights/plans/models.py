"""Weighted binary classifiers: presets, probabilities, evaluation.

The linear model is MLlib's.  The boosted models grow as published: by levels, by leaves, or symmetric, with leaf penalties
and columns drawn per tree (``operators/boosting.py``); the forest draws its rows by their key (``operators/forest.py``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import sigmoid
from ..operators.boosting import Growth
from ..operators.curves import evaluate, precision_threshold_measure, rank_models, score_curve
from ..operators.forest import Forest
from ..operators.reports import at_threshold, classification_report
from ..storage import shared_folder
from .boosted import BoostedTrees, RandomForest

SEED = 42
# Rows per part of the training frame.
PART_ROWS = 50_000

# Display names and settings of the compared models.
MODEL_NAMES = {"sgd": "SGD Logistic", "rf": "RandomForest", "xgb": "XGBoost", "lgbm": "LightGBM", "cat": "CatBoost"}
LINEAR = {"regParam": 1e-5, "elasticNetParam": 0.0, "maxIter": 25, "tol": 1e-3}
FOREST = Forest(trees=300, depth=12, min_rows=5, features="sqrt")
BOOSTED = {
    "xgb": Growth(rounds=500, shape="levels", rate=0.05, depth=6, penalty=1.0, rows=0.8, columns=0.8, min_curvature=1.0),
    # Its share of rows (0.8) takes effect only with a drawing frequency, which is not set.
    "lgbm": Growth(rounds=700, shape="leaves", rate=0.05, leaves=31, penalty=1.0, columns=0.8, min_curvature=1e-3, min_rows=20),
    "cat": Growth(rounds=800, shape="symmetric", rate=0.05, depth=6, penalty=3.0, from_mean=False),
}
# The preset whose threshold is also chosen for a target precision.
PRECISION_PRESET = "xgb"


@dataclass(frozen=True)
class Columns:
    label: str = "y"
    weight: str = "w"
    train_weight: str = "w_balanced"
    features: str = "features"
    #: Tells rows apart where rows are drawn; without it equal rows are drawn together.
    row: str | None = None


def choose(models: str | list[str]) -> list[str]:
    """Known keys of a comma-separated list, in its order; an error if none is left."""
    keys = models.split(",") if isinstance(models, str) else models
    chosen = [key.strip() for key in keys if key.strip() in MODEL_NAMES]
    if not chosen:
        raise ValueError(f"no known model in {models!r}; known: {', '.join(MODEL_NAMES)}")
    return chosen


def build(
    key: str, columns: Columns = Columns(), seed: int = SEED, rounds: int | None = None, groups: Sequence[tuple[int, int]] = ()
) -> Estimator:
    """The unfitted estimator of a preset.  ``rounds`` replaces the number of trees or rounds; ``groups`` are one-hot ranges."""
    common = {"labelCol": columns.label, "weightCol": columns.train_weight, "featuresCol": columns.features}
    if key == "sgd":
        return LogisticRegression(**common, **LINEAR)
    if key == "rf":
        forest = replace(FOREST, trees=rounds) if rounds else FOREST
        return RandomForest(forest, columns.features, columns.label, columns.train_weight, columns.row, groups, seed)
    growth = replace(BOOSTED[key], rounds=rounds) if rounds else BOOSTED[key]
    return BoostedTrees(growth, columns.features, columns.label, columns.train_weight, columns.row, groups, seed)


def positive_probability(
    scored: DataFrame, probability: str = "probability", raw: str = "rawPrediction", prediction: str = "prediction"
) -> Column:
    """Probability of the positive class, else the squashed score, else the prediction."""
    if probability in scored.columns:
        return vector_to_array(probability)[1]
    if raw in scored.columns:
        return sigmoid(vector_to_array(raw)[1])
    return F.col(prediction).cast("double")


def score(model: Model, rows: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """``(p, y, w)`` with the original weight."""
    scored = model.transform(rows)
    return scored.select(
        positive_probability(scored).alias("p"), F.col(columns.label).alias("y"), F.col(columns.weight).alias("w")
    )


def fit_all(
    train: DataFrame,
    chosen: list[str],
    columns: Columns = Columns(),
    seed: int = SEED,
    rounds: int | Mapping[str, int] | None = None,
    groups: Sequence[tuple[int, int]] = (),
) -> dict[str, Model]:
    """Fit the chosen presets on one cached frame, with no more parts than its rows are worth."""
    shared_folder(train.sparkSession)
    row = [columns.row] if columns.row else []
    held = train.select(columns.label, columns.train_weight, columns.features, *row).persist()
    parts = 1 + held.count() // PART_ROWS
    rows = held.coalesce(parts).persist() if parts < held.rdd.getNumPartitions() else held
    try:
        fitted = {}
        for key in chosen:
            n = rounds.get(key) if isinstance(rounds, Mapping) else rounds
            fitted[key] = build(key, columns, seed, n, groups).fit(rows)
        return fitted
    finally:
        rows.unpersist()
        held.unpersist()


def score_all(models: Mapping[str, Model], valid: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """Long form ``(model, p, y, w)``: one scan, in which every model scores the row."""
    rows, offers = valid.select(columns.label, columns.weight, columns.features), []
    for key, model in models.items():
        named, names = model.copy(), (f"probability_{key}", f"raw_{key}", f"prediction_{key}")
        for setter, name in zip(("setProbabilityCol", "setRawPredictionCol", "setPredictionCol"), names):
            if hasattr(named, setter):
                getattr(named, setter)(name)
        rows = named.transform(rows)
        p = positive_probability(rows, *names)
        offers.append(F.struct(F.lit(MODEL_NAMES[key]).alias("model"), p.alias("p")))
    long = rows.select(
        F.col(columns.label).alias("y"), F.col(columns.weight).alias("w"), F.inline(F.array(offers)).alias("model", "p")
    )
    return long.select("model", "p", "y", "w")


def report_at_best(scored: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Classification report per model, each at its own threshold."""
    limit = F.lit(None).cast("double")
    for model, threshold in thresholds.items():
        limit = F.when(F.col("model") == model, F.lit(float(threshold))).otherwise(limit)
    return classification_report(scored.withColumn("yhat", at_threshold(F.col("p"), limit)), keys=["model"])


def report_at_precision(
    scored: DataFrame, target: float = 0.70, align: str = "reference", curve: DataFrame | None = None
) -> DataFrame:
    """Classification report at the threshold chosen for a target precision, with that threshold."""
    curve = score_curve(scored) if curve is None else curve
    threshold = curve.agg(precision_threshold_measure(target, align).alias("thr")).first()["thr"]
    report = classification_report(scored.withColumn("yhat", at_threshold(F.col("p"), threshold)))
    return report.withColumn("threshold", F.lit(threshold))


def compare(scored: DataFrame, align: str = "reference") -> DataFrame:
    """Areas and threshold per model, best average precision first."""
    return rank_models(evaluate(score_curve(scored, keys=["model"]), ["model"], align))
