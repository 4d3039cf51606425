"""Weighted ROC and precision-recall curves, their areas and threshold rules.

Everything starts from :func:`score_curve`, one row per distinct score.  Scores
are pre-aggregated before any shuffle, so a score shared by a third of the rows
costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .running import range_cuts, running_sums

TINY = 1e-12
NO_THRESHOLD = 0.5


def score_curve(
    scored: DataFrame,
    score: str = "p",
    label: str = "y",
    weight: str = "w",
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """One row per distinct score: the weight at it and the running weight down to it.

    Columns: ``keys``, ``p``, ``tp``, ``fp`` (weight of positives / negatives at this
    score), ``cum_*`` (at this score or above), ``total_*``, ``next_p`` (the next lower
    score), ``next_tp``, ``next_fp``, ``precision``, ``recall``, ``f1``.
    Rows of zero weight leave the curve.
    """
    positive = F.col(weight) * F.col(label)
    negative = F.col(weight) * (1 - F.col(label))
    rows = scored.where(F.col(weight) != 0).select(
        *keys, F.col(score).cast("double").alias("p"), positive.alias("tp"), negative.alias("fp")
    )
    points = rows.groupBy(*keys, "p").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    # Cut where the points are, not the rows: one score may hold nearly all rows.
    cuts = range_cuts(points, "p", buckets)
    curve = running_sums(points, "p", ["tp", "fp"], cuts, keys, descending=True)
    precision = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    # Without any positive weight, recall is one everywhere by convention.
    recall = F.when(F.col("total_tp") > 0, F.col("cum_tp") / F.col("total_tp")).otherwise(F.lit(1.0))
    return curve.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", f1_score(F.col("precision"), F.col("recall"))
    )


def f1_score(precision: Column, recall: Column) -> Column:
    return 2 * precision * recall / (precision + recall + F.lit(TINY))


def roc_points(curve: DataFrame, keys: Sequence[str] = (), drop_collinear: bool = True) -> DataFrame:
    """``(fpr, tpr, threshold)`` from the origin (threshold infinite) to (1, 1).

    The rate of a class without weight is NULL, but at the origin.

    ``drop_collinear`` leaves out points whose step equals the next step; the highest and the
    lowest score always stay.
    """
    kept = curve
    if drop_collinear:
        inner = F.col("next_p").isNotNull() & ~F.col("is_first")
        same_step = (F.col("tp") == F.col("next_tp")) & (F.col("fp") == F.col("next_fp"))
        kept = curve.where(~(inner & same_step))
    # The point with the highest score also carries the origin.
    point = F.struct(
        F.try_divide("cum_fp", "total_fp").alias("fpr"),
        F.try_divide("cum_tp", "total_tp").alias("tpr"),
        F.col("p").alias("threshold"),
    )
    origin = F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    return kept.select(*keys, F.inline(F.when(F.col("is_first"), F.array(origin, point)).otherwise(F.array(point))))


def pr_points(curve: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(threshold, precision, recall, f1)`` plus the closing point without a threshold."""
    point = F.struct(F.col("p").alias("threshold"), "precision", "recall", "f1")
    closing = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(0.0).alias("f1"),
    )
    return curve.select(*keys, F.inline(F.when(F.col("is_first"), F.array(point, closing)).otherwise(F.array(point))))


def _cells(points: DataFrame, at: Column, cells: int, keys: Sequence[str], kept: Sequence[Column]) -> DataFrame:
    """The ``kept`` points (aggregates of whole rows) of every cell of ``at``, each once."""
    row = F.struct(*[c for c in points.columns if c not in keys])
    cell = F.least(F.floor(at * cells), F.lit(cells - 1)).alias("_cell")
    chosen = points.select(*keys, cell, row.alias("_row")).groupBy(*keys, "_cell").agg(F.array_distinct(F.array(*kept)).alias("_rows"))
    return chosen.select(*keys, F.inline("_rows"))


def thin_roc(points: DataFrame, max_points: int, keys: Sequence[str] = ()) -> DataFrame:
    """At most ``max_points`` of each ROC curve; the area under what is left differs by at most ``1 / max_points``.

    Both rates grow along the curve.  Where their sum runs through a cell of width 2 / cells, the first and the last point stay.  Between
    them the curve and its chord lie in a box whose sides add up to that width, so they enclose at most half a square of half
    that width, 1 / (2 cells ** 2); there are ``max_points // 2`` cells.  A rate that is unknown (one class) counts as zero.
    """
    rates = (F.coalesce("fpr", F.lit(0.0)) + F.coalesce("tpr", F.lit(0.0))) / 2
    # Among equal rates the threshold tells the order; it falls along the curve.
    order = F.struct(F.col("_row.tpr") + F.col("_row.fpr"), -F.col("_row.threshold"))
    if max_points < 4:
        raise ValueError("a curve needs 4 points at least")
    return _cells(points, rates, max_points // 2, keys, [F.min_by("_row", order), F.max_by("_row", order)])


def thin_pr(points: DataFrame, max_points: int, keys: Sequence[str] = ()) -> DataFrame:
    """At most ``max_points`` of each precision-recall curve.

    Of every recall cell the first and last points and those of least and largest precision stay, so each cell keeps its range.
    What is lost of the area is at most, summed over the cells, their width (4 / ``max_points``) times that range.
    """
    if max_points < 8:
        raise ValueError("a curve needs 8 points at least")
    recall = F.coalesce("recall", F.lit(0.0))
    order = F.struct(F.col("_row.recall"), -F.coalesce("_row.threshold", F.lit(float("inf"))))
    height = F.struct(F.col("_row.precision"), order)
    chosen = [F.min_by("_row", order), F.max_by("_row", order), F.min_by("_row", height), F.max_by("_row", height)]
    return _cells(points, recall, max_points // 4, keys, chosen)


def auc_measure() -> Column:
    """Area under the ROC curve by trapezoids, as an aggregate over the curve; NULL for one class."""
    area = F.sum(F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2))
    whole = F.max(F.col("total_tp") * F.col("total_fp"))
    return F.when(whole > 0, area / whole)


def average_precision_measure() -> Column:
    """Average precision, a step sum over the curve (no interpolation)."""
    total = F.max("total_tp")
    return F.when(total > 0, F.sum(F.col("tp") * F.col("precision")) / total).otherwise(F.lit(0.0))


def best_f1_measure(align: str = "reference") -> Column:
    """The reported best-F1 threshold, as an aggregate over the curve.

    ``reference`` reports the score one step below the optimum, looked for among
    all scores but the lowest; ``exact`` reports the optimum itself.  Ties go to
    the lower score; without any point the threshold is 0.5.
    """
    if align == "exact":
        return F.coalesce(F.max_by("p", F.struct("f1", -F.col("p"))), F.lit(NO_THRESHOLD))
    _check(align)
    inner = F.col("next_p").isNotNull()
    below = F.max_by(F.when(inner, F.col("next_p")), F.when(inner, F.struct("f1", -F.col("p"))))
    return F.coalesce(below, F.max("p"), F.lit(NO_THRESHOLD))


def precision_threshold_measure(target: float = 0.70, align: str = "reference") -> Column:
    """The highest-recall threshold whose precision meets ``target``, as an aggregate.

    ``reference`` tests the precision one step above the reported score, and the
    closing point (precision 1) stands above the highest score; ``exact`` tests
    the reported score.  If nothing meets the target the best-F1 rule decides.
    """
    meets = F.col("precision") >= F.lit(float(target))
    if align == "exact":
        found = F.min(F.when(meets, F.col("p")))
        return F.coalesce(found, best_f1_measure("exact"))
    _check(align)
    found = F.min(F.when(meets, F.col("next_p")))
    closing = F.max("p") if target <= 1 else F.lit(None).cast("double")
    return F.coalesce(found, closing, best_f1_measure())


def _check(align: str) -> None:
    if align not in ("reference", "exact"):
        raise ValueError(f"align must be 'reference' or 'exact', not {align!r}")


def evaluate(curve: DataFrame, keys: Sequence[str] = (), align: str = "reference") -> DataFrame:
    """One row per key: ``roc_auc_w``, ``pr_auc_w``, ``best_thr``."""
    return curve.groupBy(*keys).agg(
        auc_measure().alias("roc_auc_w"),
        average_precision_measure().alias("pr_auc_w"),
        best_f1_measure(align).alias("best_thr"),
    )


def rank_models(metrics: DataFrame) -> DataFrame:
    """Best average precision first; one row per model."""
    return metrics.orderBy(F.col("pr_auc_w").desc(), "model")
