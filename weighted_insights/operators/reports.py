"""Weighted classification report of a score at a threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_threshold(score: Column, threshold: Column | float) -> Column:
    """1 at or above the threshold, else 0."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= limit).cast("int")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def classification_report(
    predicted: DataFrame, label: str = "y", predicted_label: str = "yhat", weight: str = "w", keys: Sequence[str] = ()
) -> DataFrame:
    """Rows ``0``, ``1``, ``accuracy``, ``macro avg``, ``weighted avg`` of precision, recall, F1 and support.

    One aggregate over four conditional sums; a zero denominator gives zero.
    ``accuracy`` stands in the ``f1`` column, as in the usual printed report.
    """
    w, y, z = F.col(weight), F.col(label), F.col(predicted_label)

    def cell(actual: int, guess: int) -> Column:
        return F.coalesce(F.sum(F.when((y == actual) & (z == guess), w)), F.lit(0.0))

    cells = predicted.groupBy(*keys).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )
    per_class = cells.select(
        *keys,
        _ratio(F.col("tn"), F.col("tn") + F.col("fn")).alias("p0"),
        _ratio(F.col("tn"), F.col("tn") + F.col("fp")).alias("r0"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("p1"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("r1"),
        (F.col("tn") + F.col("fp")).alias("s0"),
        (F.col("tp") + F.col("fn")).alias("s1"),
        (F.col("tn") + F.col("tp")).alias("right"),
    ).withColumns(
        {
            "f0": _ratio(2 * F.col("p0") * F.col("r0"), F.col("p0") + F.col("r0")),
            "f1": _ratio(2 * F.col("p1") * F.col("r1"), F.col("p1") + F.col("r1")),
            "s": F.col("s0") + F.col("s1"),
        }
    )

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    def macro(a: str, b: str) -> Column:
        return (F.col(a) + F.col(b)) / 2

    def weighted(a: str, b: str) -> Column:
        return _ratio(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), F.col("s"))

    blank = F.lit(None).cast("double")
    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", blank, blank, _ratio(F.col("right"), F.col("s")), F.col("s")),
        row("macro avg", macro("p0", "p1"), macro("r0", "r1"), macro("f0", "f1"), F.col("s")),
        row("weighted avg", weighted("p0", "p1"), weighted("r0", "r1"), weighted("f0", "f1"), F.col("s")),
    )
    return per_class.select(*keys, F.inline(rows))
