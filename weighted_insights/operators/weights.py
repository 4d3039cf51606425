"""Class totals and balanced training weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_weights(df: DataFrame, label: str = "y", weight: str = "w") -> DataFrame:
    """One row: ``w_neg``, ``w_pos`` and ``pos_factor``, what a positive counts to match the negatives."""

    def total(value: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col(label) == value, F.col(weight))), F.lit(0.0))

    totals = df.agg(total(0).alias("w_neg"), total(1).alias("w_pos"))
    return totals.withColumn("pos_factor", F.col("w_neg") / F.greatest(F.col("w_pos"), F.lit(1e-12)))


def with_balanced_weight(
    df: DataFrame, label: str = "y", weight: str = "w", out: str = "w_balanced", factor: float | None = None
) -> DataFrame:
    """Multiply the weight of positives by the balance factor; negatives keep theirs.

    Without a given factor the plan looks it up by a scalar subquery: one extra
    aggregate, no join.
    """
    if factor is None:
        lookup = class_weights(df, label, weight).select("pos_factor").scalar()
    else:
        lookup = F.lit(float(factor))
    return df.withColumn(out, F.when(F.col(label) == 1, F.col(weight) * lookup).otherwise(F.col(weight)))
