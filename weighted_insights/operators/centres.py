"""Weighted k-means building blocks: distances, assignment, centre update, inertia, elbow."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_centre(vector: Column, centres: Sequence[tuple[int, Sequence[float]]]) -> Column:
    """``cluster`` and ``distance2`` of the nearest of k fixed centres, a batch of rows at a time."""
    ordered = sorted(centres)
    numbers = np.array([c for c, _ in ordered], np.int32)
    places = np.array([list(map(float, place)) for _, place in ordered])

    @F.pandas_udf("cluster int, distance2 double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        x = np.stack(vectors.to_numpy()) if len(vectors) else np.empty((0, places.shape[1]))
        squared = np.stack([((x - place) ** 2).sum(1) for place in places], axis=1)
        best = squared.argmin(1)
        return pd.DataFrame({"cluster": numbers[best], "distance2": squared[np.arange(len(x)), best]})

    return nearest(vector)


def assign(df: DataFrame, vector: str, centres: Sequence[tuple[int, Sequence[float]]]) -> DataFrame:
    """Add ``cluster`` and ``distance2`` of the nearest centre; ties go to the smaller cluster."""
    return df.withColumn("_nearest", nearest_centre(F.col(vector), centres)).select(
        *df.columns, F.col("_nearest.cluster").alias("cluster"), F.col("_nearest.distance2").alias("distance2")
    )


def centre_means(df: DataFrame, vector: str, weight: str | None = "w", cluster: str = "cluster") -> DataFrame:
    """Weighted mean vector per cluster (one Lloyd update): ``(cluster, w, centre)``.

    Partial sums are made on the map side; one vector per task and cluster is shuffled.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(F.col(cluster).alias("cluster"), w.alias("w"), array_to_vector(F.col(vector)).alias("_v"))
    means = rows.groupBy("cluster").agg(F.sum("w").alias("w"), Summarizer.mean(F.col("_v"), F.col("w")).alias("_m"))
    return means.select("cluster", "w", vector_to_array("_m").alias("centre"))


def collect_centres(means: DataFrame) -> list[tuple[int, list[float]]]:
    """The centres on the driver: k vectors."""
    return sorted((r["cluster"], list(r["centre"])) for r in means.collect())


def inertia(assigned: DataFrame, weight: str = "w") -> DataFrame:
    """Weighted sum of squared distances to the own centre."""
    return assigned.agg(F.sum(F.col(weight) * F.col("distance2")).alias("inertia"))


def second_differences(elbow: DataFrame) -> DataFrame:
    """``(k, inertia, second_difference)`` for the inner values of k; one row per k tried."""
    by_k = Window.orderBy("k")
    bend = F.lead("inertia").over(by_k) - 2 * F.col("inertia") + F.lag("inertia").over(by_k)
    return elbow.withColumn("second_difference", bend)


def suggest_k(elbow: DataFrame, rule: str = "min_second_diff") -> DataFrame:
    """One row ``suggested_k``: the smallest (``max``: largest) second difference, ties to the smaller k.

    With fewer than three values of k, the first one.
    """
    if rule not in ("min_second_diff", "max"):
        raise ValueError(f"rule must be 'min_second_diff' or 'max', not {rule!r}")
    bend = F.col("second_difference") if rule == "min_second_diff" else -F.col("second_difference")
    pick = F.min_by(F.when(bend.isNotNull(), F.col("k")), F.when(bend.isNotNull(), F.struct(bend, "k")))
    return second_differences(elbow).agg(F.coalesce(pick, F.min("k")).alias("suggested_k"))
