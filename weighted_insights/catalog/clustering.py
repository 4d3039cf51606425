"""Queries: weighted k-means, its building blocks and the elbow rule."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import centres as Z
from ..operators.profiles import segment_summary
from ..plans import clustering as C
from . import views as V
from .registry import query


def assigned(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector with the nearest of the label means."""
    rows = V.vectors(spark, folder)
    centres = Z.collect_centres(Z.centre_means(rows, "v", None, "label"))
    return Z.assign(rows, "v", centres)


@query(
    "assign_centres",
    f"WITH {V.VECTORS} SELECT vec_id, cluster, round(distance2, 6) AS distance2 FROM assigned",
)
def assign_centres(spark: SparkSession, folder: str) -> DataFrame:
    return assigned(spark, folder).select("vec_id", "cluster", F.round("distance2", 6).alias("distance2"))


@query(
    "update_centres",
    f"""
WITH {V.VECTORS}
SELECT cluster, CAST(pos - 1 AS INTEGER) AS pos, round(sum(w * x) / sum(w), 8) AS value
FROM coords JOIN assigned USING (vec_id) GROUP BY cluster, pos
""",
)
def update_centres(spark: SparkSession, folder: str) -> DataFrame:
    means = Z.centre_means(assigned(spark, folder), "v", "w", "cluster")
    return means.select("cluster", F.posexplode("centre").alias("pos", "value")).withColumn(
        "value", F.round("value", 8)
    )


@query(
    "weighted_inertia",
    f"""
WITH {V.VECTORS}
SELECT round(sum(CAST(1 + vec_id % 3 AS DOUBLE) * distance2), 6) AS inertia FROM assigned
""",
)
def weighted_inertia(spark: SparkSession, folder: str) -> DataFrame:
    return Z.inertia(assigned(spark, folder)).select(F.round("inertia", 6).alias("inertia"))


# Grouping the vectors by label modulo k gives an inertia for every k without any iteration.
GROUPED = f"""{V.VECTORS},
sums AS (
  SELECT k, label % k AS g, pos, sum(w) AS sw, sum(w * x) AS swx, sum(w * x * x) AS swxx
  FROM coords, (SELECT unnest(range(3, 10)) AS k) GROUP BY ALL
),
elbow AS (SELECT CAST(k AS INTEGER) AS k, sum(swxx - swx * swx / sw) AS inertia FROM sums GROUP BY k),
bends AS (
  SELECT k, inertia, lead(inertia) OVER (ORDER BY k) - 2 * inertia + lag(inertia) OVER (ORDER BY k) AS bend FROM elbow
)"""


def grouped_elbow(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted inertia of grouping by label modulo k, k = 3..9.

    The vectors are summed once per label; every k only regroups those sums.
    """
    rows = V.vectors(spark, folder).select("label", "w", array_to_vector("v").alias("v"))
    square = F.aggregate(vector_to_array("v"), F.lit(0.0), lambda s, x: s + x * x)
    per_label = rows.groupBy("label").agg(
        F.sum("w").alias("w"),
        F.sum(F.col("w") * square).alias("squares"),
        Summarizer.mean(F.col("v"), F.col("w")).alias("mean"),
    )
    regrouped = (
        per_label.withColumn("k", F.explode(F.sequence(F.lit(C.K_MIN), F.lit(C.K_MAX))))
        .groupBy("k", (F.col("label") % F.col("k")).alias("g"))
        .agg(
            F.sum("w").alias("w"),
            F.sum("squares").alias("squares"),
            Summarizer.mean(F.col("mean"), F.col("w")).alias("v"),
        )
    )
    return regrouped.groupBy("k").agg(F.sum(F.col("squares") - F.col("w") * square).alias("inertia"))


@query(
    "elbow_points",
    f"WITH {GROUPED} SELECT k, round(inertia, 5) AS inertia, round(bend, 5) AS second_difference FROM bends",
)
def elbow_points(spark: SparkSession, folder: str) -> DataFrame:
    made = Z.second_differences(grouped_elbow(spark, folder))
    return made.withColumns({c: F.round(c, 5) for c in ("inertia", "second_difference")})


@query(
    "elbow_suggest",
    f"WITH {GROUPED} SELECT k AS suggested_k FROM bends WHERE bend IS NOT NULL ORDER BY bend, k LIMIT 1",
)
def elbow_suggest(spark: SparkSession, folder: str) -> DataFrame:
    return Z.suggest_k(grouped_elbow(spark, folder))


@query(
    "elbow_sweep",
    f"""
WITH {GROUPED}
SELECT k, true AS below_grouping, true AS falling, k BETWEEN 4 AND 8 AS has_second_difference FROM elbow
""",
)
def elbow_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """The best of ten restarts for every k: no worse than grouping by label, and falling in k."""
    rows = V.vectors(spark, folder).select(array_to_vector("v").alias("features"), "w", "vec_id")
    swept = Z.second_differences(C.sweep(rows, range(C.K_MIN, C.K_MAX + 1), row_id="vec_id"))
    grouped = grouped_elbow(spark, folder).withColumnRenamed("inertia", "grouped")
    before = F.lag("inertia").over(Window.orderBy("k"))
    # One row per k.
    return swept.join(grouped, "k").select(
        "k",
        (F.col("inertia") <= F.col("grouped")).alias("below_grouping"),
        F.coalesce(F.col("inertia") < before, F.lit(True)).alias("falling"),
        F.col("second_difference").isNotNull().alias("has_second_difference"),
    )


@query(
    "kmeans_profile",
    f"""
WITH {V.VECTORS}, rows AS (SELECT DISTINCT vec_id, label, w FROM coords)
SELECT CAST(10 AS BIGINT) AS n_clusters, CAST(1 AS DOUBLE) AS share,
       round(sum(w * CAST(label < 5 AS INTEGER)) / sum(w), 8) AS pos_rate, round(sum(w * label) / sum(w), 8) AS mean_label
FROM rows
""",
)
def kmeans_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Ten clusters of the embeddings; rates and means over all of them are those of the whole."""
    rows = V.vectors(spark, folder).select(
        array_to_vector("v").alias("features"), "w", "label", (F.col("label") < 5).cast("int").alias("y")
    )
    model = C.fit_best(rows, 10).model
    made = segment_summary(model.transform(rows), "cluster", "w", "y", ["label"])
    share = F.col("weighted_share")
    return made.agg(
        F.count("*").alias("n_clusters"),
        F.round(F.sum(share), 8).alias("share"),
        F.round(F.sum(share * F.col("weighted_pos_rate")), 8).alias("pos_rate"),
        F.round(F.sum(share * F.col("mean_label")), 8).alias("mean_label"),
    )
