"""Queries: model training, the two jobs, and round trips through files."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prep import FeatureSpec
from ..operators.profiles import segment_summary
from ..plans import classify, segment
from ..plans.models import MODEL_NAMES
from ..sources import writer
from ..sources.reader import read_survey, with_row_id
from ..storage import new_path, settle
from . import views as V
from .profiling import ATTRIBUTES, coded_profile
from .registry import query

DOCUMENT_SPEC = FeatureSpec(skewed=("n_chars",), categorical=("lang", "source"))
SPLIT = V.split_sql(V.TRAINING, "training")


def supports(models: list[str]) -> str:
    """Facts that hold whatever the fits draw: the validation weight of each class, and areas that are areas."""
    named = " UNION ALL ".join(f"SELECT '{MODEL_NAMES[key]}' AS model" for key in models)
    return f"""
WITH {SPLIT}, models AS ({named})
SELECT model, sum(w) FILTER (WHERE y = 0) AS support_0, sum(w) FILTER (WHERE y = 1) AS support_1, true AS beats_chance
FROM marked, models WHERE split = 'valid' GROUP BY model
"""


def train(models: str):
    """Fit the presets in full on the labelled documents; their supports, and whether they beat chance."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = settle(V.training(spark, folder), "documents")
        made = classify.train_and_evaluate(rows, DOCUMENT_SPEC, models=models)

        def support(name: str):
            return F.max(F.when(F.col("class") == name, F.col("support"))).alias(f"support_{name}")

        held = made.reports.groupBy("model").agg(support("0"), support("1"))
        better = made.metrics.select("model", ((F.col("roc_auc_w") > 0.5) & F.col("pr_auc_w").between(0, 1)).alias("beats_chance"))
        return held.join(better, "model")

    return run


for name, key in (("linear", "sgd"), ("forest", "rf"), ("boosted_xgb", "xgb"), ("boosted_lgbm", "lgbm"), ("boosted_cat", "cat")):
    query(f"train_{name}", supports([key]))(train(key))


@query(
    "classification_job",
    f"""
WITH {SPLIT}, models AS (SELECT 'SGD Logistic' AS model UNION ALL SELECT 'RandomForest'),
report_rows AS (SELECT CAST(y AS VARCHAR) AS class, w FROM marked WHERE split = 'valid'
            UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), w FROM marked WHERE split = 'valid')
SELECT model, class, sum(w) AS support, true AS in_range FROM report_rows, models GROUP BY model, class
""",
)
def classification_job(spark: SparkSession, folder: str) -> DataFrame:
    """Linear model and forest on the labelled documents: supports of the reports, and measures that are shares."""
    rows = settle(V.training(spark, folder), "documents")
    made = classify.train_and_evaluate(rows, DOCUMENT_SPEC, models="sgd,rf")
    shares = [F.coalesce(F.col(c), F.lit(0.0)).between(0, 1) for c in ("precision", "recall", "f1")]
    return made.reports.select("model", "class", "support", (shares[0] & shares[1] & shares[2]).alias("in_range"))


PROFILE_SPEC = FeatureSpec(
    skewed=("gains", "losses"), standard=("x", "dividends"), categorical=("c1", "c2", "yes_no", "industry", "year")
)


@query(
    "segmentation_job",
    f"""
WITH {V.PROFILE}
SELECT CAST(6 AS BIGINT) AS n_segments, CAST(1 AS DOUBLE) AS share, round(sum(w * y) / sum(w), 8) AS pos_rate,
       round(sum(w * coalesce(x, 0)) / sum(w), 5) AS mean_x, round(sum(w * dividends) / sum(w), 8) AS mean_dividends
FROM profile
""",
)
def segmentation_job(spark: SparkSession, folder: str) -> DataFrame:
    """Six clusters of the orders; the profile's weighted means over all of them are those of the whole."""
    rows = settle(coded_profile(spark, folder).drop("segment", "raw_num"), "orders")
    made = segment.cluster_and_profile(rows, PROFILE_SPEC, means=["x", "dividends"], crosstabs=ATTRIBUTES, tops=ATTRIBUTES, k=6)

    def over_all(column: str):
        return F.sum(F.col("weighted_share") * F.col(column))

    return made.summary.agg(
        F.count("*").alias("n_segments"),
        F.round(F.sum("weighted_share"), 8).alias("share"),
        F.round(over_all("weighted_pos_rate"), 8).alias("pos_rate"),
        F.round(over_all("mean_x"), 5).alias("mean_x"),
        F.round(over_all("mean_dividends"), 8).alias("mean_dividends"),
    )


@query(
    "model_round_trip",
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM orders JOIN customer ON o_custkey = c_custkey",
)
def model_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Save the fitted preparation and clustering, load them, and compare all assignments."""
    rows = settle(coded_profile(spark, folder).drop("segment", "raw_num"), "orders")
    made = segment.cluster_and_profile(rows, PROFILE_SPEC, k=6)
    path = new_path(spark, "model")
    made.model.write().save(path)
    again = PipelineModel.load(path).transform(made.assigned)
    different = (F.col("segment") != F.col("cluster")).cast("bigint")
    return again.agg(F.count("*").alias("n_rows"), F.sum(different).alias("n_different"))


@query(
    "csv_round_trip",
    f"""
WITH {V.PROFILE}
SELECT CAST(row_id AS VARCHAR) AS order_id, c1, c2, code_yn, yr, CAST(y AS VARCHAR) AS label FROM profile
""",
)
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Write a headerless file of texts and read it as a survey."""
    names = ["order_id", "c1", "c2", "code_yn", "yr", "label"]
    path = new_path(spark, "csv")
    rows = V.profile(spark, folder).select(F.col("row_id").alias("order_id"), "c1", "c2", "code_yn", "yr", "y")
    rows.write.option("quote", '"').option("escape", '"').csv(path)
    return read_survey(spark, path, names)


@query(
    "row_numbers",
    """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS low, count(*) - 1 AS high, count(*) AS n_distinct FROM orders
""",
)
def row_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Contiguous row numbers of a scan."""
    ids = with_row_id(V.table(spark, folder, "orders").select("o_orderkey"))
    return ids.agg(
        F.count("*").alias("n"),
        F.min("row_id").alias("low"),
        F.max("row_id").alias("high"),
        F.count_distinct("row_id").alias("n_distinct"),
    )


@query(
    "assignments_round_trip",
    f"WITH {V.PROFILE} SELECT row_id, segment AS segment_kmeans_6 FROM profile",
)
def assignments_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "assignments")
    writer.write_assignments(V.profile(spark, folder), path, "row_id", "segment", 6)
    return spark.read.schema("row_id bigint, segment_kmeans_6 bigint").option("header", True).csv(path)


@query(
    "summary_round_trip",
    f"""
WITH {V.PROFILE}
SELECT segment AS cluster, round(sum(w) / sum(sum(w)) OVER (), 10) AS weighted_share,
       round(sum(w * y) / sum(w), 10) AS weighted_pos_rate, round(sum(w * dividends) / sum(w), 10) AS mean_dividends
FROM profile GROUP BY segment
""",
)
def summary_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "summary")
    made = segment_summary(V.profile(spark, folder), "segment", "w", "y", ["dividends"])
    writer.write_summary(made.withColumnRenamed("segment", "cluster"), path)
    fields = "cluster bigint, weighted_share double, weighted_pos_rate double, mean_dividends double"
    return spark.read.schema(fields).json(path)
