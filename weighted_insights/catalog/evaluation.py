"""Queries: curves, areas, thresholds and reports of given score columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curves as K
from ..operators.reports import at_threshold, classification_report
from ..plans.models import compare, report_at_precision
from . import views as V
from .registry import query

CURVE = """
points AS (SELECT p, sum(w * y) AS tp, sum(w * (1 - y)) AS fp FROM scored WHERE w <> 0 GROUP BY p),
summed AS (
  SELECT p, tp, fp, sum(tp) OVER down AS cum_tp, sum(fp) OVER down AS cum_fp,
         sum(tp) OVER () AS total_tp, sum(fp) OVER () AS total_fp
  FROM points WINDOW down AS (ORDER BY p DESC)
),
curve AS (
  SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1
  FROM (SELECT *, cum_tp / (cum_tp + cum_fp) AS precision, cum_tp / total_tp AS recall FROM summed)
),
-- thresholds ascending, with the measures one point further up (the closing point above the last)
shifted AS (
  SELECT p, lead(f1, 1, 0.0) OVER up AS f1_up, lead(precision, 1, 1.0) OVER up AS precision_up FROM curve
  WINDOW up AS (ORDER BY p)
)"""

AREAS = """
SELECT round(sum(fp * (cum_tp - tp / 2)) / max(total_tp * total_fp), 8) AS roc_auc_w,
       round(sum(tp * precision) / max(total_tp), 8) AS pr_auc_w
FROM curve"""

REPORT = """
cells AS (
  SELECT sum(w) FILTER (WHERE y = 0 AND p < thr) AS tn, sum(w) FILTER (WHERE y = 0 AND p >= thr) AS fp,
         sum(w) FILTER (WHERE y = 1 AND p < thr) AS fn, sum(w) FILTER (WHERE y = 1 AND p >= thr) AS tp
  FROM scored, chosen
),
rates AS (
  SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1,
         tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS s FROM cells
),
scores AS (SELECT *, 2 * p0 * r0 / (p0 + r0) AS f0, 2 * p1 * r1 / (p1 + r1) AS f1 FROM rates),
report AS (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM scores
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM scores
  UNION ALL SELECT 'accuracy', NULL, NULL, (tn + tp) / s, s FROM scores
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s FROM scores
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / s, (r0 * s0 + r1 * s1) / s, (f0 * s0 + f1 * s1) / s, s
            FROM scores
)"""


def rounded(df: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "curve_points",
    f"""
WITH {V.EVENT_SCORES}, {CURVE}
SELECT p, tp, fp, cum_tp, cum_fp, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1
FROM curve
""",
)
def curve_points(spark: SparkSession, folder: str) -> DataFrame:
    curve = K.score_curve(V.event_scores(spark, folder))
    kept = curve.select("p", "tp", "fp", "cum_tp", "cum_fp", "precision", "recall", "f1")
    return rounded(kept, "precision", "recall", "f1")


@query(
    "roc_points",
    f"""
WITH {V.EVENT_SCORES}, {CURVE},
steps AS (SELECT *, lead(tp) OVER down AS next_tp, lead(fp) OVER down AS next_fp, lag(p) OVER down AS last_p
          FROM curve WINDOW down AS (ORDER BY p DESC))
SELECT round(cum_fp / total_fp, 8) AS fpr, round(cum_tp / total_tp, 8) AS tpr, p AS threshold
FROM steps WHERE NOT coalesce(tp = next_tp AND fp = next_fp AND last_p IS NOT NULL, false)
UNION ALL SELECT 0, 0, 'infinity'::DOUBLE
""",
)
def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(K.roc_points(K.score_curve(V.event_scores(spark, folder))), "fpr", "tpr")


@query(
    "pr_points",
    f"""
WITH {V.EVENT_SCORES}, {CURVE}
SELECT p AS threshold, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1 FROM curve
UNION ALL SELECT NULL, 1.0, 0.0, 0.0
""",
)
def pr_points(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(K.pr_points(K.score_curve(V.event_scores(spark, folder))), "precision", "recall", "f1")


@query("auc_ap", f"WITH {V.CUSTOMER_SCORES}, {CURVE} {AREAS}")
def auc_ap(spark: SparkSession, folder: str) -> DataFrame:
    made = K.evaluate(K.score_curve(V.customer_scores(spark, folder))).select("roc_auc_w", "pr_auc_w")
    return rounded(made, "roc_auc_w", "pr_auc_w")


@query(
    "best_f1_threshold",
    f"""
WITH {V.CUSTOMER_SCORES}, {CURVE}
SELECT (SELECT p FROM shifted ORDER BY f1_up DESC, p LIMIT 1) AS reference,
       (SELECT p FROM curve ORDER BY f1 DESC, p LIMIT 1) AS exact
""",
)
def best_f1_threshold(spark: SparkSession, folder: str) -> DataFrame:
    curve = K.score_curve(V.customer_scores(spark, folder))
    return curve.agg(K.best_f1_measure().alias("reference"), K.best_f1_measure("exact").alias("exact"))


@query(
    "precision_threshold",
    f"""
WITH {V.CUSTOMER_SCORES}, {CURVE}
SELECT (SELECT min(p) FROM shifted WHERE precision_up >= 0.7) AS reference,
       (SELECT min(p) FROM curve WHERE precision >= 0.7) AS exact
""",
)
def precision_threshold(spark: SparkSession, folder: str) -> DataFrame:
    curve = K.score_curve(V.customer_scores(spark, folder))
    return curve.agg(
        K.precision_threshold_measure(0.70).alias("reference"),
        K.precision_threshold_measure(0.70, "exact").alias("exact"),
    )


REPORT_COLUMNS = """
SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support FROM report"""


@query(
    "classification_report",
    f"WITH {V.CUSTOMER_SCORES}, chosen AS (SELECT 0.5::DOUBLE AS thr), {REPORT} {REPORT_COLUMNS}",
)
def report(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.customer_scores(spark, folder).withColumn("yhat", at_threshold(F.col("p"), 0.5))
    return rounded(classification_report(rows), "precision", "recall", "f1")


@query(
    "threshold_report",
    f"""
WITH {V.CUSTOMER_SCORES}, {CURVE}, chosen AS (SELECT min(p) AS thr FROM shifted WHERE precision_up >= 0.7), {REPORT}
SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support,
       (SELECT thr FROM chosen) AS threshold
FROM report
""",
)
def threshold_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(report_at_precision(V.customer_scores(spark, folder), 0.70), "precision", "recall", "f1")


def _one_model(name: str) -> str:
    curve = CURVE.replace("FROM scored WHERE", f"FROM scored WHERE model = '{name}' AND")
    return f"""(WITH {curve}
  SELECT '{name}' AS model, a.*, (SELECT p FROM shifted ORDER BY f1_up DESC, p LIMIT 1) AS best_thr FROM ({AREAS}) a)"""


@query(
    "model_comparison",
    f"WITH {V.TWO_MODELS} SELECT * FROM {_one_model('by value')} UNION ALL SELECT * FROM {_one_model('by user')}",
)
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(compare(V.two_models(spark, folder)), "roc_auc_w", "pr_auc_w")


def _one_roc(name: str) -> str:
    curve = CURVE.replace("FROM scored WHERE", f"FROM scored WHERE model = '{name}' AND")
    return f"""(WITH {curve}
  SELECT '{name}' AS model, cum_fp / total_fp AS fpr, cum_tp / total_tp AS tpr, p AS threshold FROM curve
  UNION ALL SELECT '{name}', 0, 0, 'infinity'::DOUBLE)"""


@query(
    "model_roc_points",
    f"""
WITH {V.TWO_MODELS}
SELECT model, round(fpr, 8) AS fpr, round(tpr, 8) AS tpr, threshold
FROM ({_one_roc('by value')} UNION ALL {_one_roc('by user')})
""",
)
def model_roc_points(spark: SparkSession, folder: str) -> DataFrame:
    """The stacked ROC curves of all models, every point kept."""
    curve = K.score_curve(V.two_models(spark, folder), keys=["model"])
    return rounded(K.roc_points(curve, ["model"], drop_collinear=False), "fpr", "tpr")


@query(
    "zero_weight_rows",
    f"""
WITH {V.EVENT_SCORES}, {CURVE}
SELECT (SELECT count(*) FROM curve) AS n_points, (SELECT round(max(total_tp + total_fp), 6) FROM curve) AS weight,
       (SELECT count(DISTINCT p) FROM scored) AS n_scores, (SELECT count(*) FROM scored WHERE w = 0) AS n_off
""",
)
def zero_weight_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Scores and weight on the curve, next to all scores and the rows of weight zero that it leaves out."""
    rows = V.event_scores(spark, folder)
    curve = K.score_curve(rows).agg(F.count("*").alias("n_points"), F.round(F.max(F.col("total_tp") + F.col("total_fp")), 6).alias("weight"))
    off = F.count(F.when(F.col("w") == 0, 1)).alias("n_off")
    facts = curve.unionByName(rows.agg(F.count_distinct("p").alias("n_scores"), off), allowMissingColumns=True)
    return facts.agg(*[F.max(name).alias(name) for name in facts.columns])


@query(
    "one_class_curve",
    f"""
WITH {V.EVENT_SCORES.replace("CAST(event_type = 'purchase' AS INTEGER)", "1")}, {CURVE}
SELECT CAST(NULL AS DOUBLE) AS fpr, round(cum_tp / total_tp, 8) AS tpr, p AS threshold FROM curve
UNION ALL SELECT 0, 0, 'infinity'::DOUBLE
""",
)
def one_class_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Without negatives the false positive rate is unknown, and the curve ends normally."""
    rows = V.event_scores(spark, folder).withColumn("y", F.lit(1))
    return rounded(K.roc_points(K.score_curve(rows), drop_collinear=False), "tpr")
