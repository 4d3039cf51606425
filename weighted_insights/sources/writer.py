"""Sinks: assignments, summaries, metrics, run manifests, curves."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import quoted
from ..operators.curves import thin_pr, thin_roc


def run_id(name: str = "", now: datetime | None = None) -> str:
    """``[name_]run_YYYYmmdd_HHMMSS``"""
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    return f"{name}_run_{stamp}" if name else f"run_{stamp}"


def run_folder(outputs: str, run: str) -> str:
    return f"{outputs.rstrip('/')}/logs/{run}"


def artifact_name(*parts: str) -> str:
    """Column and model names as part of a path: spaces become underscores."""
    return "_".join(parts).replace(" ", "_")


def write_assignments(df: DataFrame, path: str, row_id: str, segment: str, k: int) -> None:
    """CSV with header ``row_id,segment_kmeans_<k>``, written by all tasks, each a range of row ids.

    Read one after the other by name, the files hold the rows in the order of their ids.
    """
    rows = df.select(quoted(row_id).alias("row_id"), quoted(segment).alias(f"segment_kmeans_{k}"))
    rows.orderBy("row_id").write.mode("overwrite").option("header", True).csv(path)


def write_summary(summary: DataFrame, path: str, digits: int = 10) -> None:
    """JSON records with decimals cut to ``digits``; one row per segment."""
    rounded = [
        F.round(quoted(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else quoted(f.name)
        for f in summary.schema.fields
    ]
    summary.select(rounded).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """JSON records ``{model, roc_auc_w, pr_auc_w, best_thr}`` at full precision; one row per model."""
    kept = metrics.select("model", "roc_auc_w", "pr_auc_w", "best_thr").coalesce(1)
    kept.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_manifest(spark: SparkSession, path: str, run: str, arguments: dict[str, object]) -> None:
    """Append one row naming the run, its time and all arguments."""
    values = {key: str(value) for key, value in arguments.items()}
    row = spark.createDataFrame(
        [(run, datetime.now(), values)], "run_id string, started timestamp, args map<string,string>"
    )
    row.coalesce(1).write.mode("append").partitionBy("run_id").parquet(path)


def write_records(rows: DataFrame, path: str) -> None:
    """JSON records of a small table; missing fields stay as nulls."""
    rows.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_curves(roc: DataFrame, pr: DataFrame, path: str, max_points: int | None = None) -> None:
    """The points behind the ROC and precision-recall plots, partitioned by model; at most ``max_points`` of each curve."""
    keys = [c for c in roc.columns if c == "model"]
    if max_points:
        roc, pr = thin_roc(roc, max_points, keys), thin_pr(pr, max_points, keys)
    for name, points in (("roc", roc), ("pr", pr)):
        writer = points.write.mode("overwrite")
        if "model" in points.columns:
            writer = writer.partitionBy("model")
        writer.parquet(f"{path.rstrip('/')}/{name}")
