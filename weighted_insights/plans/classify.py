"""The classification job: read, clean, split, prepare, train, evaluate, rank, persist."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import clean, label_and_weight
from ..functions.features import derive
from ..operators.curves import evaluate, pr_points, rank_models, roc_points, score_curve
from ..operators.prep import FeatureSpec, fit_prep, spec_by_type
from ..operators.profiles import new_columns, type_counts, value_counts
from ..operators.splits import fit_split
from ..operators.weights import class_weights, with_balanced_weight
from ..sources import writer
from ..sources.reader import read_column_names, read_survey, with_row_id
from ..storage import scratch, settle
from . import models as M


@dataclass(frozen=True)
class Evaluation:
    """What the classification job found."""

    target_counts: DataFrame
    metrics: DataFrame
    reports: DataFrame
    precision_report: DataFrame | None
    roc: DataFrame
    pr: DataFrame
    pos_factor: float
    models: dict[str, PipelineModel]


def train_and_evaluate(
    rows: DataFrame,
    spec: FeatureSpec,
    row_id: str = "row_id",
    label: str = "y",
    weight: str = "w",
    models: str = "sgd,rf,xgb,lgbm,cat",
    test_size: float = 0.2,
    seed: int = 42,
    target_precision: float = 0.70,
    rounds: int | dict[str, int] | None = None,
    align: str = "reference",
) -> Evaluation:
    """Train on balanced weights, evaluate on the original ones.  ``rows`` is read several times."""
    chosen = M.choose(models)
    columns = M.Columns(label=label, weight=weight, row=row_id)
    marked = fit_split(rows, row_id, label, test_size, seed).mark(rows)
    train, valid = marked.where("split = 'train'"), marked.where("split = 'valid'")
    prep = fit_prep(train, spec, columns.features)
    pipeline = prep.pipeline(rows)
    factor = class_weights(train, label, weight).first()["pos_factor"]
    train_vectors = pipeline.transform(with_balanced_weight(train, label, weight, columns.train_weight, factor))
    fitted = M.fit_all(train_vectors, chosen, columns, seed, rounds, prep.groups)

    valid_vectors = pipeline.transform(valid)
    # Scored once, read by the curves, the reports and the threshold search.
    scored = settle(M.score_all(fitted, valid_vectors, columns), "scored")
    curve = settle(score_curve(scored, keys=["model"]), "curve")
    # One row per model.
    found = evaluate(curve, ["model"], align)
    metrics = rows.sparkSession.createDataFrame(found.collect(), found.schema)
    thresholds = {r["model"]: r["best_thr"] for r in metrics.collect()}
    preset = F.col("model") == M.MODEL_NAMES[M.PRECISION_PRESET]
    return Evaluation(
        target_counts=value_counts(rows, label),
        metrics=rank_models(metrics),
        reports=M.report_at_best(scored, thresholds),
        precision_report=M.report_at_precision(scored.where(preset), target_precision, align, curve.where(preset))
        if M.PRECISION_PRESET in chosen
        else None,
        roc=roc_points(curve, ["model"]),
        pr=pr_points(curve, ["model"]),
        pos_factor=factor,
        models={key: PipelineModel([*pipeline.stages, model]) for key, model in fitted.items()},
    )


def run(
    spark: SparkSession,
    data_path: str,
    columns_path: str | None = None,
    outputs: str = "outputs",
    models_dir: str | None = None,
    metrics_out: str = "",
    run_name: str = "",
    models: str = "sgd,rf,xgb,lgbm,cat",
    test_size: float = 0.2,
    seed: int = 42,
    target_precision: float = 0.70,
    rounds: int | dict[str, int] | None = None,
    max_points: int | None = None,
) -> Evaluation:
    """The whole job on a survey file.  Models are saved where ``models_dir`` is given.

    With ``max_points`` the curves that are written are thinned; areas and thresholds come from all points.
    """
    arguments = {k: v for k, v in locals().items() if k != "spark"}
    run_id = writer.run_id(run_name)
    folder = writer.run_folder(outputs, run_id)
    metrics_path = metrics_out or f"{folder}/metrics"
    arguments |= {"models": ",".join(M.choose(models)), "run_dir": folder, "metrics_out": metrics_path}
    writer.write_manifest(spark, f"{folder}/run", run_id, arguments)

    names = read_column_names(spark, columns_path) if columns_path else None
    with scratch():
        raw = with_row_id(read_survey(spark, data_path, names))
        cleaned = clean(raw)
        # One parse of the text; every later pass reads only the columns it needs.
        rows = settle(label_and_weight(derive(cleaned)), "classify-rows")
        result = train_and_evaluate(
            rows,
            spec_by_type(rows, exclude=["row_id", "y", "w"]),
            models=models,
            test_size=test_size,
            seed=seed,
            target_precision=target_precision,
            rounds=rounds,
        )
        writer.write_metrics(result.metrics, metrics_path)
        writer.write_curves(result.roc, result.pr, f"{folder}/curves", max_points)
        small = {"reports": result.reports, "target_counts": result.target_counts}
        if result.precision_report is not None:
            small["precision_report"] = result.precision_report
        facts = [("pos_factor", str(result.pos_factor)), ("derived_columns", ", ".join(new_columns(cleaned, rows)))]
        facts += [(f"columns_{kind}", str(n)) for kind, n in type_counts(rows).items()]
        small["facts"] = spark.createDataFrame(facts, "name string, value string")
        for name, table in small.items():
            writer.write_records(table, f"{folder}/{name}")
        if models_dir:
            for key, pipeline in result.models.items():
                name = writer.artifact_name("model", M.MODEL_NAMES[key])
                pipeline.write().overwrite().save(f"{models_dir.rstrip('/')}/{name}")

    def again(table: DataFrame, name: str) -> DataFrame:
        return spark.read.schema(table.schema).json(f"{folder}/{name}")

    # The tables behind the result are gone; it reads what was written.
    return replace(
        result,
        target_counts=again(result.target_counts, "target_counts").orderBy(F.col("n").desc(), "value"),
        metrics=rank_models(spark.read.schema(result.metrics.schema).json(metrics_path)),
        reports=again(result.reports, "reports"),
        precision_report=None if result.precision_report is None else again(result.precision_report, "precision_report"),
        roc=spark.read.schema(result.roc.schema).parquet(f"{folder}/curves/roc"),
        pr=spark.read.schema(result.pr.schema).parquet(f"{folder}/curves/pr"),
    )
