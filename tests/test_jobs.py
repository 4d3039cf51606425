"""Both jobs end to end on a small survey file, and the sinks they write."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from weighted_insights import survey
from weighted_insights.operators.prep import FeatureSpec
from weighted_insights.plans import classify, models, segment
from weighted_insights.sources import writer
from weighted_insights.storage import scratch, settle


@pytest.fixture(scope="module")
def survey_file(tmp_path_factory):
    """400 made-up answers; people with more schooling and more weeks earn more often."""
    source = random.Random(7)
    folder = tmp_path_factory.mktemp("survey")
    with open(folder / "answers.csv", "w", newline="") as out:
        lines = csv.writer(out)
        for _ in range(400):
            level = source.randrange(len(survey.EDUCATION_LEVELS))
            weeks = source.choice([0, 0, 26, 52])
            rich = source.random() < (0.05 + 0.5 * (level > 11) + 0.3 * (weeks == 52)) * 0.9
            row = []
            for name in survey.SURVEY_COLUMNS:
                if name == "label":
                    row.append("50000+." if rich else "- 50000.")
                elif name == "weight":
                    row.append(f"{source.uniform(100, 3000):.2f}")
                elif name == "age":
                    row.append(str(source.randrange(0, 91)))
                elif name == "education":
                    row.append(survey.EDUCATION_LEVELS[level])
                elif name == "weeks worked in year":
                    row.append(str(weeks))
                elif name in survey.NUMERIC_COLUMNS:
                    row.append(str(source.choice([0, 0, 0, source.randrange(1, 5000)])))
                elif name in survey.YES_NO_COLUMNS:
                    row.append(str(source.randrange(3)))
                elif name in survey.ZERO_IS_NIU_COLUMNS:
                    row.append(str(source.randrange(6)))
                elif name == survey.YEAR_COLUMN:
                    row.append(source.choice(["94", "95"]))
                else:
                    row.append(source.choice(["one", "two", "three", "NA", "?"]))
            lines.writerow(row)
    (folder / "names").write_text("\n".join(survey.SURVEY_COLUMNS))
    return folder


def test_classification_job(spark, survey_file, tmp_path):
    out = str(tmp_path / "out")
    made = classify.run(
        spark,
        str(survey_file / "answers.csv"),
        str(survey_file / "names"),
        outputs=out,
        models_dir=str(tmp_path / "models"),
        metrics_out=str(tmp_path / "metrics"),
        run_name="demo",
        models="sgd, xgb, unknown",
        rounds={"xgb": 3},
    )
    metrics = spark.read.json(str(tmp_path / "metrics")).collect()
    assert sorted(r.model for r in metrics) == ["SGD Logistic", "XGBoost"]
    assert all(0.6 < r.roc_auc_w <= 1 for r in metrics)
    ranked = [r.pr_auc_w for r in made.metrics.collect()]
    assert ranked == sorted(ranked, reverse=True)
    assert made.pos_factor > 0
    assert sum(r.n for r in made.target_counts.collect()) == 400
    assert made.reports.count() == 10
    assert {r["class"] for r in made.precision_report.collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}

    run = next((tmp_path / "out" / "logs").iterdir())
    assert run.name.startswith("demo_run_")
    manifest = spark.read.parquet(str(run / "run")).first()
    assert manifest.run_id == run.name and manifest.args["models"] == "sgd,xgb"
    assert manifest.args["run_dir"] == str(run) and manifest.args["metrics_out"] == str(tmp_path / "metrics")
    assert spark.read.json(str(run / "reports")).count() == 10
    assert spark.read.json(str(run / "precision_report")).count() == 5
    assert {r.n for r in spark.read.json(str(run / "target_counts")).collect()} == {r.n for r in made.target_counts.collect()}
    facts = {r.name: r.value for r in spark.read.json(str(run / "facts")).collect()}
    assert float(facts["pos_factor"]) == made.pos_factor and int(facts["columns_double"]) > 5
    assert made.roc.count() == spark.read.parquet(str(run / "curves" / "roc")).count()
    roc = spark.read.parquet(str(run / "curves" / "roc"))
    assert roc.where("fpr = 0 AND tpr = 0").select("model").distinct().count() == 2
    assert spark.read.parquet(str(run / "curves" / "pr")).where("threshold IS NULL").count() == 2
    assert PipelineModel.load(str(tmp_path / "models" / "model_SGD_Logistic")).stages


def test_segmentation_job(spark, survey_file, tmp_path):
    made = segment.run(
        spark,
        str(survey_file / "answers.csv"),
        outputs=str(tmp_path / "out"),
        models_dir=str(tmp_path / "models"),
        segments_out=str(tmp_path / "segments"),
        summary_out=str(tmp_path / "summary"),
        k_max=5,
        restarts=1,
        profile_topn=2,
    )
    assert made.k == 6 and made.elbow.count() == 3 and made.suggested_k == 4
    assigned = spark.read.option("header", True).csv(str(tmp_path / "segments"))
    assert assigned.columns == ["row_id", "segment_kmeans_6"] and assigned.count() == 400
    summary = spark.read.json(str(tmp_path / "summary"))
    assert sum(r.weighted_share for r in summary.collect()) == pytest.approx(1.0)
    assert {f"mean_{c}" for c in survey.PROFILE_MEANS} <= set(summary.columns)
    profile = next((tmp_path / "out" / "logs").iterdir()) / "profile"
    crosstabs = spark.read.parquet(str(profile / "crosstabs"))
    assert crosstabs.select("attribute").distinct().count() == 15
    sums = crosstabs.groupBy("segment", "attribute").agg(F.sum("share").alias("s"))
    assert sums.where("s > 1.000001").count() == 0
    top = spark.read.parquet(str(profile / "top_categories"))
    assert top.count() == 35 * made.shares.count()
    assert spark.read.parquet(str(profile / "elbow")).count() == 3
    # the saved model, scaled and encoded, assigns like the fitted one
    again = PipelineModel.load(str(tmp_path / "models" / "seg_kmeans_k6")).transform(made.assigned)
    assert again.where("segment <> cluster").count() == 0
    assert again.first().features.size == made.n_features


def test_same_seed_same_model(spark, folder):
    from weighted_insights.catalog import training, views

    rows = settle(views.training(spark, folder), "documents")
    first, second = (classify.train_and_evaluate(rows, training.DOCUMENT_SPEC, models="sgd").metrics.first() for _ in range(2))
    assert first.roc_auc_w == pytest.approx(second.roc_auc_w, abs=1e-6)
    assert first.best_thr == pytest.approx(second.best_thr, abs=1e-6)


def test_model_choice():
    assert models.choose("rf,none,sgd") == ["rf", "sgd"]
    with pytest.raises(ValueError):
        models.choose("none")
    assert {key: (g.rounds, g.shape) for key, g in models.BOOSTED.items()} == {"xgb": (500, "levels"), "lgbm": (700, "leaves"), "cat": (800, "symmetric")}
    assert models.build("xgb", rounds=4).growth.rounds == 4 and models.build("xgb").growth == models.BOOSTED["xgb"]
    assert models.build("rf").forest == models.FOREST and models.FOREST.trees == 300 and models.build("rf", rounds=7).forest.trees == 7


def test_probability_falls_back_to_score_then_prediction(spark):
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense(-2.0, 2.0), 1.0)], ["rawPrediction", "prediction"])
    assert rows.select(models.positive_probability(rows)).first()[0] == pytest.approx(0.8807970779)
    plain = rows.drop("rawPrediction")
    assert plain.select(models.positive_probability(plain)).first()[0] == 1.0


def test_names():
    from datetime import datetime

    now = datetime(2025, 1, 2, 3, 4, 5)
    assert writer.run_id(now=now) == "run_20250102_030405"
    assert writer.run_id("demo", now) == "demo_run_20250102_030405"
    assert writer.artifact_name("model", "SGD Logistic") == "model_SGD_Logistic"


def test_metrics_are_written_at_full_precision(spark, tmp_path):
    value = 0.8119027726296223
    rows = spark.createDataFrame([("m", value, value, 1.2552651550001518e-212)], "model string, roc_auc_w double, pr_auc_w double, best_thr double")
    writer.write_metrics(rows, str(tmp_path / "m"))
    assert spark.read.schema(rows.schema).json(str(tmp_path / "m")).collect() == rows.collect()


def test_published_models_rank_by_average_precision(spark):
    from weighted_insights.operators.curves import rank_models

    published = [
        ("SGD Logistic", 0.8119027726296223, 0.19632047427093033),
        ("RandomForest", 0.9413615790494544, 0.5948858934552743),
        ("XGBoost", 0.9552521897385458, 0.6901451825983449),
        ("LightGBM", 0.9554582514937102, 0.6971835967871562),
        ("CatBoost", 0.9556935859855031, 0.6882227496476985),
    ]
    rows = spark.createDataFrame(published, "model string, roc_auc_w double, pr_auc_w double")
    assert [r.model for r in rank_models(rows).collect()] == ["LightGBM", "XGBoost", "CatBoost", "RandomForest", "SGD Logistic"]


def test_roles_of_the_survey_columns(spark):
    from weighted_insights.functions.cleaning import clean, label_and_weight
    from weighted_insights.functions.features import derive
    from weighted_insights.operators.prep import segment_spec, spec_by_type

    raw = spark.createDataFrame([], survey.text_schema())
    typed = label_and_weight(derive(clean(raw)))
    spec = spec_by_type(typed, exclude=["y", "w"])
    assert (len(spec.skewed), len(spec.unscaled), len(spec.robust), len(spec.categorical)) == (4, 3, 2, 38)
    assert spec.robust == ("age", "invest_income")
    chosen = segment_spec(label_and_weight(clean(raw)))
    assert (len(chosen.skewed), len(chosen.standard), len(chosen.categorical)) == (3, 4, 29)


def test_settled_tables_live_in_the_shared_folder(spark):
    from weighted_insights.storage import settle, shared_folder

    kept = settle(spark.range(5), "numbers")
    assert kept.inputFiles() and all(shared_folder(spark).split(":")[-1] in f for f in kept.inputFiles())
    assert kept.count() == 5


def test_every_preset_fits_and_beats_chance(spark):
    rows = spark.range(600).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 10 < 4).cast("int").alias("y"),
        F.lit(1.0).alias("w"),
        (F.col("id") % 10 + F.rand(3)).alias("x"),
        (F.col("id") % 3).cast("string").alias("c"),
    )
    made = classify.train_and_evaluate(rows, FeatureSpec(standard=("x",), categorical=("c",)), models="rf,xgb,lgbm,cat", rounds=2)
    assert {r.model for r in made.metrics.collect()} == {"RandomForest", "XGBoost", "LightGBM", "CatBoost"}
    assert all(r.roc_auc_w > 0.9 for r in made.metrics.collect())


def test_settled_tables_go_with_their_block(spark):
    with scratch():
        table = settle(spark.range(3), "gone")
        assert table.count() == 3
        (path,) = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    assert not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
