"""Queries: what jobs read and write besides rows, and the choices that follow from names and parameters."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import quoted
from ..operators.prep import FeatureSpec, clip_step, fit_prep, spec_by_type
from ..operators.profiles import new_columns, type_counts
from ..plans import clustering as C
from ..plans import models as M
from ..sources import writer
from ..sources.reader import read_column_names, read_survey
from ..storage import new_path, settle
from . import views as V
from .evaluation import _one_model, rounded
from .registry import query


@query(
    "typed_columns",
    """
SELECT c_custkey AS custkey, CASE WHEN c_nationkey % 3 <> 0 THEN c_acctbal END AS balance,
       CASE WHEN c_nationkey % 4 <> 0 THEN c_mktsegment END AS segment,
       CASE WHEN c_nationkey % 5 <> 0 THEN 10000000000 + c_custkey END AS code, 'int, double, string, bigint' AS kinds
FROM customer
""",
)
def typed_columns(spark: SparkSession, folder: str) -> DataFrame:
    """A headerless text file with missing tokens, read with a type per column."""
    path = new_path(spark, "customers")
    rows = V.table(spark, folder, "customer")

    def gaps(every: int, column, token: str):
        return F.when(F.col("c_nationkey") % every != 0, column.cast("string")).otherwise(F.lit(token))

    texts = rows.select(
        F.col("c_custkey").cast("string"),
        gaps(3, F.col("c_acctbal"), "NA"),
        gaps(4, F.col("c_mktsegment"), "NA"),
        gaps(5, F.col("c_custkey") + F.lit(10_000_000_000), ""),
    )
    texts.write.csv(path)
    typed = read_survey(spark, path, ["custkey", "balance", "segment", "code"], infer_types=True)
    kinds = ", ".join(kind for _, kind in typed.dtypes)
    return typed.select(F.col("custkey").cast("bigint").alias("custkey"), "balance", "segment", "code", F.lit(kinds).alias("kinds"))


@query(
    "column_names",
    """
SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS BIGINT) AS place, name, 'model_' || replace(name, ' ', '_') AS artifact
FROM (SELECT DISTINCT p_type AS name FROM part)
""",
)
def column_names(spark: SparkSession, folder: str) -> DataFrame:
    """A file of names, one per line, with blanks around them and empty lines between; and their artifact names."""
    path = new_path(spark, "names")
    names = V.table(spark, folder, "part").select("p_type").distinct().orderBy("p_type")
    # One line per kind of part.
    lines = names.select(F.explode(F.array(F.concat(F.lit("  "), "p_type", F.lit(" ")), F.lit(" "))).alias("value"))
    lines.coalesce(1).write.text(path)
    read = read_column_names(spark, path)
    rows = [(i, name, writer.artifact_name("model", name)) for i, name in enumerate(read)]
    return spark.createDataFrame(rows, "place bigint, name string, artifact string")


@query(
    "metrics_round_trip",
    f"WITH {V.TWO_MODELS} SELECT * FROM {_one_model('by value')} UNION ALL SELECT * FROM {_one_model('by user')}",
)
def metrics_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Areas and thresholds of two models, as the job writes them."""
    path = new_path(spark, "metrics")
    made = M.compare(V.two_models(spark, folder))
    writer.write_metrics(made, path)
    return rounded(spark.read.schema("model string, roc_auc_w double, pr_auc_w double, best_thr double").json(path), "roc_auc_w", "pr_auc_w")


@query(
    "run_manifest",
    """
WITH facts AS (SELECT 'orders_run_' || strftime(max(o_orderdate), '%Y%m%d_%H%M%S') AS run_id, count(*) AS n FROM orders)
SELECT run_id, 'logs/' || run_id AS place, CAST(n AS VARCHAR) AS rows, 'other.json' AS metrics_out, true AS started, true AS partitioned
FROM facts
""",
)
def run_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The record of a run that is named by the last order's date, with its arguments, in the run's own folder."""
    facts = V.table(spark, folder, "orders").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last")).first()
    run = writer.run_id("orders", now=facts["last"])
    outputs = new_path(spark, "outputs")
    place = writer.run_folder(outputs, run)
    writer.write_manifest(spark, f"{place}/run", run, {"rows": facts["n"], "metrics_out": "other.json"})
    back = spark.read.parquet(f"{place}/run")
    return back.select(
        "run_id",
        F.lit(place.removeprefix(outputs + "/")).alias("place"),
        F.col("args")["rows"].alias("rows"),
        F.col("args")["metrics_out"].alias("metrics_out"),
        F.col("started").between(F.lit(datetime(2000, 1, 1)), F.current_timestamp()).alias("started"),
        F.input_file_name().contains(f"run_id={run}").alias("partitioned"),
    )


ROLES = (
    ("gains", "skewed", "double", True),
    ("dividends", "unscaled", "double", True),
    ("w", "robust", "double", False),
    ("x", "robust", "double", False),
    ("c1", "categorical", "string", False),
    ("c2", "categorical", "string", False),
    ("flag", "categorical", "boolean", True),
)


@query(
    "column_roles",
    f"""
WITH {V.PROFILE}, flagged AS (SELECT *, y = 1 AS flag FROM profile)
{" UNION ALL ".join(f"SELECT CAST({i} AS BIGINT) AS place, '{c}' AS name, '{role}' AS role, '{kind}' AS kind, CAST({sum(r[2] == kind for r in ROLES)} AS BIGINT) AS of_kind, {str(new).lower()} AS is_new, count({c}) AS n_filled FROM flagged" for i, (c, role, kind, new) in enumerate(ROLES))}
""",
)
def column_roles(spark: SparkSession, folder: str) -> DataFrame:
    """Roles by type and by list (names that the table lacks are skipped), type counts, and which columns are new."""
    before = V.profile(spark, folder).select("row_id", "w", "x", "c1", "c2")
    after = V.profile(spark, folder).select("row_id", "w", "x", "c1", "c2", "gains", "dividends", (F.col("y") == 1).alias("flag"))
    spec = spec_by_type(after, exclude=["row_id"], skewed=["gains", "no such column"], unscaled=["dividends", "nor this"], scaled_first=["nothing"])
    roles = [(name, role) for role in ("skewed", "unscaled", "robust", "categorical") for name in getattr(spec, role)]
    kinds, counts, new = dict(after.dtypes), type_counts(after.drop("row_id")), new_columns(before, after)
    rows = [(i, name, role, kinds[name], counts[kinds[name]], name in new) for i, (name, role) in enumerate(roles)]
    named = spark.createDataFrame(rows, "place bigint, name string, role string, kind string, of_kind bigint, is_new boolean")
    filled = after.agg(F.array([F.count(quoted(name)) for name, _ in roles]).alias("n")).select(F.posexplode("n").alias("at", "n_filled"))
    return named.join(filled, F.col("place") == F.col("at")).drop("at")


@query(
    "feature_order",
    f"""
WITH {V.PROFILE},
fit AS (SELECT quantile_cont(w, 0.25) AS low, quantile_cont(w, 0.5) AS mid, quantile_cont(w, 0.75) AS high,
               quantile_cont(ln(1 + gains), 0.25) AS gl, quantile_cont(ln(1 + gains), 0.5) AS gm, quantile_cont(ln(1 + gains), 0.75) AS gh FROM profile),
numbers AS (
  SELECT sum((ln(1 + gains) - gm) / CASE WHEN gh = gl THEN 1 ELSE gh - gl END) AS gains, sum(dividends) AS dividends,
         sum((w - mid) / CASE WHEN high = low THEN 1 ELSE high - low END) AS w FROM profile, fit),
kinds AS (SELECT c2 AS category, count(*) AS n FROM profile GROUP BY c2)
SELECT CAST(0 AS BIGINT) AS place, 'gains' AS feature, round(gains, 4) AS total FROM numbers
UNION ALL SELECT 1, 'dividends', round(dividends, 4) FROM numbers
UNION ALL SELECT 2, 'w', round(w, 4) FROM numbers
UNION ALL SELECT 2 + row_number() OVER (ORDER BY category), 'c2=' || category, n FROM kinds
""",
)
def feature_order(spark: SparkSession, folder: str) -> DataFrame:
    """Features in the order of the groups, not of the columns; columns without a role are dropped."""
    rows = settle(V.profile(spark, folder).select("c2", "w", "dividends", "gains", "x"), "profile")
    prep = fit_prep(rows, FeatureSpec(categorical=("c2",), robust=("w",), unscaled=("dividends",), skewed=("gains",)))
    total = prep.transform(rows).agg(vector_to_array(Summarizer.sum(F.col("features"))).alias("totals"))
    names = F.array([F.lit(name) for name in prep.feature_names])
    placed = total.select(F.posexplode(F.arrays_zip(names.alias("feature"), F.col("totals").alias("total"))).alias("place", "of"))
    return placed.select(F.col("place").cast("bigint").alias("place"), "of.feature", F.round("of.total", 4).alias("total"))


@query(
    "own_steps",
    f"""
WITH {V.PROFILE},
rooted AS (SELECT row_id, sqrt(greatest(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM profile)), 0)) AS x FROM profile),
fit AS (SELECT quantile_cont(x, 0.25) AS low, quantile_cont(x, 0.5) AS mid, quantile_cont(x, 0.75) AS high FROM rooted)
SELECT row_id, round((x - mid) / CASE WHEN high = low THEN 1 ELSE high - low END, 7) AS x FROM rooted, fit
""",
)
def own_steps(spark: SparkSession, folder: str) -> DataFrame:
    """A preparation with a step of the user's own: the root of the clipped number."""
    rows = settle(V.profile(spark, folder).select("row_id", "x"), "profile")
    spec = FeatureSpec(skewed=("x",), skew_steps=(clip_step, lambda number: f"sqrt({number})"))
    return fit_prep(rows, spec).scaled(rows).withColumn("x", F.round("x", 7))


@query(
    "chosen_models",
    """
SELECT event_type, CAST(0 AS BIGINT) AS place, 'rf' AS key, 'RandomForest' AS model, count(*) AS n FROM events GROUP BY event_type
UNION ALL SELECT event_type, 1, 'sgd', 'SGD Logistic', count(*) FROM events GROUP BY event_type
""",
)
def chosen_models(spark: SparkSession, folder: str) -> DataFrame:
    """Known keys of a list that also names every kind of event: the unknown ones are ignored, the order is kept."""
    kinds = V.table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    named = kinds.select("event_type", "n", F.concat(F.lit("rf, "), "event_type", F.lit(" ,sgd")).alias("keys")).collect()
    rows = [(r["event_type"], i, key, M.MODEL_NAMES[key], r["n"]) for r in named for i, key in enumerate(M.choose(r["keys"]))]
    return spark.createDataFrame(rows, "event_type string, place bigint, key string, model string, n bigint")


@query(
    "probability_fallback",
    """
SELECT c_custkey AS custkey, round(1 / (1 + exp(-c_acctbal / 1000)), 10) AS p, round(1 / (1 + exp(-c_acctbal / 1000)), 10) AS from_score,
       CAST(c_acctbal > 0 AS DOUBLE) AS from_prediction
FROM customer
""",
)
def probability_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """The probability of a scored row from its probability column, else from its raw score, else from its prediction."""
    x = F.col("c_acctbal") / 1000
    p = 1 / (1 + F.exp(-x))
    scored = V.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"),
        array_to_vector(F.array(1 - p, p)).alias("probability"),
        array_to_vector(F.array(-x, x)).alias("rawPrediction"),
        (x > 0).cast("double").alias("prediction"),
    )
    less = scored.drop("probability")
    return scored.select(
        "custkey",
        F.round(M.positive_probability(scored), 10).alias("p"),
        F.round(M.positive_probability(less), 10).alias("from_score"),
        M.positive_probability(less.drop("rawPrediction")).alias("from_prediction"),
    )


@query(
    "fixed_and_default_k",
    """
SELECT 'fixed' AS choice, CAST(3 AS BIGINT) AS k, CAST(0 AS BIGINT) AS n_tried, false AS suggests, count(*) AS n_assigned FROM embeddings
UNION ALL SELECT 'swept', 2, 3, true, count(*) FROM embeddings
""",
)
def fixed_and_default_k(spark: SparkSession, folder: str) -> DataFrame:
    """A given k runs no sweep; without one the sweep suggests, but the default is used."""
    rows = settle(V.vectors(spark, folder).select(array_to_vector("v").alias("features"), "w", "vec_id"), "vectors")
    fixed = C.segment(rows, k=3, restarts=1, row_id="vec_id")
    swept = C.segment(rows, k_min=2, k_max=4, default_k=2, restarts=1, row_id="vec_id")
    made = []
    for name, found in (("fixed", fixed), ("swept", swept)):
        elbow = 0 if found.elbow is None else found.elbow.count()
        assigned = found.model.transform(rows).where(F.col("cluster").between(0, found.k - 1)).agg(F.count("*").alias("n_assigned"))
        made.append(assigned.select(F.lit(name).alias("choice"), F.lit(found.k).cast("bigint").alias("k"), F.lit(elbow).cast("bigint").alias("n_tried"), F.lit(found.suggested_k is not None).alias("suggests"), "n_assigned"))
    return made[0].union(made[1])
