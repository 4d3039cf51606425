"""Queries: split, imputation, scaling and encoding."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prep import FeatureSpec, fit_prep
from ..operators.profiles import positive_rate
from ..operators.splits import fit_split, split_sizes
from ..storage import settle
from . import views as V
from .registry import query

SPLIT = V.split_sql(V.PROFILE, "profile")


def marked(spark: SparkSession, folder: str) -> DataFrame:
    # Read several times by the fits: the join behind it runs once.
    rows = settle(V.profile(spark, folder), "profile")
    return fit_split(rows).mark(rows)


@query("split_exact", f"WITH {SPLIT} SELECT row_id, y, split FROM marked")
def split_exact(spark: SparkSession, folder: str) -> DataFrame:
    return marked(spark, folder).select("row_id", "y", "split")


@query("split_sizes", f"WITH {SPLIT} SELECT split, y, count(*) AS n FROM marked GROUP BY split, y")
def sizes(spark: SparkSession, folder: str) -> DataFrame:
    return split_sizes(marked(spark, folder))


@query(
    "positive_rate",
    f"WITH {SPLIT} SELECT split, round(avg(y), 3) AS positive_rate FROM marked GROUP BY split",
)
def rate(spark: SparkSession, folder: str) -> DataFrame:
    return positive_rate(marked(spark, folder), "y", ["split"])


@query(
    "impute_median",
    f"""
WITH {V.PROFILE}
SELECT row_id, round(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM profile)), 8) AS x FROM profile
""",
)
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.profile(spark, folder).select("row_id", "x")
    made = fit_prep(rows, FeatureSpec(unscaled=("x",))).imputed(rows)
    return made.withColumn("x", F.round("x", 8))


@query(
    "impute_mode",
    f"""
WITH {V.PROFILE}
SELECT row_id, coalesce(c1, (SELECT c1 FROM profile WHERE c1 IS NOT NULL GROUP BY c1 ORDER BY count(*) DESC, c1 LIMIT 1))
  AS c1 FROM profile
""",
)
def impute_mode(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.profile(spark, folder).select("row_id", "c1")
    return fit_prep(rows, FeatureSpec(categorical=("c1",)), encode=False).imputed(rows)


@query(
    "scale_robust",
    f"""
WITH {V.PROFILE},
imputed AS (SELECT row_id, coalesce(x, (SELECT quantile_cont(x, 0.5) FROM profile)) AS x FROM profile),
fit AS (SELECT quantile_cont(x, 0.25) AS low, quantile_cont(x, 0.5) AS mid, quantile_cont(x, 0.75) AS high FROM imputed)
SELECT row_id, round((x - mid) / CASE WHEN high = low THEN 1 ELSE high - low END, 8) AS x FROM imputed, fit
""",
)
def scale_robust(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.profile(spark, folder).select("row_id", "x")
    made = fit_prep(rows, FeatureSpec(robust=("x",))).scaled(rows)
    return made.withColumn("x", F.round("x", 8))


@query(
    "scale_standard",
    f"""
WITH {V.PROFILE},
imputed AS (SELECT row_id, coalesce(x, (SELECT quantile_cont(x, 0.5) FROM profile)) AS x FROM profile),
fit AS (SELECT avg(x) AS mid, stddev_pop(x) AS dev FROM imputed)
SELECT row_id, round((x - mid) / CASE WHEN dev = 0 THEN 1 ELSE dev END, 7) AS x FROM imputed, fit
""",
)
def scale_standard(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.profile(spark, folder).select("row_id", "x")
    made = fit_prep(rows, FeatureSpec(standard=("x",))).scaled(rows)
    return made.withColumn("x", F.round("x", 7))


@query(
    "skewed_chain",
    f"""
WITH {V.PROFILE},
logged AS (
  SELECT row_id, ln(1 + greatest(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM profile)), 0)) AS x,
         ln(1 + losses) AS losses
  FROM profile
),
fit AS (
  SELECT quantile_cont(x, 0.25) AS xl, quantile_cont(x, 0.5) AS xm, quantile_cont(x, 0.75) AS xh,
         quantile_cont(losses, 0.25) AS ll, quantile_cont(losses, 0.5) AS lm, quantile_cont(losses, 0.75) AS lh
  FROM logged
)
SELECT row_id, round((x - xm) / CASE WHEN xh = xl THEN 1 ELSE xh - xl END, 6) AS x,
       round((losses - lm) / CASE WHEN lh = ll THEN 1 ELSE lh - ll END, 6) AS losses
FROM logged, fit
""",
)
def skewed_chain(spark: SparkSession, folder: str) -> DataFrame:
    rows = settle(V.profile(spark, folder).select("row_id", "x", "losses"), "profile")
    made = fit_prep(rows, FeatureSpec(skewed=("x", "losses"))).scaled(rows)
    return made.withColumns({"x": F.round("x", 6), "losses": F.round("losses", 6)})


@query(
    "passthrough",
    f"""
WITH {V.PROFILE}
SELECT row_id, coalesce(dividends, 0) AS dividends,
       round(coalesce(x, (SELECT quantile_cont(x, 0.5) FROM profile)), 8) AS x
FROM profile
""",
)
def passthrough(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.profile(spark, folder).select("row_id", "dividends", "x")
    made = fit_prep(rows, FeatureSpec(unscaled=("dividends", "x"))).scaled(rows)
    return made.withColumn("x", F.round("x", 8))


@query(
    "fit_then_apply",
    f"""
WITH {SPLIT},
medians AS (SELECT quantile_cont(x, 0.5) AS m FROM marked WHERE split = 'train'),
imputed AS (SELECT row_id, split, coalesce(x, m) AS x FROM marked, medians),
fit AS (
  SELECT quantile_cont(x, 0.25) AS low, quantile_cont(x, 0.5) AS mid, quantile_cont(x, 0.75) AS high
  FROM imputed WHERE split = 'train'
)
SELECT row_id, round((x - mid) / CASE WHEN high = low THEN 1 ELSE high - low END, 8) AS x
FROM imputed, fit WHERE split = 'valid'
""",
)
def fit_then_apply(spark: SparkSession, folder: str) -> DataFrame:
    rows = marked(spark, folder).select("row_id", "split", "x")
    prep = fit_prep(rows.where("split = 'train'"), FeatureSpec(robust=("x",)))
    made = prep.scaled(rows.where("split = 'valid'").select("row_id", "x"))
    return made.withColumn("x", F.round("x", 8))


@query(
    "one_hot_long",
    f"""
WITH {V.PROFILE},
filled AS (
  SELECT row_id,
         coalesce(c1, (SELECT c1 FROM profile WHERE c1 IS NOT NULL GROUP BY c1 ORDER BY count(*) DESC, c1 LIMIT 1)) AS c1,
         c2, CASE WHEN y = 1 THEN 'true' ELSE 'false' END AS flag
  FROM profile
),
words AS (
  SELECT DISTINCT 'c1' AS attribute, c1 AS category FROM profile WHERE c1 IS NOT NULL
  UNION SELECT DISTINCT 'c2', c2 FROM profile
  UNION SELECT 'flag', 'true'
)
SELECT row_id, attribute || '=' || category AS feature, CAST(1 AS DOUBLE) AS value
FROM filled JOIN words ON category = CASE attribute WHEN 'c1' THEN c1 WHEN 'c2' THEN c2 ELSE flag END
""",
)
def one_hot_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.profile(spark, folder).select("row_id", "c1", "c2", (F.col("y") == 1).alias("flag"))
    prep = fit_prep(rows, FeatureSpec(categorical=("c1", "c2", "flag")))
    names = F.array([F.lit(name) for name in prep.feature_names])
    # Of a row's features only those that are set.
    pairs = F.arrays_zip(names.alias("feature"), vector_to_array("features").alias("value"))
    set_ones = F.filter(pairs, lambda pair: pair["value"] != 0)
    return prep.transform(rows, ["row_id"]).select("row_id", F.inline(set_ones).alias("feature", "value"))
