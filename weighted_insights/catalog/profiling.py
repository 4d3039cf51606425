"""Queries: weighted profiles of segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import clean
from ..functions.features import add_bands
from ..operators import profiles as P
from ..operators.weights import class_weights, with_balanced_weight
from . import views as V
from .registry import query

ATTRIBUTES = ["c1", "c2", "yes_no", "industry", "year"]


def coded_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile view with its codes recoded to categories."""

    names = {
        "code_yn": ("own business or self employed", "yes_no"),
        "code_niu": ("detailed industry recode", "industry"),
        "yr": ("year", "year"),
    }
    rows = V.profile(spark, folder)
    coded = clean(rows.withColumnsRenamed({c: survey_name for c, (survey_name, _) in names.items()}))
    return coded.withColumnsRenamed({survey_name: out for survey_name, out in names.values()})


CODED = f"""{V.PROFILE},
coded AS (
  SELECT *,
         CASE code_yn WHEN '1' THEN 'Yes' WHEN '2' THEN 'No' ELSE 'NIU' END AS yes_no,
         CASE code_niu WHEN '0' THEN 'NIU' ELSE code_niu END AS industry,
         CASE yr WHEN '94' THEN '1994' WHEN '95' THEN '1995' END AS "year"
  FROM profile
),
long AS (
  SELECT segment, w, 'c1' AS attribute, coalesce(c1, 'NA') AS category FROM coded
  UNION ALL SELECT segment, w, 'c2', coalesce(c2, 'NA') FROM coded
  UNION ALL SELECT segment, w, 'yes_no', coalesce(yes_no, 'NA') FROM coded
  UNION ALL SELECT segment, w, 'industry', coalesce(industry, 'NA') FROM coded
  UNION ALL SELECT segment, w, 'year', coalesce("year", 'NA') FROM coded
),
cells AS (SELECT segment, attribute, category, sum(w) AS w FROM long GROUP BY ALL),
whole AS (SELECT segment, attribute, sum(w) AS w FROM long GROUP BY ALL),
top AS (
  SELECT attribute, category FROM (SELECT attribute, category, sum(w) AS w FROM long GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY attribute ORDER BY w DESC, category) <= 3
)"""

CROSSTAB = """
SELECT whole.segment, whole.attribute, top.category,
       coalesce(cells.w, 0) / CASE WHEN whole.w > 0 THEN whole.w ELSE 1 END AS share
FROM whole JOIN top USING (attribute)
LEFT JOIN cells ON cells.segment = whole.segment AND cells.attribute = whole.attribute
               AND cells.category = top.category"""

TOP3 = """
SELECT segment, attribute, string_agg(printf('%s (%.2f%%)', category, 100 * share), ', ' ORDER BY share DESC, category) AS top
FROM (
  SELECT cells.segment, cells.attribute, category,
         cells.w / CASE WHEN whole.w > 0 THEN whole.w ELSE 1 END AS share
  FROM cells JOIN whole USING (segment, attribute)
  QUALIFY row_number() OVER (PARTITION BY segment, attribute ORDER BY cells.w DESC, category) <= 3
)"""


@query(
    "segment_summary",
    f"""
WITH {V.PROFILE}
SELECT segment,
       sum(w) / sum(sum(w)) OVER () AS weighted_share,
       sum(w * y) / sum(w) AS weighted_pos_rate,
       sum(w * dividends) / sum(w) AS mean_dividends,
       round(sum(w * coalesce(x, 0)) / sum(w), 6) AS mean_x
FROM profile GROUP BY segment ORDER BY weighted_share DESC, segment
""",
)
def summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.profile(spark, folder)
    made = P.segment_summary(rows, "segment", "w", "y", ["dividends", "x"])
    return made.withColumn("mean_x", F.round("mean_x", 6))


@query(
    "segment_shares",
    f"""
WITH {V.PROFILE}
SELECT segment, sum(w) / sum(sum(w)) OVER () AS weighted_share FROM profile GROUP BY segment
""",
)
def shares(spark: SparkSession, folder: str) -> DataFrame:
    return P.segment_shares(V.profile(spark, folder))


@query(
    "numeric_means",
    f"""
WITH {V.PROFILE}
SELECT segment, attribute, round(weighted_mean, 6) AS weighted_mean FROM (
  SELECT segment, 'x' AS attribute, sum(w * coalesce(x, 0)) / sum(w) AS weighted_mean FROM profile GROUP BY segment
  UNION ALL SELECT segment, 'gains', sum(w * gains) / sum(w) FROM profile GROUP BY segment
  UNION ALL SELECT segment, 'losses', sum(w * losses) / sum(w) FROM profile GROUP BY segment
)
""",
)
def means(spark: SparkSession, folder: str) -> DataFrame:
    made = P.numeric_means(V.profile(spark, folder), ["x", "gains", "losses"])
    return made.withColumn("weighted_mean", F.round("weighted_mean", 6))


@query("segment_ids", f"WITH {V.PROFILE} SELECT DISTINCT segment FROM profile ORDER BY segment")
def ids(spark: SparkSession, folder: str) -> DataFrame:
    return P.segment_ids(V.profile(spark, folder))


@query("segment_top3", f"WITH {CODED} {TOP3} WHERE attribute = 'c2' GROUP BY segment, attribute")
def top3(spark: SparkSession, folder: str) -> DataFrame:
    return P.top_per_segment(V.profile(spark, folder), ["c2"])


@query("segment_top3_all", f"WITH {CODED} {TOP3} GROUP BY segment, attribute")
def top3_all(spark: SparkSession, folder: str) -> DataFrame:
    return P.top_per_segment(coded_profile(spark, folder), ATTRIBUTES)


@query("crosstab_long", f"WITH {CODED} {CROSSTAB} WHERE whole.attribute = 'c2'")
def crosstab_long(spark: SparkSession, folder: str) -> DataFrame:
    return P.crosstab(V.profile(spark, folder), ["c2"], top_n=3)


@query("crosstab_all", f"WITH {CODED} {CROSSTAB}")
def crosstab_all(spark: SparkSession, folder: str) -> DataFrame:
    return P.crosstab(coded_profile(spark, folder), ATTRIBUTES, top_n=3)


@query(
    "crosstab_wide",
    f"""
WITH {V.PROFILE}
SELECT segment,
       sum(w) FILTER (WHERE c1 = 'AUTOMOBILE') / sum(w) AS "AUTOMOBILE",
       sum(w) FILTER (WHERE c1 = 'FURNITURE') / sum(w) AS "FURNITURE",
       sum(w) FILTER (WHERE c1 = 'HOUSEHOLD') / sum(w) AS "HOUSEHOLD",
       sum(w) FILTER (WHERE c1 = 'MACHINERY') / sum(w) AS "MACHINERY",
       sum(w) FILTER (WHERE c1 IS NULL) / sum(w) AS "NA"
FROM profile GROUP BY segment
""",
)
def crosstab_wide(spark: SparkSession, folder: str) -> DataFrame:
    return P.crosstab_wide(V.profile(spark, folder), "c1", top_n=6)


@query(
    "category_weights",
    f"WITH {V.PROFILE} SELECT coalesce(c1, 'NA') AS category, sum(w) AS w FROM profile GROUP BY 1",
)
def category_weights(spark: SparkSession, folder: str) -> DataFrame:
    return P.category_weights(V.profile(spark, folder), "c1")


@query(
    "top_categories",
    f"WITH {V.PROFILE} SELECT c2 AS category, sum(w) AS w FROM profile GROUP BY 1 ORDER BY w DESC, category LIMIT 3",
)
def top_categories(spark: SparkSession, folder: str) -> DataFrame:
    return P.top_categories(V.profile(spark, folder), "c2", top_n=3)


@query(
    "class_weights",
    f"""
WITH {V.PROFILE}
SELECT w_neg, w_pos, w_neg / greatest(w_pos, 1e-12) AS pos_factor
FROM (SELECT sum(w) FILTER (WHERE y = 0) AS w_neg, sum(w) FILTER (WHERE y = 1) AS w_pos FROM profile)
""",
)
def weights(spark: SparkSession, folder: str) -> DataFrame:
    return class_weights(V.profile(spark, folder))


@query(
    "balanced_rows",
    f"""
WITH {V.PROFILE}
SELECT row_id, round(CASE WHEN y = 1 THEN w * factor ELSE w END, 6) AS w_balanced
FROM profile, (SELECT sum(w) FILTER (WHERE y = 0) / sum(w) FILTER (WHERE y = 1) AS factor FROM profile)
""",
)
def balanced(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_balanced_weight(V.profile(spark, folder))
    return rows.select("row_id", F.round("w_balanced", 6).alias("w_balanced"))


@query("row_count", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return P.row_and_column_count(V.table(spark, folder, "orders"))


@query("target_counts", f"WITH {V.PROFILE} SELECT y AS value, count(*) AS n FROM profile GROUP BY y ORDER BY n DESC")
def target_counts(spark: SparkSession, folder: str) -> DataFrame:
    return P.value_counts(V.profile(spark, folder), "y")


BAND_SQL = """
CASE WHEN age <= 17 THEN '<18' WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34' WHEN age <= 44 THEN '35-44'
     WHEN age <= 54 THEN '45-54' WHEN age <= 64 THEN '55-64' ELSE '65+' END AS age_band,
CASE WHEN weeks <= 0 THEN '0' WHEN weeks <= 13 THEN '1-13' WHEN weeks <= 26 THEN '14-26' WHEN weeks <= 39 THEN '27-39'
     WHEN weeks <= 47 THEN '40-47' ELSE '48-52+' END AS weeks_band"""


@query(
    "band_profile",
    f"""
WITH {V.BANDS}
SELECT age_band, weeks_band, count(*) AS n, sum(w) AS w FROM (SELECT {BAND_SQL}, w FROM bands) GROUP BY ALL
""",
)
def band_profile(spark: SparkSession, folder: str) -> DataFrame:
    rows = add_bands(V.bands(spark, folder))
    return rows.groupBy("age_band", "weeks_band").agg(F.count("*").alias("n"), F.sum("w").alias("w"))


@query(
    "one_segment",
    f"""
WITH {V.PROFILE}
SELECT c2 AS category, sum(w) AS w, sum(w) / sum(sum(w)) OVER () AS share FROM profile WHERE segment = 2 GROUP BY c2
""",
)
def one_segment(spark: SparkSession, folder: str) -> DataFrame:
    """Categories of a single segment, which is filtered rather than grouped."""
    rows = V.profile(spark, folder).where("segment = 2")
    weights = P.category_weights(rows, "c2")
    return weights.withColumn("share", F.col("w") / weights.select(F.sum("w")).scalar())


QUIET = f"""{V.PROFILE},
quiet AS (
  SELECT CASE WHEN segment <> 5 THEN segment END AS segment, CASE WHEN segment = 4 THEN 0.0::DOUBLE ELSE w END AS w, y, x, c2
  FROM profile
)"""


def quiet_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile view with a missing segment and one without weight."""
    segment = F.col("segment")
    return V.profile(spark, folder).withColumns(
        {"w": F.when(segment == 4, F.lit(0.0)).otherwise(F.col("w")), "segment": F.when(segment != 5, segment)}
    )


@query(
    "segment_without_weight",
    f"""
WITH {QUIET}
SELECT segment, round(sum(w) / (SELECT sum(w) FROM quiet), 8) AS weighted_share,
       round(sum(w * y) / greatest(sum(w), 1e-9), 8) AS weighted_pos_rate,
       round(sum(w * coalesce(x, 0)) / greatest(sum(w), 1e-9), 5) AS mean_x
FROM quiet GROUP BY segment
""",
)
def segment_without_weight(spark: SparkSession, folder: str) -> DataFrame:
    """Rates and means of a segment without weight are guarded; a missing segment is a segment."""
    made = P.segment_summary(quiet_profile(spark, folder), "segment", "w", "y", ["x"])
    return made.withColumns({"weighted_share": F.round("weighted_share", 8), "weighted_pos_rate": F.round("weighted_pos_rate", 8), "mean_x": F.round("mean_x", 5)})


@query(
    "missing_segment_top3",
    f"""
WITH {QUIET},
cells AS (SELECT segment, c2 AS category, sum(w) AS w FROM quiet WHERE segment IS NULL OR segment <> 4 GROUP BY ALL),
shares AS (SELECT *, w / sum(w) OVER (PARTITION BY segment) AS share,
                  row_number() OVER (PARTITION BY segment ORDER BY w DESC, category) AS rank FROM cells)
SELECT segment, 'c2' AS attribute, count(*) AS n, min(category) AS first_name FROM shares WHERE rank <= 3 GROUP BY segment
""",
)
def missing_segment_top3(spark: SparkSession, folder: str) -> DataFrame:
    """The top categories of a missing segment are kept."""
    rows = quiet_profile(spark, folder).where("segment is null or segment <> 4")
    names = F.transform(F.split("top", ", "), lambda text: F.substring_index(text, " (", 1))
    top = P.top_per_segment(rows, ["c2"])
    return top.select("segment", "attribute", F.size(names).cast("long").alias("n"), F.array_min(names).alias("first_name"))
