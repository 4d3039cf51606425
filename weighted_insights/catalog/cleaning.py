"""Queries: typing, recoding and derived features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import features as X
from . import views as V
from .registry import query


@query(
    "clean_codes",
    f"""
WITH {V.PROFILE}
SELECT row_id,
       CASE code_yn WHEN '1' THEN 'Yes' WHEN '2' THEN 'No' ELSE 'NIU' END AS business,
       CASE code_niu WHEN '0' THEN 'NIU' ELSE code_niu END AS industry,
       CASE yr WHEN '94' THEN '1994' WHEN '95' THEN '1995' END AS survey_year
FROM profile
""",
)
def clean_codes(spark: SparkSession, folder: str) -> DataFrame:
    raw = V.profile(spark, folder).select(
        "row_id",
        F.col("code_yn").alias("own business or self employed"),
        F.col("code_niu").alias("detailed industry recode"),
        F.col("yr").alias("year"),
    )
    return C.clean(raw).toDF("row_id", "business", "industry", "survey_year")


@query(
    "clean_numeric",
    f"WITH {V.PROFILE} SELECT row_id, try_cast(trim(raw_num) AS DOUBLE) AS amount FROM profile",
)
def clean_numeric(spark: SparkSession, folder: str) -> DataFrame:
    raw = V.profile(spark, folder).select("row_id", F.col("raw_num").alias("wage per hour"))
    return C.clean(raw).toDF("row_id", "amount")


@query(
    "clean_label",
    f"WITH {V.PROFILE} SELECT row_id, y, coalesce(try_cast(raw_num AS DOUBLE), 0) AS w FROM profile",
)
def clean_label(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("y") == 1, F.lit("50000+.")).otherwise(F.lit("- 50000."))
    raw = V.profile(spark, folder).select("row_id", label.alias("label"), F.col("raw_num").alias("weight"))
    return C.label_and_weight(raw)


@query(
    "missing_tokens",
    f"""
WITH {V.PROFILE},
raw AS (
  SELECT CASE row_id % 7 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN ' NA' WHEN 3 THEN '?' WHEN 4 THEN 'n/a'
                         WHEN 5 THEN '-1.#IND' ELSE c2 END AS t FROM profile
)
SELECT value, count(*) AS n
FROM (SELECT CASE WHEN t NOT IN ('', 'NA', 'n/a', '-1.#IND') THEN t END AS value FROM raw) GROUP BY value
""",
)
def missing_tokens(spark: SparkSession, folder: str) -> DataFrame:
    slot = F.col("row_id") % 7
    text = F.col("c2")
    for i, token in enumerate(["NA", "", " NA", "?", "n/a", "-1.#IND"]):
        text = F.when(slot == i, F.lit(token)).otherwise(text)
    raw = V.profile(spark, folder).select(text.alias("value"))
    return C.drop_missing_tokens(raw).groupBy("value").agg(F.count("*").alias("n"))


@query(
    "features_income",
    f"""
WITH {V.PROFILE}
SELECT row_id,
       round(coalesce(dividends, 0) + coalesce(CASE WHEN row_id % 11 <> 0 THEN gains END, 0) - coalesce(losses, 0), 6)
         AS invest_income,
       coalesce(dividends, 0) + coalesce(CASE WHEN row_id % 11 <> 0 THEN gains END, 0) - coalesce(losses, 0) > 0
         AS has_invest_income,
       coalesce(c1 IN ('AUTOMOBILE', 'MACHINERY'), false) AS is_student
FROM profile
""",
)
def features_income(spark: SparkSession, folder: str) -> DataFrame:
    student = F.when(F.col("c1") == "AUTOMOBILE", "High school").when(
        F.col("c1") == "MACHINERY", "College or university"
    )
    rows = V.profile(spark, folder).select(
        "row_id",
        F.when(F.col("row_id") % 11 != 0, F.col("gains")).alias("capital gains"),
        F.col("losses").alias("capital losses"),
        F.col("dividends").alias("dividends from stocks"),
        student.otherwise(F.col("c1")).alias("enroll in edu inst last wk"),
    )
    return X.derive(rows).select(
        "row_id", F.round("invest_income", 6).alias("invest_income"), "has_invest_income", "is_student"
    )


@query(
    "features_work",
    f"""
WITH {V.BANDS}
SELECT wage > 0 AS has_wage, weeks > 0 AS worked_any_weeks, weeks = 49 AS full_year_52w, count(*) AS n,
       sum(w) AS w
FROM bands GROUP BY ALL
""",
)
def features_work(spark: SparkSession, folder: str) -> DataFrame:
    weeks = F.col("weeks worked in year")
    # The view's weeks end at 49: move the working ones up by three, so that a full year occurs.
    rows = V.bands(spark, folder).withColumn("weeks worked in year", F.when(weeks > 0, weeks + 3).otherwise(weeks))
    return (
        X.derive(rows)
        .groupBy("has_wage", "worked_any_weeks", "full_year_52w")
        .agg(F.count("*").alias("n"), F.sum("w").alias("w"))
    )


@query(
    "ordinal_level",
    """
SELECT p_partkey,
       CAST(CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3
                        WHEN 'STANDARD' THEN 4 END AS BIGINT) AS level
FROM part
""",
)
def ordinal_level(spark: SparkSession, folder: str) -> DataFrame:
    levels = ["ECONOMY", "SMALL", "MEDIUM", "LARGE", "STANDARD"]
    return V.table(spark, folder, "part").select("p_partkey", X.ordinal(F.col("p_type"), levels).alias("level"))


@query(
    "sigmoid_score",
    "SELECT c_custkey, round(1 / (1 + exp(-c_acctbal / 1000)), 8) AS p FROM customer",
)
def sigmoid_score(spark: SparkSession, folder: str) -> DataFrame:
    score = X.sigmoid(F.col("c_acctbal") / 1000)
    return V.table(spark, folder, "customer").select("c_custkey", F.round(score, 8).alias("p"))


@query(
    "log_clip",
    "SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS amount FROM customer",
)
def log_clip(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.log1p(X.clip_at_zero(F.col("c_acctbal")))
    return V.table(spark, folder, "customer").select("c_custkey", F.round(amount, 6).alias("amount"))


@query(
    "features_missing",
    f"""
WITH {V.BANDS}
SELECT coalesce(wage > 20, false) AS has_wage, coalesce(weeks > 30, false) AS worked_any_weeks, false AS full_year_52w, count(*) AS n
FROM bands GROUP BY ALL
""",
)
def features_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Missing wages and weeks are no wage and no weeks."""
    wage, weeks = F.col("wage per hour"), F.col("weeks worked in year")
    rows = V.bands(spark, folder).withColumns({"wage per hour": F.when(wage > 20, wage), "weeks worked in year": F.when(weeks > 30, weeks)})
    return X.derive(rows).groupBy("has_wage", "worked_any_weeks", "full_year_52w").agg(F.count("*").alias("n"))
