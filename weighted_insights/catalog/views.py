"""Survey-like views over the given tables, in both dialects.

Each view names a segment, a weight, a label and attributes of a table that has
none of them, over all of its rows.  Weights are whole numbers, so sums do not
depend on the order of addition; missing values are put in on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table by its declared schema: no job to look into the files."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, with its customer's attributes."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    x = F.when(F.col("o_orderkey") % 11 != 0, F.col("c_acctbal"))
    return joined.select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("c_nationkey") % 6).cast("bigint").alias("segment"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("w"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c1"),
        F.col("o_orderpriority").alias("c2"),
        x.alias("x"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("gains"),
        F.greatest(-F.col("c_acctbal"), F.lit(0.0)).alias("losses"),
        F.col("c_nationkey").cast("double").alias("dividends"),
        (F.col("o_custkey") % 4).cast("string").alias("code_yn"),
        (F.col("o_custkey") % 5).cast("string").alias("code_niu"),
        (94 + F.col("o_orderkey") % 3).cast("string").alias("yr"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit("bad")).otherwise(x.cast("string")).alias("raw_num"),
    )


PROFILE = """
profile AS (
  SELECT o_orderkey AS row_id,
         CAST(c_nationkey % 6 AS BIGINT) AS segment,
         CAST(floor(o_totalprice / 1000) AS DOUBLE) AS w,
         CAST(o_orderstatus = 'F' AS INTEGER) AS y,
         nullif(c_mktsegment, 'BUILDING') AS c1,
         o_orderpriority AS c2,
         CASE WHEN o_orderkey % 11 <> 0 THEN c_acctbal END AS x,
         greatest(c_acctbal, 0.0::DOUBLE) AS gains,
         greatest(-c_acctbal, 0.0::DOUBLE) AS losses,
         CAST(c_nationkey AS DOUBLE) AS dividends,
         CAST(o_custkey % 4 AS VARCHAR) AS code_yn,
         CAST(o_custkey % 5 AS VARCHAR) AS code_niu,
         CAST(94 + o_orderkey % 3 AS VARCHAR) AS yr,
         CASE WHEN o_orderkey % 13 = 0 THEN 'bad'
              WHEN o_orderkey % 11 <> 0 THEN CAST(c_acctbal AS VARCHAR) END AS raw_num
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def bands(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item, with its part's size as an age."""
    items, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    return items.join(part, items.l_partkey == part.p_partkey).select(
        (F.col("p_size") * 2).cast("double").alias("age"),
        (F.col("l_quantity") - 1).alias("weeks worked in year"),
        F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("wage per hour"),
        F.col("l_quantity").alias("w"),
    )


BANDS = """
bands AS (
  SELECT CAST(p_size * 2 AS DOUBLE) AS age,
         l_quantity - 1 AS weeks,
         CASE WHEN l_tax = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS wage,
         l_quantity AS w
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""


def event_scores(spark: SparkSession, folder: str) -> DataFrame:
    """One scored row per event: an uninformative score with many ties."""
    return table(spark, folder, "events").select(
        (F.floor(F.col("value") / 5) / 100).alias("p"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        (F.col("user_id") % 5).cast("double").alias("w"),
    )


EVENT_SCORES = """
scored AS (
  SELECT floor(value / 5) / 100 AS p,
         CAST(event_type = 'purchase' AS INTEGER) AS y,
         CAST(user_id % 5 AS DOUBLE) AS w
  FROM events
)"""


def customer_scores(spark: SparkSession, folder: str) -> DataFrame:
    """One scored row per customer: an informative score."""
    return table(spark, folder, "customer").select(
        (F.floor((F.col("c_acctbal") + 1000) / 110) / 100).alias("p"),
        (F.floor(F.col("c_acctbal") / 1000) + F.col("c_custkey") % 7 > 8).cast("int").alias("y"),
        (F.col("c_custkey") % 4).cast("double").alias("w"),
    )


CUSTOMER_SCORES = """
scored AS (
  SELECT floor((c_acctbal + 1000) / 110) / 100 AS p,
         CAST(floor(c_acctbal / 1000) + c_custkey % 7 > 8 AS INTEGER) AS y,
         CAST(c_custkey % 4 AS DOUBLE) AS w
  FROM customer
)"""


def two_models(spark: SparkSession, folder: str) -> DataFrame:
    """Two score columns per event in long form."""
    events = table(spark, folder, "events").select(
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        (F.col("user_id") % 5).cast("double").alias("w"),
        F.inline(
            F.array(
                F.struct(F.lit("by value").alias("model"), (F.floor(F.col("value") / 5) / 100).alias("p")),
                F.struct(F.lit("by user").alias("model"), ((F.col("user_id") % 50) / 50).alias("p")),
            )
        ),
    )
    return events.select("model", "p", "y", "w")


TWO_MODELS = """
scored AS (
  SELECT 'by value' AS model, floor(value / 5) / 100 AS p,
         CAST(event_type = 'purchase' AS INTEGER) AS y, CAST(user_id % 5 AS DOUBLE) AS w FROM events
  UNION ALL
  SELECT 'by user', (user_id % 50) / 50.0::DOUBLE,
         CAST(event_type = 'purchase' AS INTEGER), CAST(user_id % 5 AS DOUBLE) FROM events
)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """One weighted vector per embedding."""
    return table(spark, folder, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("v"),
        F.col("label").cast("int").alias("label"),
        (1 + F.col("vec_id") % 3).cast("double").alias("w"),
    )


# Long form of the vectors, and the mean vector per label as fixed centres.
VECTORS = """
coords AS (
  SELECT vec_id, label, CAST(1 + vec_id % 3 AS DOUBLE) AS w, pos, CAST(embedding[pos] AS DOUBLE) AS x
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
),
centres AS (
  SELECT label AS cluster, pos, avg(x) AS c FROM coords GROUP BY label, pos
),
distances AS (
  SELECT vec_id, cluster, sum((x - c) * (x - c)) AS distance2
  FROM coords JOIN centres USING (pos) GROUP BY vec_id, cluster
),
assigned AS (
  SELECT vec_id, cluster, distance2 FROM distances
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance2, cluster) = 1
)"""


def training(spark: SparkSession, folder: str) -> DataFrame:
    """One labelled document per row."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.col("quality").cast("int").alias("y"),
        (1 + F.col("doc_id") % 3).cast("double").alias("w"),
        F.col("n_chars").cast("double").alias("n_chars"),
        "lang",
        "source",
    )


TRAINING = """
training AS (
  SELECT doc_id AS row_id, CAST(quality AS INTEGER) AS y, CAST(1 + doc_id % 3 AS DOUBLE) AS w
  FROM documents JOIN labels USING (doc_id)
)"""


def split_sql(view: str, name: str) -> str:
    """The view ``name`` with its stratified split, as ``marked``."""
    return f"""{view},
classes AS (SELECT y, count(*) AS n FROM {name} GROUP BY y),
totals AS (SELECT sum(n) AS n, sum(n) - ceil(0.2::DOUBLE * sum(n)) AS n_train FROM classes),
parts AS (
  SELECT y, classes.n, floor(classes.n * n_train / totals.n) AS base,
         classes.n * n_train / totals.n - floor(classes.n * n_train / totals.n) AS rest, n_train
  FROM classes, totals
),
quotas AS (
  SELECT y, n - base - CAST(row_number() OVER (ORDER BY rest DESC, y) <= n_train - sum(base) OVER () AS INTEGER)
         AS n_valid
  FROM parts
),
marked AS (
  SELECT {name}.*, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY md5('42|' || CAST(row_id AS VARCHAR)), row_id)
                              <= n_valid THEN 'valid' ELSE 'train' END AS split
  FROM {name} JOIN quotas USING (y)
)"""
