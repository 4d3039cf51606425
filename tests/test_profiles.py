"""Weighted profiles against worked answers, and the shape of their plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from weighted_insights.operators import profiles as P


@pytest.fixture(scope="module")
def rows(spark):
    data = [(0, "a", 2.0, 1), (0, "b", 1.0, 0), (0, None, 1.0, 0), (1, "a", 1.0, 1), (1, "c", 3.0, 0)]
    return spark.createDataFrame(data, "segment int, v string, w double, y int").withColumn(
        "x", F.when(F.col("v") != "b", F.lit(4.0))
    )


def test_crosstab_keeps_the_whole_denominator(rows):
    found = {(r.segment, r.category): r.share for r in P.crosstab(rows, ["v"], top_n=2).collect()}
    assert found == {(0, "a"): 0.5, (0, "c"): 0.0, (1, "a"): 0.25, (1, "c"): 0.75}
    wide = {r.segment: (r.a, r.c) for r in P.crosstab_wide(rows, "v", top_n=2).collect()}
    assert wide == {0: (0.5, 0.0), 1: (0.25, 0.75)}
    assert P.crosstab_wide(rows, "v", top_n=2).columns == ["segment", "a", "c"]


def test_summary(rows):
    found = [tuple(r) for r in P.segment_summary(rows, means=["x"]).collect()]
    # ties by segment; the row without x counts as zero with its weight
    assert found == [(0, 0.5, 0.5, 2.0), (1, 0.5, 0.25, 4.0)]
    assert [tuple(r) for r in P.segment_shares(rows).collect()] == [(0, 0.5), (1, 0.5)]
    assert {(r.segment, r.attribute): r.weighted_mean for r in P.numeric_means(rows, ["x"]).collect()} == {
        (0, "x"): 2.0,
        (1, "x"): 4.0,
    }


def test_segment_without_weight_has_guarded_rates(spark):
    rows = spark.createDataFrame([(0, 0.0, 1), (1, 2.0, 1)], "segment int, w double, y int")
    found = {r.segment: (r.weighted_share, r.weighted_pos_rate) for r in P.segment_summary(rows).collect()}
    assert found == {0: (0.0, 0.0), 1: (1.0, 1.0)}


def test_top_per_segment_text(rows):
    found = {r.segment: r.top for r in P.top_per_segment(rows, ["v"], 2).collect()}
    assert found == {0: "a (50.00%), NA (25.00%)", 1: "c (75.00%), a (25.00%)"}


def test_categories_and_counts(rows):
    assert [tuple(r) for r in P.top_categories(rows, "v", 3).collect()] == [("a", 3.0), ("c", 3.0), ("NA", 1.0)]
    assert [tuple(r) for r in P.value_counts(rows, "v").collect()] == [("a", 2), ("b", 1), ("c", 1)]
    assert P.row_and_column_count(rows).first().n_rows == 5
    assert [r.segment for r in P.segment_ids(rows).collect()] == [0, 1]


def test_crosstab_shares_of_a_segment_sum_to_at_most_one(rows):
    sums = P.crosstab(rows, ["v", "y"], top_n=6).groupBy("segment", "attribute").agg(F.sum("share").alias("s"))
    assert all(r.s == pytest.approx(1.0) for r in sums.collect())


def test_many_categories_in_one_segment(spark):
    rows = spark.range(20_000).select(
        F.lit(0).alias("segment"), F.col("id").cast("string").alias("v"), (F.col("id") % 97).cast("double").alias("w")
    )
    found = P.top_per_segment(rows, ["v"], 3).first().top
    assert [t.split(" ")[0] for t in found.split(", ")] == ["10087", "10184", "10281"]


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_all_attributes_share_one_scan(spark, folder):
    from weighted_insights.catalog import QUERIES

    for name in ("crosstab_all", "segment_top3_all"):
        plan = executed(QUERIES[name](spark, folder))
        assert plan.count("FileScan") == 2, name  # orders and customer, once each
        assert "ReusedExchange" in plan
        assert "WindowGroupLimit" in plan


def test_no_python_and_no_cross_product_in_relational_queries(spark, folder):
    from weighted_insights.catalog import QUERIES

    # Distances to many wide centres are numpy products; corpus operators have plans of their own.
    skipped = ("train", "kmeans", "elbow_sweep", "job", "round_trip", "assign_centres", "update_centres", "weighted_inertia")
    for name, query in QUERIES.items():
        if any(word in name for word in skipped):
            continue
        plan = query(spark, folder)._jdf.queryExecution().executedPlan().toString()
        for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
            assert word not in plan, (name, word)


def test_summary_reads_only_its_columns(spark, folder):
    from weighted_insights.catalog import QUERIES

    plan = QUERIES["segment_summary"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan and "c_name" not in plan and "c_mktsegment" not in plan


def test_curve_aggregates_its_scores_once(spark, folder):
    from weighted_insights.catalog import QUERIES

    for name in ("auc_ap", "model_comparison"):
        plan = executed(QUERIES[name](spark, folder))
        assert plan.count("FileScan") == 1 and "ReusedExchange" in plan, name
        # the running sums over scores run inside value ranges
        assert re.search(r"sum\(tp#\d+\) windowspecdefinition\((model#\d+, )?_range#", plan), name


def test_a_missing_segment_keeps_its_top_categories(spark):
    rows = spark.createDataFrame([(None, "a", 1.0), (None, "b", 3.0), (1, "a", 2.0)], "segment int, c string, w double")
    found = {r.segment: r.top for r in P.top_per_segment(rows, ["c"]).collect()}
    assert set(found) == {None, 1} and found[None].startswith("b")
