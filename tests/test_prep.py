"""Fitted preprocessing, exact quantiles and the exact split, against worked answers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from weighted_insights.operators import prep as R
from weighted_insights.operators import quantiles as Q
from weighted_insights.operators import splits as S
from weighted_insights.operators.splits import class_quotas, fit_split, split_sizes


def column(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")


def scaled(df, **spec):
    return [r.x for r in R.fit_prep(df, R.FeatureSpec(**spec)).scaled(df).collect()]


def test_median_and_quartiles_interpolate(spark):
    df = column(spark, [1, 2, 3, 4, 10, 20])
    assert Q.exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.5, 0.75]) == {"x": [2.25, 3.5, 8.5]}
    assert scaled(df, robust=("x",))[-1] == pytest.approx(2.64)


def test_zero_spread_divides_by_one(spark):
    df = column(spark, [0] * 10 + [5])
    assert scaled(df, robust=("x",))[-1] == 5.0
    assert scaled(df, standard=("x",))[-1] == pytest.approx(3.162278, abs=1e-6)
    assert scaled(column(spark, [7, 7]), standard=("x",)) == [0.0, 0.0]


def test_impute_before_clip_before_log(spark):
    df = column(spark, [-5, None, 3])
    prep = R.fit_prep(df, R.FeatureSpec(skewed=("x",)))
    assert prep.numeric[0].median == -1.0
    values = [r[0] for r in df.select(F.expr(prep.numeric[0].prepared())).collect()]
    assert values == pytest.approx([0.0, 0.0, math.log1p(3)])
    assert [r.x for r in prep.imputed(df).collect()] == [-5.0, -1.0, 3.0]


def test_a_column_without_values_is_dropped(spark):
    df = spark.createDataFrame([(1.0, None, None)], "a double, b double, c string")
    prep = R.fit_prep(df, R.FeatureSpec(standard=("a", "b"), categorical=("c",)))
    assert prep.feature_names == ["a"]


def test_custom_steps(spark):
    df = column(spark, [1, 2, 3])
    spec = R.FeatureSpec(skewed=("x",), skew_steps=(lambda text: f"({text}) * 2",))
    assert R.fit_prep(df, spec).numeric[0].center == 4.0


def test_quantiles_are_exact(spark):
    df = spark.range(0, 20_000, 1, 4).select(
        F.randn(1).alias("a"),
        F.floor(F.rand(2) * 9).cast("double").alias("b"),
        F.when(F.rand(3) < 0.4, F.lit(0.0)).otherwise(F.exp(F.randn(4))).alias("c"),
        F.when(F.rand(5) < 0.5, F.rand(6)).alias("d"),
        F.lit(None).cast("double").alias("e"),
    ).persist()
    local = df.toPandas()
    wanted = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = Q.exact_quantiles(df, {c: F.col(c) for c in df.columns}, wanted)
    for c in "abcd":
        assert found[c] == pytest.approx(np.quantile(local[c].dropna(), wanted).tolist(), abs=1e-12)
    assert found["e"] is None
    df.unpersist()


def encode(spark, train, apply):
    train_df = spark.createDataFrame([(v,) for v in train], "c string")
    apply_df = spark.createDataFrame([(v,) for v in apply], "c string")
    prep = R.fit_prep(train_df, R.FeatureSpec(categorical=("c",)))
    rows = prep.transform(apply_df).select(vector_to_array("features").alias("v")).collect()
    return prep, [list(r.v) for r in rows]


def test_one_hot(spark):
    prep, rows = encode(spark, ["c", "a", "b", "b"], ["a", "b", "c", "zz", None])
    assert prep.feature_names == ["c=a", "c=b", "c=c"]
    # a missing value goes through the mode, b
    assert rows == [[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 0], [0, 1, 0]]


def test_two_categories_keep_one_column(spark):
    prep, rows = encode(spark, ["F", "M", "F"], ["M", "F", "zz", None])
    assert prep.feature_names == ["c=M"] and rows == [[1], [0], [0], [0]]


def test_mode_ties_go_to_the_smallest(spark):
    prep, _ = encode(spark, ["b", "a", "b", "a"], ["a"])
    assert prep.categorical[0].mode == "a"


def test_names_and_values_with_quotes(spark):
    df = spark.createDataFrame([("it's", 1.0), ("back\\slash", 2.0), ("x`y", None)], "`veteran's admin` string, `a b` double")
    spec = R.FeatureSpec(standard=("a b",), categorical=("veteran's admin",))
    prep = R.fit_prep(df, spec)
    rows = prep.transform(df).select(vector_to_array("features").alias("v")).collect()
    assert [sum(r.v[1:]) for r in rows] == [1.0, 1.0, 1.0]


def test_spec_by_type_groups_features(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 3, "a", True, 5.0)],
        "age double, `wage per hour` double, education_ord long, sex string, has_wage boolean, invest_income double",
    )
    spec = R.spec_by_type(df)
    assert spec.skewed == ("wage per hour",) and spec.unscaled == ("education_ord",)
    assert spec.robust == ("age", "invest_income") and spec.categorical == ("sex", "has_wage")


def test_pipeline_saves_and_loads(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a", "x"), (2.0, "b", "y"), (None, None, "z")], "n double, c string, d string")
    prep = R.fit_prep(df, R.FeatureSpec(skewed=("n",), categorical=("c", "d")))
    pipeline = prep.pipeline(df)
    pipeline.write().overwrite().save(str(tmp_path / "prep"))
    again = PipelineModel.load(str(tmp_path / "prep"))
    assert pipeline.transform(df).select("features").collect() == again.transform(df).select("features").collect()
    assert len(prep.feature_names) == pipeline.transform(df).first().features.size


def test_quotas_of_the_published_split():
    assert class_quotas({0: 187_141, 1: 12_382}, 0.2) == {0: 37_429, 1: 2_476}


@pytest.mark.parametrize("digits,at_most", [(1, 5), (3, 100_000), (2, 1)])
def test_split_is_exact_and_equals_ranking_every_row(spark, digits, at_most):
    df = spark.range(0, 3000, 1, 5).select(F.col("id").alias("row_id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    split = fit_split(df, step_digits=digits, rank_at_most=at_most)
    marked = split.mark(df)
    sizes = {(r.split, r.y): r.n for r in split_sizes(marked).collect()}
    quotas = class_quotas({0: sizes["valid", 0] + sizes["train", 0], 1: sizes["valid", 1] + sizes["train", 1]}, 0.2)
    assert {0: sizes["valid", 0], 1: sizes["valid", 1]} == quotas
    import hashlib

    ids = {0: [], 1: []}
    for i in range(3000):
        ids[int(i % 7 == 0)].append((hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
    wanted = {i for c in ids for _, i in sorted(ids[c])[: quotas[c]]}
    assert {r.row_id for r in marked.where("split = 'valid'").collect()} == wanted
    # membership does not depend on partitioning
    again = fit_split(df.repartition(3), step_digits=digits).mark(df.repartition(11))
    assert {r.row_id for r in again.where("split = 'valid'").collect()} == wanted


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([(i, int(i == 0)) for i in range(10)], "row_id long, y int")
    marked = fit_split(df).mark(df)
    assert marked.where("split = 'valid'").count() == 2
    assert fit_split(df.limit(0)).last_valid == {}


def test_nan_is_missing(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("x"))
    wanted = [0.25, 0.5, 0.75]
    found = Q.exact_quantiles(df, {"x": F.col("x")}, wanted)["x"]
    assert found == pytest.approx(np.quantile(np.arange(400, 1000.0), wanted).tolist())
    prep = R.fit_prep(df, R.FeatureSpec(unscaled=("x",)))
    assert prep.imputed(df).where("isnan(x) or x is null").count() == 0
    assert prep.numeric[0].median == 699.5


def test_mode_without_a_vocabulary(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "c string, e string")
    (only,) = R.fit_categories(df, ["c", "e"], encode=False)
    assert (only.name, only.mode, only.categories) == ("c", "a", ())


def test_repeated_ids_at_the_border_raise(spark):
    df = spark.range(3000).select((F.col("id") / 7).cast("long").alias("row_id"), F.lit(1).alias("y"))
    with pytest.raises(ValueError, match="not unique"):
        for seed in range(20):  # a border can also fall between two ids
            S.fit_split(df, seed=seed)


def test_missing_labels_raise(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 1)], "row_id long, y int")
    with pytest.raises(ValueError, match="missing labels"):
        S.fit_split(df)


def test_quotas_of_very_large_classes():
    n = 3 * 10**17 + 1
    quotas = S.class_quotas({0: n, 1: 2 * n, 2: 5}, 0.2)
    assert sum(quotas.values()) == -(-(3 * n + 5) // 5) or abs(sum(quotas.values()) - 0.2 * (3 * n + 5)) < 1000


def test_brackets_are_narrowed_and_stay_exact(spark, monkeypatch):
    df = spark.range(0, 30_000, 1, 6).select(
        F.randn(1).alias("a"), F.floor(F.rand(2) * 3).cast("double").alias("b"), F.when(F.rand(3) < 0.7, F.lit(5.0)).otherwise(F.rand(4) * 10).alias("c")
    ).persist()
    local, wanted = df.toPandas(), [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]
    monkeypatch.setattr(Q, "MOST", 20)
    monkeypatch.setattr(Q, "GRID", 16)
    found = Q.exact_quantiles(df, {c: F.col(c) for c in df.columns}, wanted)
    for c in df.columns:
        assert found[c] == pytest.approx(np.quantile(local[c], wanted).tolist(), abs=1e-12)
    df.unpersist()


@pytest.mark.parametrize("missing", [0, 1, 7, 60, 400])
@pytest.mark.parametrize("size", [1, 2, 5, 80])
def test_scales_by_rank_arithmetic(spark, size, missing):
    """Quartiles, means and deviations as if the imputed and stepped column had been sorted."""
    draw = np.random.default_rng(size + missing)
    values = [float(v) for v in draw.integers(-4, 9, size)] + [None] * missing
    df = column(spark, values).repartition(3)
    median = float(np.median(values[:size]))
    imputed = np.array([median if v is None else v for v in values])
    for group, steps in (("robust", lambda v: v), ("skewed", lambda v: np.log1p(np.maximum(v, 0)))):
        fit = R.fit_prep(df, R.FeatureSpec(**{group: ("x",)})).numeric[0]
        low, middle, high = np.quantile(steps(imputed), [0.25, 0.5, 0.75])
        assert (fit.median, fit.center, fit.scale) == pytest.approx((median, middle, (high - low) or 1.0))
    fit = R.fit_prep(df, R.FeatureSpec(standard=("x",))).numeric[0]
    assert (fit.center, fit.scale) == pytest.approx((imputed.mean(), imputed.std() or 1.0))


def test_prep_of_an_empty_table(spark):
    assert R.fit_prep(column(spark, []), R.FeatureSpec(robust=("x",))).numeric == ()


def test_two_scans_whatever_the_columns(spark):
    df = column(spark, range(100)).select("x", (F.col("x") * 2).alias("y"), (-F.col("x")).alias("z"))
    counted = []
    original = Q.aggregate_long
    Q.aggregate_long = lambda *a, **k: counted.append(1) or original(*a, **k)
    try:
        R.fit_prep(df, R.FeatureSpec(robust=("x",), skewed=("z",), standard=("y",)))
    finally:
        Q.aggregate_long = original
    assert len(counted) == 1


def test_wide_vocabulary_stays_a_table(spark, tmp_path):
    """300,000 categories of one column, three of another: neither an error nor a list on the driver."""
    n = 300_000
    rows = spark.range(0, n, 1, 6).select("id", F.concat(F.lit("k"), F.col("id")).alias("c"), F.concat(F.lit("s"), F.col("id") % 3).alias("d"))
    rows = rows.union(spark.createDataFrame([(n, "k77", None)], "id long, c string, d string"))
    prep = R.fit_prep(rows, R.FeatureSpec(categorical=("c", "d")))
    wide, narrow = prep.categorical
    assert (wide.size, wide.mode, wide.categories) == (n, "k77", ()) and narrow.categories == ("s0", "s1", "s2")
    assert prep.n_features == n + 3 and prep.groups == [(0, n), (n, n + 3)]
    order = {c: i for i, c in enumerate(sorted(f"k{i}" for i in range(n)))}
    some = spark.createDataFrame([(1, "k5", "s1"), (2, "k299999", "zz"), (3, "never seen", None), (4, None, "s2")], "id long, c string, d string")
    pipeline = prep.pipeline(some)
    pipeline.write().overwrite().save(str(tmp_path / "prep"))
    for stages in (pipeline, PipelineModel.load(str(tmp_path / "prep"))):
        got = {r["id"]: sorted(r["features"].indices.tolist()) for r in stages.transform(some).select("id", "features").collect()}
        # A missing value goes through the mode: k77, and s0 (of equals the smallest).
        assert got == {1: [order["k5"], n + 1], 2: [order["k299999"]], 3: [n], 4: [order["k77"], n + 2]}


def test_numbers_are_those_of_the_sorted_categories(spark, monkeypatch):
    from weighted_insights.operators import dictionary

    monkeypatch.setattr(dictionary, "BLOCK_ROWS", 20)
    texts = [("a", f"é{i}") for i in range(150)] + [("a", ""), ("a", "Z"), ("b", "only")] + [("c", chr(0x4E00 + i) + "😀") for i in range(90)]
    rows = spark.createDataFrame(texts, "attribute string, category string").repartition(5)
    got = {(r.attribute, r.category): r.number for r in dictionary.number_categories(rows).collect()}
    for attribute in "abc":
        mine = sorted(c for a, c in texts if a == attribute)
        assert [got[attribute, c] for c in mine] == list(range(len(mine)))
