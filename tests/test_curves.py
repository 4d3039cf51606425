"""Curves, areas, thresholds and reports against worked answers and brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weighted_insights.operators import curves as K
from weighted_insights.operators.reports import at_threshold, classification_report
from weighted_insights.operators.running import range_cuts, running_sums, with_range
from weighted_insights.operators.weights import class_weights, with_balanced_weight
from weighted_insights.plans.models import compare, report_at_precision

ROWS = [(0.9, 1, 2.0), (0.8, 0, 1.0), (0.8, 1, 1.0), (0.3, 0, 5.0), (0.2, 1, 1.0), (0.1, 0, 4.0)]


def scored(spark, rows=ROWS):
    return spark.createDataFrame(rows, "p double, y int, w double")


def brute(rows):
    """Curve by plain loops: thresholds ascending with precision, recall and F1, plus areas."""
    rows = [r for r in rows if r[2] != 0]
    positive = sum(w for _, y, w in rows if y)
    negative = sum(w for _, y, w in rows if not y)
    points = []
    for t in sorted({p for p, _, _ in rows}):
        tp = sum(w for p, y, w in rows if p >= t and y)
        fp = sum(w for p, y, w in rows if p >= t and not y)
        precision, recall = tp / (tp + fp), tp / positive
        points.append((t, precision, recall, 2 * precision * recall / (precision + recall + 1e-12), fp / negative))
    down = points[::-1]
    ap = sum(
        (r - (down[i - 1][2] if i else 0)) * p for i, (_, p, r, _, _) in enumerate(down)
    )
    auc, last = 0.0, (0.0, 0.0)
    for _, _, r, _, f in down:
        auc += (f - last[0]) * (r + last[1]) / 2
        last = (f, r)
    return points, ap, auc


def test_curve_of_the_worked_example(spark):
    curve = K.score_curve(scored(spark))
    rows = {r.p: r for r in curve.collect()}
    for t, precision, recall, f1 in [
        (0.1, 4 / 14, 1, 0.4444),
        (0.2, 4 / 10, 1, 0.5714),
        (0.3, 3 / 9, 0.75, 0.4615),
        (0.8, 3 / 4, 0.75, 0.75),
        (0.9, 1, 0.5, 0.6667),
    ]:
        assert rows[t].precision == pytest.approx(precision)
        assert rows[t].recall == pytest.approx(recall)
        assert rows[t].f1 == pytest.approx(f1, abs=1e-4)
    closing = K.pr_points(curve).where("threshold IS NULL").collect()
    assert [tuple(r) for r in closing] == [(None, 1.0, 0.0, 0.0)]
    found = K.evaluate(curve).first()
    assert found.roc_auc_w == pytest.approx(0.8375)
    assert found.pr_auc_w == pytest.approx(0.7875)


def test_threshold_rules_keep_the_reported_shift(spark):
    curve = K.score_curve(scored(spark))
    row = curve.agg(
        K.best_f1_measure().alias("f_ref"),
        K.best_f1_measure("exact").alias("f_exact"),
        K.precision_threshold_measure(0.70).alias("p_ref"),
        K.precision_threshold_measure(0.70, "exact").alias("p_exact"),
        K.precision_threshold_measure(1.5).alias("p_never"),
        K.precision_threshold_measure(1.5, "exact").alias("p_never_exact"),
    ).first()
    assert tuple(row) == (0.3, 0.8, 0.3, 0.8, 0.3, 0.8)
    with pytest.raises(ValueError):
        K.best_f1_measure("other")


def test_rows_of_zero_weight_change_nothing(spark):
    plain = sorted(map(tuple, K.score_curve(scored(spark)).collect()))
    assert sorted(map(tuple, K.score_curve(scored(spark, [*ROWS, (0.85, 0, 0.0)])).collect())) == plain


def test_no_rows_and_one_score(spark):
    empty = K.score_curve(scored(spark).where("p > 2"))
    assert empty.agg(K.best_f1_measure().alias("t")).first().t == 0.5
    one = K.evaluate(K.score_curve(scored(spark, [(0.4, 1, 1.0), (0.4, 0, 3.0)]))).first()
    assert (one.best_thr, one.roc_auc_w, one.pr_auc_w) == (0.4, 0.5, 0.25)


def test_single_class(spark):
    row = K.evaluate(K.score_curve(scored(spark, [(0.4, 0, 1.0), (0.6, 0, 3.0)]))).first()
    assert row.roc_auc_w is None and row.pr_auc_w == 0.0


def random_rows(seed, n=400, levels=60):
    rng = np.random.default_rng(seed)
    p = rng.integers(0, levels, n) / levels
    y = (rng.random(n) < p).astype(int)
    w = rng.integers(0, 5, n).astype(float)
    # a third of all rows share one score
    p[: n // 3] = 0.5
    return [(float(a), int(b), float(c)) for a, b, c in zip(p, y, w)]


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_curve_equals_brute_force_for_any_number_of_ranges(spark, buckets):
    rows = random_rows(buckets)
    points, ap, auc = brute(rows)
    curve = K.score_curve(scored(spark, rows), buckets=buckets)
    mine = sorted((r.p, r.precision, r.recall, r.f1) for r in curve.collect())
    assert np.allclose(mine, [p[:4] for p in points])
    found = K.evaluate(curve).first()
    assert found.pr_auc_w == pytest.approx(ap) and found.roc_auc_w == pytest.approx(auc)
    up = [p[3] for p in points[1:]] + [0.0]
    assert found.best_thr == points[int(np.argmax(up))][0]
    meets = [p[1] for p in points[1:]] + [1.0]
    target = curve.agg(K.precision_threshold_measure(0.6).alias("t")).first().t
    assert target == points[[i for i, x in enumerate(meets) if x >= 0.6][0]][0]


def test_roc_points_run_from_the_origin_and_drop_equal_steps(spark):
    rows = [(0.9, 1, 1.0), (0.8, 1, 1.0), (0.7, 1, 1.0), (0.6, 0, 1.0)]
    curve = K.score_curve(scored(spark, rows))
    kept = sorted((r.fpr, r.tpr, r.threshold) for r in K.roc_points(curve).collect())
    third = pytest.approx(1 / 3)
    assert kept == [(0.0, 0.0, float("inf")), (0.0, third, 0.9), (0.0, 1.0, 0.7), (1.0, 1.0, 0.6)]
    assert K.roc_points(curve, drop_collinear=False).count() == 5


def test_invariants(spark):
    rows = random_rows(3)
    base = K.evaluate(K.score_curve(scored(spark, rows))).first()
    scaled = K.evaluate(K.score_curve(scored(spark, [(p, y, 3 * w) for p, y, w in rows]))).first()
    flipped = K.evaluate(K.score_curve(scored(spark, [(-p, y, w) for p, y, w in rows]))).first()
    doubled = K.evaluate(K.score_curve(scored(spark, [(p, y, 1.0) for p, y, w in rows for _ in range(int(w))]))).first()
    assert scaled.roc_auc_w == pytest.approx(base.roc_auc_w) and scaled.pr_auc_w == pytest.approx(base.pr_auc_w)
    assert flipped.roc_auc_w == pytest.approx(1 - base.roc_auc_w)
    assert doubled.roc_auc_w == pytest.approx(base.roc_auc_w) and doubled.best_thr == base.best_thr


def test_several_models_at_once_equal_one_at_a_time(spark):
    parts = {"a": random_rows(5), "b": random_rows(6, levels=9)}
    long = spark.createDataFrame([(m, *r) for m, rows in parts.items() for r in rows], "model string, p double, y int, w double")
    together = {r.model: r for r in compare(long).collect()}
    for m, rows in parts.items():
        alone = K.evaluate(K.score_curve(scored(spark, rows))).first()
        assert together[m].roc_auc_w == pytest.approx(alone.roc_auc_w)
        assert together[m].best_thr == alone.best_thr
    ranked = [r.pr_auc_w for r in compare(long).collect()]
    assert ranked == sorted(ranked, reverse=True)


def test_running_sums_ascending_with_neighbours(spark):
    points = spark.createDataFrame([(float(i), 1.0) for i in range(50)], "v double, n double")
    cuts = range_cuts(points, "v", 8)
    rows = sorted(running_sums(points, "v", ["n"], cuts).collect(), key=lambda r: r.v)
    assert [r.cum_n for r in rows] == [i + 1.0 for i in range(50)]
    assert [r.next_v for r in rows] == [*map(float, range(1, 50)), None]
    assert [r.is_first for r in rows] == [True] + [False] * 49


def test_classification_report(spark):
    rows = scored(spark).withColumn("yhat", at_threshold(F.col("p"), 0.3))
    found = {r["class"]: r for r in classification_report(rows).collect()}
    # tn 4, fp 6, fn 1, tp 3
    assert (found["0"].precision, found["0"].recall, found["0"].support) == (0.8, 0.4, 10.0)
    assert found["1"].precision == pytest.approx(1 / 3) and found["1"].recall == 0.75
    assert found["accuracy"].f1 == 0.5 and found["accuracy"].support == 14
    f0, f1 = found["0"].f1, found["1"].f1
    assert found["macro avg"].f1 == pytest.approx((f0 + f1) / 2)
    assert found["weighted avg"].f1 == pytest.approx((f0 * 10 + f1 * 4) / 14)
    nothing = classification_report(scored(spark).withColumn("yhat", F.lit(0))).where("class = '1'").first()
    assert (nothing.precision, nothing.recall, nothing.f1) == (0.0, 0.0, 0.0)


def test_report_at_precision_uses_the_reported_threshold(spark):
    rows = {r["class"]: r for r in report_at_precision(scored(spark), 0.70).collect()}
    assert rows["1"].threshold == 0.3 and rows["1"].precision == pytest.approx(1 / 3)
    exact = {r["class"]: r for r in report_at_precision(scored(spark), 0.70, "exact").collect()}
    assert exact["1"].threshold == 0.8 and exact["1"].precision == 0.75


# Published weighted reports: class precision, recall, support -> F1, macro and weighted averages.
@pytest.mark.parametrize(
    "p0,r0,p1,r1,f0,f1,macro,weighted",
    [(0.976, 0.972, 0.614, 0.654, 0.974, 0.633, 0.804, 0.952), (0.975, 0.954, 0.494, 0.647, 0.965, 0.560, 0.762, 0.938)],
)
def test_report_arithmetic_agrees_with_published_reports(spark, p0, r0, p1, r1, f0, f1, macro, weighted):
    s0, s1 = 64953101.68, 4483480.56
    tn, tp = r0 * s0, r1 * s1
    rows = [(0, 0, tn), (0, 1, s0 - tn), (1, 0, s1 - tp), (1, 1, tp)]
    found = classification_report(spark.createDataFrame(rows, "y int, yhat int, w double"))
    found = {r["class"]: r for r in found.collect()}
    assert found["0"].f1 == pytest.approx(f0, abs=2e-3) and found["1"].f1 == pytest.approx(f1, abs=3e-3)
    assert found["macro avg"].f1 == pytest.approx(macro, abs=2e-3)
    assert found["weighted avg"].f1 == pytest.approx(weighted, abs=2e-3)


def test_balanced_weights(spark):
    rows = scored(spark)
    found = class_weights(rows).first()
    assert (found.w_neg, found.w_pos, found.pos_factor) == (10.0, 4.0, 2.5)
    balanced = with_balanced_weight(rows)
    totals = balanced.groupBy("y").agg(F.sum("w_balanced").alias("s")).collect()
    assert {r.s for r in totals} == {10.0}


@pytest.mark.parametrize("label", [0, 1])
def test_curves_of_one_class_have_no_rate_for_the_other(spark, label):
    curve = K.score_curve(spark.createDataFrame([(0.1 * i, label, 1.0) for i in range(5)], "p double, y int, w double"))
    points = K.roc_points(curve).collect()
    assert all((r.fpr if label else r.tpr) is None for r in points if r.threshold < 1)
    assert [(r.fpr, r.tpr) for r in points if r.threshold > 1] == [(0.0, 0.0)]
    assert K.evaluate(curve).first().roc_auc_w is None
    assert K.pr_points(curve).count() == 6


def test_one_score_with_nearly_all_rows_leaves_even_ranges(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") < 198_000, F.lit(0.5)).otherwise(F.col("id") / 1e6).alias("p"), (F.col("id") % 2).alias("y"), F.lit(1.0).alias("w")
    )
    points = rows.groupBy("p").agg(F.sum("w").alias("w"))
    cuts = range_cuts(points, "p", 20)
    held = with_range(points, "p", cuts).groupBy("_range").count().agg(F.max("count"), F.sum("count")).first()
    assert held[1] == 2001 and held[0] <= 2 * 2001 / 20
    assert K.score_curve(rows, buckets=20).count() == 2001


def test_cuts_do_not_depend_on_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") / 7).alias("p"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 50)
        assert len(range_cuts(rows, "p")) == 255
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _area(points):
    points = sorted(points)
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


@pytest.mark.parametrize("max_points", [8, 20, 64, 500])
def test_thinned_curves(spark, max_points):
    rows = spark.range(20_000).select(
        F.pmod("id", F.lit(2)).cast("string").alias("model"),
        F.rand(1).alias("p"),
        (F.rand(2) < F.col("id") / 20_000).cast("int").alias("y"),
        (1 + F.col("id") % 3).cast("double").alias("w"),
    )
    rows = rows.withColumn("p", F.when(F.col("y") == 1, F.sqrt("p")).otherwise(F.col("p")))
    curve = K.score_curve(rows, keys=["model"]).persist()
    roc, pr = K.roc_points(curve, ["model"]), K.pr_points(curve, ["model"])
    thin_roc, thin_pr = K.thin_roc(roc, max_points, ["model"]), K.thin_pr(pr, max_points, ["model"])
    assert thin_roc.columns == roc.columns and thin_pr.columns == pr.columns
    whole, some = ([(r.model, r.fpr, r.tpr, r.threshold) for r in t.collect()] for t in (roc, thin_roc))
    assert set(some) <= set(whole)
    for model in "01":
        full, left = ([(f, t) for m, f, t, _ in points if m == model] for points in (whole, some))
        assert len(left) <= max_points < len(full) and {(0.0, 0.0), (1.0, 1.0)} <= set(left)
        assert abs(_area(full) - _area(left)) <= 1 / max_points
    whole, some = ([(r.model, r.threshold, r.precision, r.recall, r.f1) for r in t.collect()] for t in (pr, thin_pr))
    assert set(some) <= set(whole) and sum(t is None for _, t, *_ in some) == 2
    for model in "01":
        full, left = ([(r, p) for m, _, p, r, _ in points if m == model] for points in (whole, some))
        cells = max_points // 4
        ranges = [[p for r, p in full if min(int(r * cells), cells - 1) == c] for c in range(cells)]
        assert len(left) <= max_points
        assert [(min(p), max(p)) for p in ranges if p] == [(min(q), max(q)) for q in ([p for r, p in left if min(int(r * cells), cells - 1) == c] for c in range(cells)) if q]
    curve.unpersist()


def test_thinning_keeps_short_curves_and_one_class(spark):
    rows = spark.createDataFrame([(0.1, 1, 1.0), (0.5, 1, 1.0), (0.9, 1, 2.0)], "p double, y int, w double")
    curve = K.score_curve(rows)
    roc = K.roc_points(curve, drop_collinear=False)
    assert sorted(K.thin_roc(roc, 100).collect(), key=str) == sorted(roc.collect(), key=str)
    assert sorted(K.thin_pr(K.pr_points(curve), 100).collect(), key=str) == sorted(K.pr_points(curve).collect(), key=str)
    with pytest.raises(ValueError):
        K.thin_roc(roc, 2)
