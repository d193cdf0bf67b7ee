"""M7-M16, L3, L4, Q7-Q9 against direct computation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmill.operators import drift as D
from cardmill.operators import evaluation as E
from cardmill.operators.sampling import seeded_sample, stratified_split

SCHEMA = "is_fraud int, score double, amount double"


def tuning_rows():
    rng = np.random.RandomState(42)
    y = [1] * 10 + [0] * 90
    p = np.concatenate([rng.uniform(0.25, 0.70, 10), rng.uniform(0.01, 0.25, 90)])
    a = np.concatenate([rng.uniform(300.0, 1500.0, 10), rng.uniform(20.0, 100.0, 90)]).round(2)
    return list(zip(y, map(float, p), map(float, a)))


def mixed_rows(seed=5, n=400):
    rng = random.Random(seed)
    # Scores on and next to the thresholds, with ties.
    return [
        (int(rng.random() < 0.2), rng.choice(E.THRESHOLDS + [0.0, 1.0, 0.3, rng.random()]), round(rng.uniform(1, 900), 2))
        for _ in range(n)
    ]


def test_thresholds_are_the_evenly_spaced_grid():
    assert E.THRESHOLDS == list(np.linspace(0.01, 0.90, 90))


@pytest.mark.parametrize("rows", [tuning_rows(), mixed_rows()], ids=["separable", "mixed"])
def test_sweep_matches_direct_counts(spark, rows):
    curve = E.threshold_curve(spark.createDataFrame(rows, SCHEMA)).orderBy("threshold_index").collect()
    assert [r.threshold for r in curve] == E.THRESHOLDS
    for r in curve:
        fn = [a for y, p, a in rows if y == 1 and p < r.threshold]
        fp = sum(1 for y, p, _ in rows if y == 0 and p >= r.threshold)
        tp = sum(1 for y, p, _ in rows if y == 1 and p >= r.threshold)
        assert (r.tp, r.fp, r.fn) == (tp, fp, len(fn))
        assert r.total_cost == pytest.approx(sum(fn) + 2.0 * fp)
        precision, recall = tp / (tp + fp + 1e-9), tp / (tp + len(fn) + 1e-9)
        assert r.f2 == pytest.approx(5 * precision * recall / (4 * precision + recall + 1e-9))


def test_best_thresholds(spark):
    df = spark.createDataFrame(tuning_rows(), SCHEMA)
    curve = E.threshold_curve(df)
    best = E.best_thresholds(curve).first()
    rows = curve.orderBy("threshold_index").collect()
    costs = [r.total_cost for r in rows]
    assert best.optimal_threshold == rows[costs.index(min(costs))].threshold
    f1 = [r.f1 for r in rows]
    assert best.f1_optimal_threshold == rows[f1.index(max(f1))].threshold
    assert 0.01 <= best.optimal_threshold <= 0.90
    assert best.min_cost <= best.cost_at_05 and best.savings_amount >= 0.0
    rounded = E.rounded_thresholds(E.best_thresholds(curve)).first()
    assert rounded.min_cost == pytest.approx(best.min_cost, abs=0.006)


def test_zero_cost_at_half_becomes_min_cost(spark):
    best = E.best_thresholds(E.threshold_curve(spark.createDataFrame([(1, 0.9, 5.0), (0, 0.1, 5.0)], SCHEMA))).first()
    assert best.cost_at_05 == best.min_cost == 0.0 and best.savings_pct == 0.0


def direct_areas(rows):
    P = sum(y for y, *_ in rows)
    N = len(rows) - P
    pr = roc = 0.0
    prev = (0.0, 1.0, 0.0)
    for cut in sorted({p for _, p, _ in rows}, reverse=True):
        tp = sum(1 for y, p, _ in rows if y and p >= cut)
        fp = sum(1 for y, p, _ in rows if not y and p >= cut)
        recall, precision, fpr = tp / P, tp / (tp + fp), fp / N
        pr += (recall - prev[0]) * (precision + prev[1]) / 2
        roc += (fpr - prev[2]) * (recall + prev[0]) / 2
        prev = (recall, precision, fpr)
    return pr, roc


def test_areas(spark):
    rows = mixed_rows(7)
    got = E.areas(spark.createDataFrame(rows, SCHEMA)).first()
    assert (got.pr_auc, got.roc_auc) == pytest.approx(direct_areas(rows))


def test_areas_when_most_rows_share_one_score(spark):
    rows = mixed_rows(8, 200) + [(i % 9 == 0, 0.5, 1.0) for i in range(800)]
    rows = [(int(y), p, a) for y, p, a in rows]
    got = E.areas(spark.createDataFrame(rows, SCHEMA)).first()
    assert (got.pr_auc, got.roc_auc) == pytest.approx(direct_areas(rows))


def test_comparison_of_models(spark):
    a, b = mixed_rows(1), mixed_rows(2)
    df = spark.createDataFrame([("a", *r) for r in a] + [("b", *r) for r in b], "model string, " + SCHEMA)
    table = {r.model: r for r in E.comparison(df, {"a": 0.5, "b": 0.3}).collect()}
    assert table["b"].threshold == 0.3
    assert table["b"].tp == sum(1 for y, p, _ in b if y and p >= 0.3)
    assert table["a"].roc_auc == pytest.approx(direct_areas(a)[1])


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(1, 0.9, 1.0), (1, 0.1, 1.0), (0, 0.6, 1.0), (0, 0.2, 1.0), (0, 0.2, 1.0)], SCHEMA)
    c = E.confusion(df).first()
    assert (c.tn, c.fp, c.fn, c.tp, c.f1_score) == (2, 1, 1, 1, 0.5)
    report = {r.class_name: r for r in E.class_report(df).collect()}
    assert report["Fraud"].precision == 0.5 and report["Legitimate"].recall == pytest.approx(2 / 3)
    assert report["accuracy"].f1_score == pytest.approx(0.6)
    assert report["weighted avg"].support == 5
    none = E.confusion(spark.createDataFrame([(0, 0.1, 1.0)], SCHEMA)).first()
    assert none.f1_score == 0.0


def test_curve_points_are_monotone(spark):
    points = E.curve_points(spark.createDataFrame(mixed_rows(3), SCHEMA)).orderBy(F.desc_nulls_first("threshold")).collect()
    assert (points[0].fpr, points[0].tpr, points[0].precision, points[0].recall) == (0.0, 0.0, 1.0, 0.0)
    assert all(x.tpr <= y.tpr and x.fpr <= y.fpr for x, y in zip(points, points[1:]))
    assert points[-1].tpr == points[-1].fpr == 1.0


@pytest.mark.parametrize("n", [49, 50, 999])
def test_split_sizes_are_exact(spark, n):
    df = spark.range(n).selectExpr("id", "cast(id % 7 = 0 as int) is_fraud")
    split = stratified_split(df, "id", "is_fraud").cache()
    n_test = math.ceil(n * 0.2)
    counts = {(r.is_fraud, r.is_test): r["count"] for r in split.groupBy("is_fraud", "is_test").count().collect()}
    assert split.count() == n
    assert counts[0, True] + counts[1, True] == n_test
    positives = math.ceil(n / 7)
    assert abs(counts[1, True] - positives * n_test / n) < 1
    again = stratified_split(df.repartition(5), "id", "is_fraud")
    assert split.exceptAll(again).count() == 0


def test_seeded_sample_ignores_partitioning(spark):
    one = {r.id for r in seeded_sample(spark.range(5000), "id", 100).collect()}
    two = {r.id for r in seeded_sample(spark.range(5000).repartition(7), "id", 100).collect()}
    other = {r.id for r in seeded_sample(spark.range(5000), "id", 100, seed=1).collect()}
    assert one == two and len(one) == 100 and one != other


def drift_frames(spark):
    rng = np.random.RandomState(42)

    def frame(amount, maximum):
        rows = zip(
            rng.poisson(5, 100).tolist(), rng.poisson(20, 100).tolist(), rng.normal(amount, 30, 100).tolist(), rng.normal(maximum, 100, 100).tolist()
        )
        return spark.createDataFrame(list(rows), "trans_count_7d int, trans_count_30d int, avg_amount_30d double, max_amount_30d double")

    return frame(150, 500), frame(450, 1500)


def test_drift(spark):
    reference, current = drift_frames(spark)
    scores = {r.column_name: r.drift_score for r in D.column_drift(reference, current).collect()}
    for name, score in scores.items():
        x = np.array([r[0] for r in reference.select(name).collect()], float)
        y = np.array([r[0] for r in current.select(name).collect()], float)
        at = np.concatenate([x, y])
        assert score == pytest.approx(max(abs((x <= v).mean() - (y <= v).mean()) for v in at)), name
    report = D.drift_report(reference, current)
    assert report["status"] == "SUCCESS" and report["dataset_drift"] is True
    assert report["drifted_features_count"] >= 2
    same = D.drift_report(reference, reference)
    assert same["dataset_drift"] is False and same["drift_share"] == 0.0


def test_drift_skips_empty(spark):
    reference, current = drift_frames(spark)
    assert D.drift_report(reference, current.limit(0))["status"] == "SKIPPED"
    assert D.drift_report(reference.select(F.lit("x").alias("a")), current.select(F.lit("x").alias("a")))["status"] == "SKIPPED"
