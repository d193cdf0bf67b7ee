"""M2: the second-order booster against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmill.operators import boosting as B
from cardmill.operators import training as M
from cardmill.operators import trees

NAMES = ["a", "b", "c"]
EDGES = [[i / 8 for i in range(1, 8)], [i / 5 for i in range(1, 5)], [0.5]]


def points(n, seed):
    """Rows with ties, missing numbers and a label that leans on a and c."""
    chance, rows = random.Random(seed), []
    for _ in range(n):
        x = [round(chance.random(), 1), chance.random(), float(chance.random() < 0.3)]
        label = int(chance.random() < (0.8 if x[0] > 0.6 and x[2] else 0.2))
        if chance.random() < 0.1:
            x[chance.randrange(3)] = chance.choice([None, float("nan")])
        rows.append((*x, label, chance.choice([1.0, 2.5])))
    return rows


def goes_left(x, edge):
    return x is not None and not math.isnan(x) and x <= edge


def plain_leaves(rows, margins, growth):
    """One tree as the list of its leaves' row numbers: the leaf of largest gain is split again and again."""
    chance = [1 / (1 + math.exp(-m)) for m in margins]
    g = [round((p - r[3]) * r[4] * B.UNIT) / B.UNIT for p, r in zip(chance, rows)]
    h = [round(p * (1 - p) * r[4] * B.UNIT) / B.UNIT for p, r in zip(chance, rows)]

    def worth(part):
        return sum(g[i] for i in part) ** 2 / (sum(h[i] for i in part) + growth.l2)

    def best(part):
        found = (0.0, None)
        for f, edges in enumerate(EDGES):
            for edge in edges:
                left = [i for i in part if goes_left(rows[i][f], edge)]
                right = [i for i in part if not goes_left(rows[i][f], edge)]
                if min(len(left), len(right)) >= growth.least_rows:
                    gain = (worth(left) + worth(right) - worth(part)) / 2
                    if gain > found[0] + 1e-9:
                        found = gain, (left, right)
        return found

    leaves = [(range(len(rows)), 0)]
    while growth.leaves is None or len(leaves) < growth.leaves:
        gains = [best(part) if level < growth.depth else (0.0, None) for part, level in leaves]
        top = max(range(len(leaves)), key=lambda i: gains[i][0])
        if gains[top][1] is None:
            break
        _, level = leaves.pop(top)
        leaves += [(part, level + 1) for part in gains[top][1]]
    return [(part, -growth.rate * sum(g[i] for i in part) / (sum(h[i] for i in part) + growth.l2)) for part, _ in leaves]


@pytest.mark.parametrize("leaves, depth", [(4, 5), (None, 3)])
def test_trees_equal_a_plain_booster(spark, monkeypatch, leaves, depth):
    monkeypatch.setattr(B, "RENEWED", 2)
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    rows = points(350, depth)
    growth = B.Growth(trees=4, depth=depth, leaves=leaves, rate=0.3, least_rows=5)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, b double, c double, y int, w double")
    member = B.fit_boosted(df, NAMES, F.col("y"), F.col("w"), growth, EDGES)
    margins = [0.0] * len(rows)
    for _ in range(4):
        for part, value in plain_leaves(rows, margins, growth):
            for i in part:
                margins[i] += value
    got = {r.i: r.raw for r in df.select("i", member.raw().alias("raw")).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx(margins, abs=1e-5)
    assert len(member.trees) == 4 and all(t.cover[0] == len(rows) for t in member.trees)
    assert leaves is None or all(sum(f < 0 for f in t.feature) <= leaves for t in member.trees)
    again = B.fit_boosted(df.repartition(5), NAMES, F.col("y"), F.col("w"), growth, EDGES)
    assert again == member  # whole-number sums: nothing hangs on the cut into tasks


def test_edge_cases(spark):
    schema = "a double, b double, y int"
    empty = spark.createDataFrame([], schema)
    assert B.fit_boosted(empty, ["a", "b"], F.col("y")).trees == []
    one = spark.createDataFrame([(1.0, None, 1)] * 50 + [(2.0, None, None)], schema)
    member = B.fit_boosted(one, ["a", "b"], F.col("y"), growth=B.Growth(trees=3))
    assert [t.feature for t in member.trees] == [[-1]] and member.trees[0].value[0] > 0
    assert B.bin_edges(one, ["a", "b"], 4) == [[1.0], []]
    with pytest.raises(ValueError):
        B.binned(one, ["a"], F.col("y"), F.lit(1.0), [list(range(256))])


def test_no_hessian_and_no_l2():
    growth = B.Growth(l2=0.0, least_rows=1, least_hessian=0.0)
    assert B.leaf_value(5, 0, growth) == 0.0
    gain = B.gains(np.array([B.UNIT, -B.UNIT, 0]), np.array([0, B.UNIT, 0]), np.array([2, 2, 0]), growth)
    assert np.isfinite(gain[:1]).all() and gain[2] == -np.inf  # nothing is right of the last bin


def test_ensemble_with_leafwise_member(spark, tmp_path):
    chance = random.Random(2)
    rows = [(i, str(i % 9), *r[:3], int(chance.random() < (0.9 if (r[1] or 0) > 0.5 else 0.1))) for i, r in enumerate(points(600, 9))]
    data = spark.createDataFrame(rows, "TransactionID int, card_id string, a double, b double, c double, is_fraud int")
    data = data.na.fill(0.0).withColumn("TransactionAmt", F.col("a") * 100)
    ensemble, report = M.train_ensemble(data, trees=12, depth=3, rate=0.2)
    assert report.first().metrics.leafwise.roc_auc > 0.8
    ensemble.save(spark, str(tmp_path / "model"))
    loaded = M.FraudEnsemble.load(spark, str(tmp_path / "model"))
    assert loaded.second == ensemble.second and loaded.second_kind == "leafwise"
    compiled = ensemble.compiled(spark, str(tmp_path / "nodes"))
    assert sorted(loaded.score(data).collect()) == sorted(ensemble.score(data).collect())
    both = [{r.TransactionID: r.fraud_score for r in e.score(data).collect()} for e in (ensemble, compiled)]
    assert both[0] == pytest.approx(both[1], abs=1e-12)
    values = trees.shap_values(data.withColumn("raw", compiled.second.raw()), [compiled.second], ["raw"]).collect()
    assert all(r.raw == pytest.approx(r.base_value + sum(r[f"shap_{n}"] for n in ensemble.feature_names)) for r in values)


def test_unknown_learner(spark):
    with pytest.raises(ValueError):
        M.fit_ensemble(spark.createDataFrame([(1, 0.5)], "is_fraud int, a double"), ["a"], second="other")
