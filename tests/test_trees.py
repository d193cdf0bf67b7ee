"""M5 compiled trees, M6 SHAP values."""

import datetime as dt
import random
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmill.operators import training as M
from cardmill.operators import trees
from cardmill.operators.batch import batch_features
from cardmill.plans.queries import FIXED_TREES
from cardmill.sources.tables import transactions
from conftest import SF_SMALL


def random_tree(chance, features, depth):
    """A tree of random splits, with features met again further down."""
    nodes = []

    def grow(level, cover):
        at = len(nodes)
        nodes.append(None)
        if level == depth or cover < 2 or chance.random() < 0.1:
            nodes[at] = (-1, 0.0, -1, -1, chance.uniform(-2, 2), float(cover))
            return at
        part = chance.randrange(1, cover)
        split = chance.randrange(features), chance.uniform(0, 1)
        left, right = grow(level + 1, part), grow(level + 1, cover - part)
        nodes[at] = (*split, left, right, 0.0, float(cover))
        return at

    grow(0, 1000)
    return trees.Tree(chance.uniform(0.1, 2), *map(list, zip(*nodes)))


def value(tree, x, known, node=0):
    """Expected value of a tree when only the features ``known`` are."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        return value(tree, x, known, left if x[f] <= tree.threshold[node] else right)
    parts = [tree.cover[c] / tree.cover[node] * value(tree, x, known, c) for c in (left, right)]
    return sum(parts)


def plain_shap(member, x):
    n = len(member.names)
    score = lambda known: sum(t.weight * value(t, x, known) for t in member.trees)
    out = np.zeros(n)
    for f in range(n):
        for k in range(n):
            for known in combinations([j for j in range(n) if j != f], k):
                out[f] += factorial(k) * factorial(n - k - 1) / factorial(n) * (score({*known, f}) - score(set(known)))
    return out, score(set()), score(set(range(n)))


@pytest.mark.parametrize("tabled", [10, 2])
def test_all_subsets(spark, monkeypatch, tabled):
    monkeypatch.setattr(trees, "TABLED", tabled)
    chance = random.Random(tabled)
    names = [f"f{i}" for i in range(6)]
    member = trees.TreeSet(names, [random_tree(chance, 6, 6) for _ in range(4)])
    points = [[chance.random() for _ in names] for _ in range(12)] + [[float("nan"), 0.1, 0.9, 0.5, 0.2, float("nan")]]
    got = trees.Explainer(member)(np.array(points))
    for x, values in zip(points, got):
        want, base, raw = plain_shap(member, x)
        assert values == pytest.approx(want, abs=1e-9)
        assert base == pytest.approx(member.base()) and raw == pytest.approx(base + values.sum())
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(points)], ["row", *names])
    two = trees.TreeSet(names, FIXED_TREES)
    rows = trees.shap_values(df.withColumn("raw", (member.raw() + two.raw()) / 2), [member, two], ["row", "raw"]).collect()
    assert len(rows) == len(points)
    for r in rows:
        assert r.raw == pytest.approx(r.base_value + sum(r[f"shap_{n}"] for n in names))


def test_stored_nodes(spark, tmp_path):
    member = trees.TreeSet(["a", "b"], FIXED_TREES, "logistic")
    member.write(spark, str(tmp_path / "nodes"))
    assert trees.TreeSet.read(spark, str(tmp_path / "nodes"), ["a", "b"], "logistic") == member
    assert trees.TreeSet(["a"], []).base() == 0
    df = spark.createDataFrame([(1.0, None)], "a double, b double").select(member.raw().alias("r"))
    assert df.first().r == 0.5 * 1.0 + 4.0 * 0 - 0.25 + 0.25 * 0.5  # a missing number goes right


@pytest.fixture(scope="module")
def fitted(spark):
    tx = transactions(spark, SF_SMALL)
    data = M.training_set(tx, batch_features(tx, F.lit(dt.datetime(2024, 2, 1)))).cache()
    return data, M.fit_ensemble(data, M.TRAINING_FEATURES, trees=5, depth=4, second="forest")


def test_compiled_scores_equal_the_models(spark, fitted, tmp_path):
    data, ensemble = fitted
    compiled = ensemble.compiled(spark, str(tmp_path))
    names = ["boosted_score", "second_score", "fraud_score"]
    own = {r.TransactionID: [r[n] for n in names] for r in ensemble.score(data).collect()}
    got = {r.TransactionID: [r[n] for n in names] for r in compiled.score(data).collect()}
    assert set(own) == set(got) and len({tuple(v) for v in got.values()}) > 10
    for key, scores in own.items():
        assert got[key] == pytest.approx(scores, abs=1e-12)
    requests = spark.createDataFrame([("8", 250.0), ("nobody", 250.0)], "card_id string, current_amount double")
    online = batch_features(transactions(spark, SF_SMALL), F.lit(dt.datetime(2024, 2, 1)))
    answers = [sorted(M.score_requests(requests, online, e).collect()) for e in (ensemble, compiled)]
    assert answers[0] == answers[1]
    assert "Python" not in compiled.score(data)._jdf.queryExecution().toString()


def test_importance_of_fitted_members(spark, fitted, tmp_path):
    data, ensemble = fitted
    compiled = ensemble.compiled(spark, str(tmp_path))
    ranking = trees.shap_importance(data, compiled.members, sample_size=200).collect()
    assert sorted(r.feature for r in ranking) == sorted(M.TRAINING_FEATURES)
    assert [r.importance for r in ranking] == sorted((r.importance for r in ranking), reverse=True)
    unused = set(M.TRAINING_FEATURES) - {M.TRAINING_FEATURES[f] for m in compiled.members for t in m.trees for f in t.feature if f >= 0}
    assert all((r.importance == 0) == (r.feature in unused) for r in ranking)
    raw = (compiled.boosted.raw() + compiled.second.raw()) / 2
    values = trees.shap_values(data.withColumn("raw", raw), compiled.members, ["TransactionID", "raw"]).collect()
    for r in values:
        assert r.raw == pytest.approx(r.base_value + sum(r[f"shap_{n}"] for n in M.TRAINING_FEATURES))
