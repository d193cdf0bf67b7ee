"""M1-M6."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardmill.operators import training as M
from cardmill.operators.batch import batch_features, class_balance, first_per_key, label_summary
from cardmill.sources.tables import transactions
from cardmill.streaming.scoring import scored_table, start_scoring
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def dataset(spark):
    tx = transactions(spark, SF_SMALL)
    return M.training_set(tx, batch_features(tx, F.lit(dt.datetime(2024, 2, 1)))).cache()


@pytest.fixture(scope="module")
def fitted(dataset):
    return M.train_ensemble(dataset, trees=3, depth=3)


def test_training_set(spark, dataset):
    tx = transactions(spark, SF_SMALL)
    assert dataset.columns == ["card_id", "TransactionID", "is_fraud", *M.TRAINING_FEATURES]
    assert dataset.count() == tx.count() == dataset.select("TransactionID").distinct().count()
    row = dataset.first()
    assert row.amount_ratio_30d == row.TransactionAmt / (row.avg_amount_30d + 1.0)
    assert dataset.where("is_amount_gt_30d_max > 0").count() == 0  # the maximum includes the row itself


def test_copies_of_a_transaction_are_dropped(spark):
    tx = transactions(spark, SF_SMALL)
    features = batch_features(tx, F.lit(dt.datetime(2024, 2, 1)))
    assert M.training_set(tx.unionAll(tx), features).count() == tx.count()
    rows = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "c", 1)], "id int, x string, y int")
    assert sorted(map(tuple, first_per_key(rows, "id", "y").collect())) == [(1, "b", 2), (2, "c", 1)]


def test_point_in_time_training_set(spark):
    tx = transactions(spark, SF_SMALL)
    early = batch_features(tx.where("event_time < '2024-01-10'"), F.lit(dt.datetime(2024, 1, 10)))
    rows = M.training_set(tx, early, point_in_time=True)
    assert 0 < rows.count() <= tx.where("event_time >= '2024-01-10'").count()
    assert rows.where("is_amount_gt_30d_max > 0").count() > 0


def test_balance_and_summary(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "is_fraud int")
    assert class_balance(df).first().positive_weight == 3.0
    assert class_balance(df.where("is_fraud = 0")).first().positive_weight == 3.0
    assert tuple(label_summary(df).first()) == (4, 1, 25.0)


def test_blend_of_constant_members(spark):
    df = spark.createDataFrame([(0.8, 0.8), (0.8, 0.8)], "a double, b double")
    rows = M.blended(df, {"a": 0.5, "b": 0.5}).withColumn("p", M.labelled(F.col("fraud_score"), 0.6)).collect()
    assert [(r.fraud_score, r.p) for r in rows] == [(pytest.approx(0.8), 1)] * 2


def test_report(fitted, dataset):
    ensemble, report = fitted
    row = report.first()
    assert (row.dataset_size, row.train_size, row.val_size) == (1000, 800, 200)
    assert row.feature_names == ensemble.feature_names == M.TRAINING_FEATURES
    assert row.threshold_tuning.min_cost <= row.threshold_tuning.cost_at_05
    assert row.optimal_threshold == ensemble.threshold
    for name in ("boosted", "leafwise", "ensemble_default_05", "ensemble_optimal", "ensemble"):
        metric = row.metrics[name]
        assert 0.0 <= metric.roc_auc <= 1.0 and sum(map(sum, metric.confusion_matrix)) == 200


def test_fit_has_tasks_by_rows_not_by_partitions(spark, dataset, monkeypatch):
    seen = []
    fit = M.GBTClassifier.fit
    monkeypatch.setattr(M.GBTClassifier, "fit", lambda self, rows: seen.append(rows) or fit(self, rows))
    M.train_ensemble(dataset.repartition(40), trees=1, depth=2, fit_rows=300, second="forest")
    assert [rows.rdd.getNumPartitions() for rows in seen] == [1]
    assert 200 < seen[0].count() < 400


def test_members_are_fitted_on_all_rows(spark, monkeypatch):
    class Seen(Exception):
        pass

    def fit(self, rows):
        raise Seen(rows.count())

    monkeypatch.setattr(M.GBTClassifier, "fit", fit)
    rows = spark.range(700_000).select(
        F.col("id").alias("TransactionID"), F.lit("a").alias("card_id"), (F.col("id") % 10 == 0).cast("int").alias(M.TARGET), F.lit(1.0).alias(M.AMOUNT)
    )
    with pytest.raises(Seen) as seen:
        M.train_ensemble(rows, trees=1, depth=1, second="forest")
    assert seen.value.args == (560_000,)


def test_scoring_and_save(spark, fitted, dataset, tmp_path):
    ensemble, _ = fitted
    ensemble.save(spark, str(tmp_path / "model"))
    loaded = M.FraudEnsemble.load(spark, str(tmp_path / "model"))
    online = batch_features(transactions(spark, SF_SMALL), F.lit(dt.datetime(2024, 2, 1)))
    requests = spark.createDataFrame([("8", 250.0), ("nobody", 250.0)], "card_id string, current_amount double")
    one = {r.card_id: r for r in M.score_requests(requests, online, ensemble).collect()}
    two = {r.card_id: r for r in M.score_requests(requests, online, loaded).collect()}
    assert one == two
    for r in one.values():
        assert r.decision == (M.ALERT if r.is_fraud else M.APPROVED)
        assert r.is_fraud == int(r.fraud_score >= r.decision_threshold)
    assert one["nobody"].features_used["avg_amount_30d"] == 150.0


def test_scoring_a_stream(spark, fitted, tmp_path):
    ensemble, _ = fitted
    online = batch_features(transactions(spark, SF_SMALL), F.lit(dt.datetime(2024, 2, 1)))
    spark.createDataFrame([("8", 250.0), ("nobody", 2.0)], "card_id string, current_amount double").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("card_id string, current_amount double").json(str(tmp_path / "in"))
    start_scoring(stream, lambda _: online, ensemble, str(tmp_path / "out")).awaitTermination(120)
    rows = scored_table(spark, stream.schema, str(tmp_path / "out")).collect()
    assert {r.card_id for r in rows} == {"8", "nobody"} and {r.decision for r in rows} <= {M.ALERT, M.APPROVED}


def test_importance(fitted, dataset):
    ensemble, _ = fitted
    ranking = M.feature_importance(dataset, ensemble, sample_size=300).collect()
    assert sorted(r.feature for r in ranking) == sorted(M.TRAINING_FEATURES)
    assert ranking[0].importance > 0.0
    assert [r.importance for r in ranking] == sorted((r.importance for r in ranking), reverse=True)
