"""O1-O3, S1-S3, S7, S8, S11, S15, A1, P4-P6."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cardmill.functions.columns import normalize_raw_event
from cardmill.operators.batch import batch_features
from cardmill.operators.quality import GateFailed
from cardmill.operators.training import FraudEnsemble
from cardmill.plans import flow
from cardmill.sources import tables as S
from cardmill.sources.sinks import write_lakehouse
from cardmill.streaming.source import file_events, to_messages
from conftest import SF_SMALL

UTC = dt.timezone.utc
RUN = dt.datetime(2024, 2, 1, tzinfo=UTC)

CSV = """TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD,card1,card2,card4,card6,P_emaildomain,addr1,C1,C2,D4,V1
1,0,86400,68.5,W,13926,x,discover,credit,,315,1,1,,9
2,1,86401,29.0,W,2755,x,mastercard,credit,gmail.com,325,1,1,3,9
3,0,691201.5,59.25,,,x,,debit,outlook.com,330,,1,0,9
4,0,691202,100.0,C,13926,x,visa,debit,,,2,5,4,9
"""


@pytest.fixture()
def raw(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(CSV)
    return S.raw_csv(spark, str(tmp_path / "raw.csv"))


def test_csv_scan(spark, raw):
    typed = S.typed_transactions(raw)
    assert typed.dtypes == [
        ("transaction_id", "bigint"),
        ("is_fraud", "int"),
        ("transaction_dt", "double"),
        ("amount", "double"),
        ("card_id", "string"),
        ("addr1", "double"),
        ("d4", "double"),
    ]
    assert [r.transaction_id for r in S.replay_order(raw).select(F.col("TransactionID").alias("transaction_id")).collect()] == [1, 2, 3, 4]
    assert typed.count() == 3 and typed.where("card_id = '13926'").count() == 2
    assert [r.transaction_id for r in S.first_transactions(typed, 2).collect()] == [1, 2]


def test_smallest(spark):
    ids = [i * 70_001 % 1_000_003 for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids + [None]], "id bigint")
    for n in (1, 7, 100, 500, 900):
        assert [r.id for r in S.smallest(df, "id", n).collect()] == sorted(ids)[:n]
    copies = df.unionAll(df)
    assert [r.id for r in S.smallest(copies, "id", 5).collect()] == sorted(ids + ids)[:5]


def test_batch_features_reference_quirks(raw):
    rows = {r.card_id: r for r in batch_features(S.typed_transactions(raw), F.lit(RUN)).collect()}
    card = rows["13926"]
    # All-time figures under windowed names; 691202 - 7 days = 86402 leaves the first row out.
    assert (card.trans_count_30d, card.trans_count_7d, card.distinct_addr_7d) == (2, 1, 1)
    assert (card.avg_amount_30d, card.max_amount_30d, card.days_since_last_trans) == (84.25, 100.0, 4.0)
    assert rows["2755"].trans_count_7d == 0


def test_batch_features_windowed(raw):
    rows = {r.card_id: r for r in batch_features(S.typed_transactions(raw), F.lit(RUN), mode="windowed").collect()}
    assert rows["13926"].distinct_addr_7d == 0 and rows["13926"].days_since_last_trans == 0.0
    assert rows["2755"].days_since_last_trans == pytest.approx((691202 - 86401) / 86400)


def test_normalized_events(spark, raw):
    rows = {r.transaction_id: r for r in normalize_raw_event(raw, 1_700_000_000.0).collect()}
    third = rows[3]
    assert (third.card_id, third.product_cd, third.card_type, third.c1) == ("unknown_card", "W", "unknown", 0.0)
    expected = dt.datetime.fromtimestamp(1_700_000_000.0 + 691201.5 % 86400, UTC).isoformat(timespec="microseconds")
    assert third.timestamp == expected
    assert rows[1].p_emaildomain == "unknown" and rows[1].card_id == "13926"


def test_partitions(spark, raw, tmp_path):
    typed = S.typed_transactions(raw)
    path = str(tmp_path / "lake")
    for day in (1, 2, 2):
        run = dt.datetime(2024, 2, day, tzinfo=UTC)
        write_lakehouse(batch_features(typed, F.lit(run)), path, run)
    assert spark.read.parquet(path).count() == 4
    assert S.partition_days(spark, path) == [(2024, 2, 1), (2024, 2, 2)]
    newest = S.latest_partition(spark, path)
    assert {r.day for r in newest.collect()} == {2}
    assert {r.day for r in S.latest_partition(spark, path, back=1).collect()} == {1}
    assert S.latest_partition(spark, path, back=2).count() == 0
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_audit(spark):
    online = spark.createDataFrame([("a",)], "card_id string")
    assert tuple(flow.audit(online, "a", online, online).first()) == ("PASSED", "PASSED", "PASSED (1 isolated records)")
    assert tuple(flow.audit(online, "b", None, None).first()) == ("READY", "FAILED", "READY")


def test_retrain_decision(spark):
    state = spark.createDataFrame(
        [(True, False, True), (False, True, False), (False, False, True), (False, False, False)],
        "scheduled_run boolean, force_retrain boolean, dataset_drift boolean",
    )
    reasons = [r.trigger_reason for r in flow.retrain_decision(state).collect()]
    assert reasons == [flow.SCHEDULED, flow.SCHEDULED, flow.DRIFT, flow.BASELINE]


def test_whole_flow(spark, tmp_path):
    tx = S.dirtied(S.transactions(spark, SF_SMALL))
    events = tx.where("transaction_id <= 200").select(
        "transaction_id", "card_id", "amount", "c2", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp")
    )
    to_messages(events).select("value").write.text(str(tmp_path / "topic"))
    tables = flow.FlowTables(str(tmp_path / "store"))
    report = flow.run_flow(tx, file_events(spark, str(tmp_path / "topic")), tables, RUN, 0, "8", trees=2, depth=2)
    assert report["step4_verification_audit"]["online_store"] == "PASSED"
    assert report["step4_verification_audit"]["quarantine_store"] == "PASSED (16 isolated records)"
    assert report["step5_drift_monitoring"] == "SKIPPED" and report["ct_trigger_reason"] == flow.BASELINE
    rejected = {r.card_id: r.error_reasons for r in spark.read.parquet(tables.quarantine).collect()}
    assert rejected["unknown_card"] == ["card_id:valid_card_id"] and rejected[""] == ["card_id:non_empty_card_id"]
    # The others are cards whose mean the planted -999.0 made negative.
    assert all("avg_amount_30d:positive" in v for k, v in rejected.items() if k not in ("", "unknown_card"))
    assert FraudEnsemble.load(spark, tables.model).feature_names
    saved = json.loads(spark.read.text(tables.report).first().value)
    assert saved["metrics"]["ensemble"]["confusion_matrix"]

    later = flow.run_flow(
        tx, file_events(spark, str(tmp_path / "topic")), tables, RUN + dt.timedelta(days=1), 1, "8", force_retrain=True, trees=2, depth=2
    )
    assert later["step5_drift_monitoring"] == "SUCCESS" and not later["dataset_drift_detected"]
    assert later["ct_trigger_reason"] == flow.SCHEDULED
    with pytest.raises(GateFailed):
        flow.refresh_batch(tx, tables, RUN, on_fail="halt")
