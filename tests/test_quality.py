"""P1-P3, Q1-Q6, A4, A5."""

import pytest
from pyspark.sql import functions as F

from cardmill.operators import quality as Q

SCHEMA = (
    "card_id string, trans_count_7d bigint, trans_count_30d bigint, avg_amount_30d double, "
    "max_amount_30d double, distinct_addr_7d bigint, days_since_last_trans double"
)
GOOD = ("11556", 3, 12, 150.0, 500.0, 1, 1.5)


def test_valid_row_passes(spark):
    result = Q.gate(spark.createDataFrame([GOOD], SCHEMA))
    assert result.is_valid and result.clean.count() == 1 and result.quarantined.count() == 0


def test_negative_count_is_quarantined(spark):
    bad = ("11556", -5, 12, 150.0, 500.0, 1, 1.5)
    result = Q.gate(spark.createDataFrame([bad], SCHEMA))
    assert not result.is_valid and result.clean.count() == 0
    assert result.quarantined.first()[Q.REASONS] == ["trans_count_7d:not_negative"]


def test_all_failing_checks_are_reported(spark):
    bad = ("unknown_card", -1, 10, -99.0, 50.0, 1, 0.0)
    df = spark.createDataFrame([GOOD, bad], SCHEMA)
    result = Q.gate(df)
    assert result.clean.count() + result.quarantined.count() == 2
    assert sorted(result.quarantined.first()[Q.REASONS]) == [
        "avg_amount_30d:positive",
        "card_id:valid_card_id",
        "trans_count_7d:not_negative",
    ]
    counts = {r.check_name: r.failed_rows for r in Q.failure_counts(df, Q.BATCH_CHECKS).collect()}
    assert counts == {"avg_amount_30d:positive": 1, "card_id:valid_card_id": 1, "trans_count_7d:not_negative": 1}


def test_borders_nulls_and_nan(spark):
    rows = [
        ("a", 0, 0, 500000.0, 500000.0, 0, 0.0),
        ("a", 0, 0, 500000.01, 1.0, 0, 0.0),
        ("a", 0, 0, float("nan"), 1.0, 0, 0.0),
        ("  ", None, 0, 0.0, 1.0, 0, -0.1),
        (None, 0, 0, 1.0, 1.0, 0, 0.0),
    ]
    checked = Q.with_failures(spark.createDataFrame(rows, SCHEMA), Q.BATCH_CHECKS).collect()
    assert [r[Q.REASONS] for r in checked] == [
        [],
        ["avg_amount_30d:at_most_500000"],
        ["avg_amount_30d:not_null"],
        ["card_id:non_empty_card_id", "trans_count_7d:not_null", "avg_amount_30d:positive", "days_since_last_trans:not_negative"],
        ["card_id:not_null"],
    ]


def test_text_columns_are_coerced(spark):
    df = spark.createDataFrame([("1", "3", "x")], "card_id string, trans_count_7d string, trans_count_30d string")
    df = df.selectExpr("*", "1.0D avg_amount_30d", "1.0D max_amount_30d", "1 distinct_addr_7d", "0.0D days_since_last_trans")
    result = Q.gate(df)
    assert result.quarantined.first()[Q.REASONS] == ["trans_count_30d:not_null"]
    assert dict(result.clean.dtypes)["trans_count_7d"] == "bigint"


def test_empty_is_invalid_and_halt_raises(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert not Q.gate(empty).is_valid
    with pytest.raises(Q.GateFailed):
        Q.gate(empty, on_fail="halt")


def test_null_ratio(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (2.0, 3), (4.0, None)], "a double, b int")
    assert df.agg(Q.max_null_ratio(df)).first()[0] == 0.75


def test_stream_events(spark):
    events = [
        (9001, "11556", 120.0),
        (9002, "11556", 350.0),
        (9003, "6056", 95.5),
        (9004, "unknown_card", 100.0),
        (9005, "11556", -500.0),
        (9006, "", 200.0),
        (9007, "   ", 200.0),
        (0, "a", 1.0),
        (9008, "a", float("nan")),
        (9009, None, 1.0),
    ]
    df = spark.createDataFrame(events, "transaction_id bigint, card_id string, amount double")
    assert sorted(r.transaction_id for r in Q.valid_events(df).collect()) == [9001, 9002, 9003]
    assert tuple(Q.validity_counts(df, Q.EVENT_CHECKS).first()) == (3, 7)
    reasons = Q.failing_rows(Q.with_failures(df, Q.EVENT_CHECKS))
    assert reasons.where(F.size(Q.REASONS) > 0).count() == 7
