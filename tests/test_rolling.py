"""W1-W6 against a plain loop, on ordinary and on divided cards."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from cardmill.operators.rolling import STREAM_FEATURES, rolling_features
from cardmill.sources.tables import transactions
from conftest import SF_SMALL

UTC = dt.timezone.utc
START = dt.datetime(2024, 1, 1, 23, 30, tzinfo=UTC)


def loop_features(rows):
    """Arrival order is (time, id) within a card."""
    out = {}
    history = {}
    for tid, card, amount, c2, at in sorted(rows, key=lambda r: (r[4], r[0])):
        seen = history.setdefault(card, [])
        seen.append((at, amount, c2))

        def since(seconds):
            return [e for e in seen if e[0] >= at - dt.timedelta(seconds=seconds)]

        hour, day = since(3600), since(86400)
        mean = sum(e[1] for e in day) / len(day)
        out[tid] = [
            len(since(60)),
            len(since(300)),
            len(hour),
            sum(e[1] for e in hour),
            sum(e[1] for e in hour) / len(hour),
            mean,
            math.sqrt(sum((e[1] - mean) ** 2 for e in day) / len(day)),
            max(e[1] for e in day),
            sum(e[2] for e in hour),
        ]
    return out


def compare(spark, rows, hot_rows):
    df = spark.createDataFrame(
        rows, "transaction_id bigint, card_id string, amount double, c2 double, event_time timestamp"
    )
    got = {r.transaction_id: [r[name] for name in STREAM_FEATURES] for r in rolling_features(df, hot_rows).collect()}
    expected = loop_features(rows)
    assert got.keys() == expected.keys()
    for tid, values in expected.items():
        assert got[tid] == pytest.approx(values, rel=1e-9, abs=1e-6), tid


def make_rows(seed, n, cards, span_seconds, step):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        card = "hot" if rng.random() < 0.4 else f"c{rng.randrange(cards)}"
        seconds = rng.randrange(0, span_seconds, step) + rng.choice([0, 0, 0.25, 0.999999])
        rows.append((i + 1, card, round(rng.uniform(0.01, 900), 2), float(rng.randrange(5)), START + dt.timedelta(seconds=seconds)))
    return rows


@pytest.mark.parametrize("hot_rows", [10**9, 100, 0])
def test_ties_and_borders(spark, hot_rows):
    # Whole-minute steps put many events exactly on the window borders.
    compare(spark, make_rows(1, 600, 4, 3 * 86400, 60), hot_rows)


@pytest.mark.parametrize("hot_rows", [10**9, 50, 0])
def test_dense_card(spark, hot_rows):
    compare(spark, make_rows(2, 500, 2, 900, 1), hot_rows)


def test_long_gaps(spark):
    compare(spark, make_rows(3, 300, 3, 20 * 86400, 3600), 0)


def test_equal_amounts_have_zero_deviation(spark):
    rows = [(i, "a", 499999.37, 0.0, START + dt.timedelta(seconds=i)) for i in range(1, 300)]
    df = spark.createDataFrame(rows, "transaction_id bigint, card_id string, amount double, c2 double, event_time timestamp")
    assert rolling_features(df).agg(F.max("stddev_amount_24h")).first()[0] == 0.0


def test_dividing_hot_cards_changes_nothing(spark):
    events = transactions(spark, SF_SMALL)
    columns = ["transaction_id", "card_id", *STREAM_FEATURES, "last_updated"]
    plain = rolling_features(events, 10**9).select(columns)
    split = rolling_features(events, 40).select(columns)
    assert plain.count() == events.count()
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_only_hot_cards_are_divided_and_rows_are_shuffled_once(spark):
    plan = rolling_features(transactions(spark, SF_SMALL), 10**9)._jdf.queryExecution().toString()
    assert "Window" in plan and "BroadcastHashJoin" in plan
