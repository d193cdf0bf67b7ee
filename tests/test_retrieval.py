"""J3-J5, E3-E9, W8, W9."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardmill.operators import retrieval as R

UTC = dt.timezone.utc
T0 = dt.datetime(2024, 3, 1, tzinfo=UTC)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("hot_rows", [10**9, 30, 0])
@pytest.mark.parametrize("step", [1, 60, 7200])
def test_point_in_time_matches_loop(spark, hot_rows, step):
    rng = random.Random(step)
    cards = ["hot", "hot", "a", "b"]
    entities = [(i, rng.choice(cards), at(rng.randrange(200) * step)) for i in range(200)]
    history = [(rng.choice(cards[:3]), at(rng.randrange(200) * step), i) for i in range(150)]
    ttl = 20 * step
    edf = spark.createDataFrame(entities, "id int, card_id string, ts timestamp")
    hdf = spark.createDataFrame(history, "card_id string, fts timestamp, v int")
    got = R.point_in_time_join(edf, hdf, ["v"], "card_id", "ts", "fts", ttl, hot_rows=hot_rows)
    assert got.columns == ["id", "card_id", "ts", "v"]
    found = {r.id: r.v for r in got.collect()}
    assert len(found) == len(entities)
    for i, card, when in entities:
        seen = [(fts, v) for c, fts, v in history if c == card and when - dt.timedelta(seconds=ttl) <= fts <= when]
        assert found[i] == (max(seen)[1] if seen else None), i


def test_point_in_time_keeps_entities_without_card(spark):
    edf = spark.createDataFrame([(1, None, at(0)), (2, "a", at(5))], "id int, card_id string, ts timestamp")
    hdf = spark.createDataFrame([("a", at(5), 9.0)], "card_id string, fts timestamp, v double")
    rows = R.point_in_time_join(edf, hdf, ["v"], "card_id", "ts", "fts", 60).collect()
    assert {r.id: r.v for r in rows} == {1: None, 2: 9.0}


@pytest.mark.parametrize("hot_rows", [10**9, 30, 0])
def test_several_histories_match_loop(spark, hot_rows):
    rng = random.Random(7)
    cards = ["hot", "hot", "a", None]
    entities = [(i, rng.choice(cards), at(rng.randrange(300) * 20)) for i in range(200)]
    sides = [[(rng.choice(["hot", "a", "b", None]), at(rng.randrange(300) * 20), i) for i in range(n)] for n in (120, 40, 0)]
    ttls = [600, 3000, 100]
    edf = spark.createDataFrame(entities, "id int, card_id string, ts timestamp")
    histories = [
        R.History(spark.createDataFrame(rows, "card_id string, t timestamp, v int"), "t", ttl, ["v"], [f"v{n}"], f"m{n}")
        for n, (rows, ttl) in enumerate(zip(sides, ttls))
    ]
    got = R.point_in_time_views(edf, histories, "card_id", "ts", hot_rows=hot_rows)
    assert got.columns == ["id", "card_id", "ts", "v0", "m0", "v1", "m1", "v2", "m2"]
    found = {r.id: r for r in got.collect()}
    assert len(found) == len(entities)
    for i, card, when in entities:
        for n, (rows, ttl) in enumerate(zip(sides, ttls)):
            seen = [(t, v) for c, t, v in rows if c is not None and c == card and t <= when]
            last = max(seen) if seen and max(seen)[0] >= when - dt.timedelta(seconds=ttl) else None
            assert (found[i][f"v{n}"], found[i][f"m{n}"]) == (last and last[1], last is not None), (i, n)


def test_several_views_shuffle_entities_once(spark):
    entities = spark.createDataFrame([("a", at(5))], "card_id string, event_timestamp timestamp")
    history = spark.createDataFrame([("a", at(1), 1)], "card_id string, t timestamp, v int")

    def windows(n):
        sides = [R.History(history, "t", 60, ["v"], [f"v{i}"]) for i in range(n)]
        plan = R.point_in_time_views(entities, sides, "card_id", "event_timestamp")._jdf.queryExecution().sparkPlan().toString()
        return sum(line.lstrip(" :+-").startswith("Window") for line in plan.split("\n"))

    assert windows(1) == windows(3)


def batch_rows(spark):
    return spark.createDataFrame(
        [("11556", at(0), 3, 12, 150.0, 500.0, 1, 1.5), ("11556", at(9), 4, 13, 99.0, 400.0, 2, float("nan"))],
        "card_id string, event_timestamp timestamp, trans_count_7d bigint, trans_count_30d bigint, "
        "avg_amount_30d double, max_amount_30d double, distinct_addr_7d bigint, days_since_last_trans double",
    )


def test_historical_features_by_name(spark):
    entities = spark.createDataFrame([("11556", at(5)), ("11556", at(9)), ("x", at(9))], "card_id string, event_timestamp timestamp")
    names = ["card_batch_features:trans_count_7d", "card_batch_features:max_amount_30d"]
    got = R.historical_features(entities, names, {"card_batch_features": batch_rows(spark)})
    rows = {(r.card_id, r.event_timestamp.second): (r.trans_count_7d, r.max_amount_30d) for r in got.collect()}
    assert rows == {("11556", 5): (3, 500.0), ("11556", 9): (4, 400.0), ("x", 9): (None, None)}
    with pytest.raises(ValueError):
        R.historical_features(entities, ["card_batch_features:nope"], {})


def test_historical_names_must_differ(spark):
    entities = spark.createDataFrame([("11556", at(5), 1)], "card_id string, event_timestamp timestamp, trans_count_7d int")
    names, sources = ["card_batch_features:trans_count_7d"], {"card_batch_features": batch_rows(spark)}
    with pytest.raises(ValueError):
        R.historical_features(entities, names, sources)
    row = R.historical_features(entities, names, sources, full_names=True).first()
    assert (row["trans_count_7d"], row["card_batch_features__trans_count_7d"]) == (1, 3)


def test_materialize_takes_newest_in_range(spark):
    history = batch_rows(spark)
    assert R.materialize(history, R.CARD_BATCH, at(0), at(5)).first().trans_count_7d == 3
    assert R.materialize(history, R.CARD_BATCH, at(0), at(99)).first().trans_count_7d == 4


def test_lookup_defaults_per_feature(spark):
    requests = spark.createDataFrame([("11556", 250.0), ("new", 10.0)], "card_id string, current_amount double")
    online = R.materialize(batch_rows(spark), R.CARD_BATCH, at(0), at(99))
    rows = {r.card_id: r for r in R.with_lookup_defaults(requests, online).collect()}
    assert rows["11556"].avg_amount_30d == 99.0
    assert rows["11556"].days_since_last_trans == 2.0  # NaN is replaced like null
    assert [rows["new"][name] for name in R.LOOKUP_DEFAULTS] == [1.0, 5.0, 150.0, 500.0, 1.0, 2.0]


def test_online_features_and_on_demand(spark):
    requests = spark.createDataFrame([("11556", 250.0), ("new", 10.0)], "card_id string, current_amount double")
    stream = spark.createDataFrame(
        [("11556", at(3), 1, 3, 4, 40.0, 10.0, 99.0, 9.99, 120.0, 2.0)],
        "card_id string, last_updated timestamp, " + ", ".join(f"{n} double" for n in R.STREAM_FEATURES).replace("trans_count_1m double", "trans_count_1m bigint").replace("trans_count_5m double", "trans_count_5m bigint").replace("trans_count_1h double", "trans_count_1h bigint"),
    )
    online = {"card_batch_features": R.materialize(batch_rows(spark), R.CARD_BATCH, at(0), at(99)), "card_stream_features": stream}
    rows = {r.card_id: r for r in R.online_features(requests, online).collect()}
    hit, miss = rows["11556"], rows["new"]
    assert hit.amount_ratio_24h == 250.0 / 100.0 and hit.amount_ratio_30d == 250.0 / 100.0
    assert hit.amount_zscore_24h == pytest.approx((250.0 - 99.0) / 10.0)
    assert (hit.is_amount_gt_30d_max, hit.is_high_velocity_5m) == (0.0, 1.0)
    assert (miss.amount_ratio_24h, miss.amount_zscore_24h, miss.is_amount_gt_30d_max) == (10.0, 1000.0, 1.0)
    names = ["card_batch_features:avg_amount_30d", "card_on_demand_features:amount_ratio_24h"]
    assert R.online_features(requests, online, names).columns == ["card_id", "current_amount", "avg_amount_30d", "amount_ratio_24h"]


def test_latest_per_key_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 5), ("a", 2, 4)], "card_id string, t int, id int")
    assert R.latest_per_key(df, "card_id", "t", "id").first().id == 5
    assert R.lookup(df, "a").agg(F.count("*")).first()[0] == 3
