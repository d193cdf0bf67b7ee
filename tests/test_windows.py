"""A1 from stored days, Q7 as a distance and from stored sketches."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmill.operators import drift
from cardmill.operators.batch import BATCH_FEATURES, batch_features
from cardmill.operators.windows import DayPartials, day_number

RUN = dt.datetime(2024, 3, 1)
SCHEMA = "transaction_id long, card_id string, amount double, transaction_dt double, addr1 double, d4 double"


def rows_of(seed, n, days):
    chance = random.Random(seed)
    cards = ["hot"] * 6 + ["a", "b", "c", None]
    return [
        (
            None if chance.random() < 0.02 else i,
            chance.choice(cards) if i % 97 else f"once{i}",
            chance.choice([None, 0.1, 0.2, 1e-25, float(chance.randrange(1, 10_000)) / 100]),
            19_000 * 86_400 + chance.random() * days * 86_400,
            chance.choice([None, *map(float, range(60))]),
            1.0,
        )
        for i in range(n)
    ]


def stored(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).withColumn("day", day_number()).write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def table(df):
    return {r.card_id: tuple(r[f] for f in BATCH_FEATURES) for r in df.collect()}


def test_daily_runs_equal_all_rows(spark, tmp_path):
    raw = stored(spark, rows_of(1, 3000, 40), str(tmp_path / "raw"))
    partials = DayPartials(str(tmp_path / "partials"))
    partials.update(raw.where("day < 19030"), 0)
    for run, day in enumerate(range(19030, 19040), 1):
        partials.update(raw.where(F.col("day") == day), run, run - 1)
        if day in (19033, 19039):
            partials.update(raw.where(F.col("day") == day), run, run - 1)  # again, after a failure
            got = partials.features(spark, raw, run, F.lit(RUN))
            want = table(batch_features(raw.where(F.col("day") <= day), F.lit(RUN), mode="windowed"))
            mine = table(got)
            assert set(mine) == set(want) and len(mine) > 10
            for card, values in want.items():
                assert mine[card] == pytest.approx(values, rel=1e-12), card


def test_a_run_reads_two_days_of_rows(spark, tmp_path):
    raw = stored(spark, rows_of(2, 800, 40), str(tmp_path / "raw"))
    partials = DayPartials(str(tmp_path / "partials"))
    partials.update(raw, 0)
    files = partials.features(spark, raw, 0, F.lit(RUN)).inputFiles()
    assert any("/raw/" in f for f in files)
    features = partials.features(spark, raw, 0, F.lit(RUN))
    plan = features._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line and "/raw" in line]
    assert len(scans) == 2 and all("day#" in line.split("PartitionFilters")[1].split("]")[0] for line in scans)


def test_no_rows(spark, tmp_path):
    raw = stored(spark, rows_of(3, 5, 1), str(tmp_path / "raw"))
    partials = DayPartials(str(tmp_path / "partials"))
    partials.update(raw.where("card_id = 'nobody'"), 0)
    assert partials.features(spark, raw, 0, F.lit(RUN)).count() == 0


def two_sides(spark):
    rng = np.random.default_rng(5)
    sides = []
    for shift in (0.0, 0.3):
        x, y = rng.normal(shift, 1, 5000), rng.integers(0, 5, 5000).astype(float)
        sides.append((x, y, spark.createDataFrame(list(zip(range(5000), x.tolist(), y.tolist())), "id long, x double, y double")))
    return sides


def test_distance(spark):
    (x1, y1, a), (x2, y2, b) = two_sides(spark)
    got = {r.column_name: r for r in drift.distance_drift(a, b, ["x", "y"]).collect()}
    for name, r, c in (("x", x1, x2), ("y", y1, y2)):
        at = np.sort(np.concatenate([r, c]))
        shares = [np.searchsorted(np.sort(v), at[:-1], side="right") / len(v) for v in (r, c)]
        want = (np.abs(shares[0] - shares[1]) * np.diff(at)).sum() / r.std()
        assert got[name].drift_score == pytest.approx(want)
    assert got["x"].drift_detected and not got["y"].drift_detected
    same = drift.distance_drift(a.select(F.lit(1.0).alias("k")), b.select(F.lit(1.0).alias("k"))).first()
    assert same.drift_score == 0.0 and not same.drift_detected


def test_sketches_of_days(spark):
    (_, _, a), (_, _, b) = two_sides(spark)
    exact = {r.column_name: r.drift_score for r in drift.column_drift(a, b, ["x", "y"]).collect()}
    day = F.pmod("id", F.lit(7)).alias("day")
    sketches = [drift.day_sketches(df.select("*", day), ["x", "y"], "day") for df in (a, b)]
    assert sketches[0].count() == 14
    got = {r.column_name: r for r in drift.sketch_drift(*sketches).collect()}
    for name, score in exact.items():
        assert got[name].drift_score == pytest.approx(score, abs=0.015)
    assert got["x"].drift_detected
