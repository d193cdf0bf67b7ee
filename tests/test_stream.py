"""S4, S5, S9, S10, S13, T1-T5 on file streams."""

import datetime as dt
import json
import os
import random
import time

import pytest

from cardmill.operators.quality import REASONS
from cardmill.operators.rolling import STREAM_FEATURES, rolling_features
from cardmill.sources.sinks import OnlineTable
from cardmill.streaming.features import FeatureBatch, ProgressLog, StreamTables, VECTOR_SCHEMA, start_features
from cardmill.streaming.source import file_events, parsed_events, quarantine_messages, to_messages

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 7, 28, 12, 0, tzinfo=UTC)


def event(tid, card, amount, seconds=0, **extra):
    at = (T0 + dt.timedelta(seconds=seconds)).isoformat().replace("+00:00", "Z")
    return {"transaction_id": tid, "card_id": card, "amount": amount, "timestamp": at, **extra}


def write(folder, number, events):
    folder.mkdir(exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
    path = folder / f"part-{number:03d}.json"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))  # files are read in time order


def run(spark, folder, root, files_per_batch=1000, **options):
    tables = StreamTables(str(root))
    start_features(file_events(spark, str(folder), files_per_batch), tables, **options).awaitTermination(300)
    return tables


class Watched(FeatureBatch):
    """Notes which share of the parsed events is stored when the work on them begins."""

    def _placed(self, parsed, batch_id):
        stored = parsed.sparkSession._jsc.sc().getRDDStorageInfo()
        self.stored = max([i.numCachedPartitions() / i.numPartitions() for i in stored] + [0])
        return super()._placed(parsed, batch_id)


def test_events_are_parsed_before_several_stages_read_them(spark, tmp_path):
    spark.catalog.clearCache()
    write(tmp_path / "in", 1, SAMPLES)
    batch = Watched(StreamTables(str(tmp_path / "out")))
    parsed = parsed_events(file_events(spark, str(tmp_path / "in")))
    stream = parsed.writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / "checkpoint"))
    stream.trigger(availableNow=True).start().awaitTermination(120)
    assert batch.stored == 1.0


def wait_until(condition, seconds=20):
    deadline = time.time() + seconds
    while not condition() and time.time() < deadline:
        time.sleep(0.1)


SAMPLES = [
    event(9001, "11556", 120.0, 0, c1=1.0, c2=2.0),
    event(9002, "11556", 350.0, 1, c1=2.0, c2=4.0),
    event(9003, "6056", 95.5, 2, c1=1.0, c2=1.0),
    event(9004, "unknown_card", 100.0, 3),
    event(9005, "11556", -500.0, 4),
    event(9006, "", 200.0, 5),
    event(9007, None, 200.0, 6),
    "{not json",
    {"transaction_id": 9009, "card_id": "1", "amount": 1.0, "timestamp": "yesterday"},
]


def test_good_and_bad_events(spark, tmp_path, caplog):
    write(tmp_path / "in", 1, SAMPLES)
    progress = ProgressLog()
    spark.streams.addListener(progress)
    with caplog.at_level("INFO", logger="cardmill.stream"):
        tables = run(spark, tmp_path / "in", tmp_path / "out", rounded=True)
        wait_until(lambda: "ended" in caplog.text)
    spark.streams.removeListener(progress)
    assert "batch 0: 3 valid, 6 corrupt" in caplog.text
    vectors = {r.transaction_id: r for r in tables.vectors.read(spark).collect()}
    assert sorted(vectors) == [9001, 9002, 9003]
    second = vectors[9002]
    assert (second.trans_count_1m, second.total_amount_1h, second.c2_count_sum_1h) == (2, 470.0, 6.0)
    assert (second.avg_amount_24h, second.stddev_amount_24h, second.max_amount_24h) == (235.0, 115.0, 350.0)
    bad = tables.quarantine.read(spark)
    reasons = {r.transaction_id: r[REASONS] for r in bad.collect()}
    assert reasons[None] == ["malformed_json"] and reasons[9009] == ["bad_timestamp"]
    assert reasons[9004] == ["card_id:valid_card_id"] and reasons[9005] == ["amount:positive"]
    assert len(reasons) == 6
    assert tables.archive.read(spark).count() == 3
    online = {r.card_id: r.transaction_id for r in tables.online.read(spark).collect()}
    assert online == {"11556": 9002, "6056": 9003}
    assert {r.key for r in quarantine_messages(bad).collect()} >= {"bad_event", "unknown_card"}


def in_order_events(n, seed=3):
    rng = random.Random(seed)
    seconds = 0.0
    out = []
    for i in range(n):
        seconds += rng.choice([0, 0.5, 30, 600, 4000])
        out.append(event(i + 1, rng.choice(["hot", "hot", "a", "b"]), round(rng.uniform(1, 500), 2), seconds, c2=float(rng.randrange(4))))
    return out


@pytest.mark.parametrize("hot_rows", [10**9, 20])
def test_stream_in_batches_equals_batch(spark, tmp_path, hot_rows):
    events = in_order_events(240)
    for number, start in enumerate(range(0, 240, 80)):
        write(tmp_path / "in", number, events[start : start + 80])
    tables = run(spark, tmp_path / "in", tmp_path / "out", files_per_batch=1, hot_rows=hot_rows)
    assert tables.vectors.numbers(spark) == [0, 1, 2]
    columns = ["transaction_id", "card_id", *STREAM_FEATURES, "last_updated"]
    got = tables.vectors.read(spark).select(columns)
    raw = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    expected = rolling_features(parsed_events(raw)).select(columns)
    assert got.count() == 240
    assert got.exceptAll(expected).count() == 0


def test_restart_continues_with_history(spark, tmp_path):
    write(tmp_path / "in", 1, [event(1, "a", 10.0, 0)])
    run(spark, tmp_path / "in", tmp_path / "out")
    write(tmp_path / "in", 2, [event(2, "a", 30.0, 10)])
    tables = run(spark, tmp_path / "in", tmp_path / "out")
    latest = tables.online.read(spark).first()
    assert (latest.transaction_id, latest.trans_count_1m, latest.avg_amount_24h) == (2, 2, 20.0)


def test_the_cut_into_batches_changes_nothing(spark, tmp_path, cut=4):
    chance = random.Random(8)
    events, clock = [], 0.0
    for i in range(120):
        clock += chance.choice([0, 0, 1, 30])
        behind = chance.choice([0, 0, 0, 2, 5, 6, 600])
        events.append(event(i + 1, chance.choice("ab"), float(chance.randint(1, 99)), clock - behind))
    results = []
    for parts in (1, cut):
        size = -(-len(events) // parts)
        for number in range(parts):
            write(tmp_path / f"in{parts}", number, events[number * size : (number + 1) * size])
        tables = run(spark, tmp_path / f"in{parts}", tmp_path / f"out{parts}", files_per_batch=1)
        vectors = tables.vectors.read(spark).drop("batch_id")
        late = tables.quarantine.read(spark).select("transaction_id", REASONS)
        results.append((sorted(map(str, vectors.collect())), sorted(map(str, late.collect()))))
    assert results[0][1] and results[0] == results[1]


def test_only_needed_days_are_listed(spark, tmp_path):
    tables = StreamTables(str(tmp_path / "out"))
    archive = tables.archive
    row = {"transaction_id": 1, "card_id": "a", "amount": 1.0, "late": False}
    for number in range(4):
        day = T0.date() + dt.timedelta(days=number)
        df = spark.createDataFrame([{**row, "event_date": day}], "transaction_id bigint, card_id string, amount double, late boolean, event_date date")
        archive.write(df, number, ("event_date",))
    wanted = [str(T0.date() + dt.timedelta(days=n)) for n in (2, 3)]
    assert archive.days(spark)[2:] == wanted
    files = archive.read_days(spark, wanted, before=3).inputFiles()
    assert len(files) == 1 and wanted[0] in files[0]


def test_stray_days(spark, tmp_path):
    write(tmp_path / "in", 1, [event(1, "a", 10.0, 0)])
    run(spark, tmp_path / "in", tmp_path / "out")
    write(tmp_path / "in", 2, [event(2, "a", 30.0, 86_400), event(3, "a", 50.0, 200_000)])
    tables = run(spark, tmp_path / "in", tmp_path / "out")
    means = {r.transaction_id: r.avg_amount_24h for r in tables.vectors.read(spark).collect()}
    assert means == {1: 10.0, 2: 20.0, 3: 50.0}


def test_late_events_are_quarantined_and_do_not_count(spark, tmp_path):
    write(tmp_path / "in", 1, [event(1, "a", 10.0, 100), event(2, "b", 10.0, 0)])
    run(spark, tmp_path / "in", tmp_path / "out")
    write(tmp_path / "in", 2, [event(3, "a", 5.0, 94.9), event(4, "a", 5.0, 95.0), event(5, "a", 7.0, 101), event(6, "b", 1.0, 3)])
    tables = run(spark, tmp_path / "in", tmp_path / "out")
    late = tables.quarantine.read(spark).collect()
    assert [(r.transaction_id, r[REASONS]) for r in late] == [(3, ["late_event"])]
    vectors = {r.transaction_id: r.trans_count_1m for r in tables.vectors.read(spark).collect()}
    assert vectors == {1: 1, 2: 1, 4: 2, 5: 3, 6: 2}
    assert tables.archive.read(spark).where("late").count() == 1


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    tables = StreamTables(str(tmp_path / "out"))
    handler = FeatureBatch(tables)

    def batch(events):
        return parsed_events(spark.createDataFrame([(json.dumps(e),) for e in events], "value string"))

    first, second = in_order_events(40)[:20], in_order_events(40)[20:]
    handler(batch(first), 0)
    handler(batch(second), 1)
    before = sorted(map(tuple, tables.vectors.read(spark).collect()))
    handler(batch(second), 1)
    assert sorted(map(tuple, tables.vectors.read(spark).collect())) == before
    assert tables.archive.read(spark).count() == 40
    assert tables.quarantine.read(spark).count() == 0


def test_batch_work_is_planned_adaptively(spark, tmp_path):
    write(tmp_path / "in", 1, SAMPLES)
    seen = []

    class Spy(FeatureBatch):
        def _vectors(self, on_time, batch_id):
            vectors = super()._vectors(on_time, batch_id)
            seen.append(vectors._jdf.queryExecution().executedPlan().toString().splitlines()[0])
            return vectors

    raw = file_events(spark, str(tmp_path / "in"))
    tables = StreamTables(str(tmp_path / "out"))
    parsed_events(raw).writeStream.foreachBatch(Spy(tables)).option("checkpointLocation", tables.checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination(120)
    assert seen and seen[0].startswith("AdaptiveSparkPlan")


def test_online_table_compacts(spark, tmp_path):
    table = OnlineTable(str(tmp_path / "t"), VECTOR_SCHEMA, "card_id", ("last_updated", "transaction_id"), compact_every=2)

    def rows(*pairs):
        zeros = [0, 0, 0] + [0.0] * 6
        return spark.createDataFrame([(tid, card, *zeros, T0 + dt.timedelta(seconds=tid)) for tid, card in pairs], VECTOR_SCHEMA)

    assert table.read(spark).count() == 0
    for batch_id, pairs in enumerate([[(1, "a"), (2, "b")], [(3, "a")], [(4, "c"), (5, "a")]]):
        table.upsert(rows(*pairs), batch_id)
        table.compact_if_due(spark, batch_id)
    assert table.base.numbers(spark) == [1]
    assert {r.card_id: r.transaction_id for r in table.read(spark).collect()} == {"a": 5, "b": 2, "c": 4}
    assert {r.card_id: r.transaction_id for r in table.read(spark, before=2).collect()} == {"a": 3, "b": 2}
    for batch_id in (3, 4, 5):
        table.upsert(rows((10 + batch_id, "d")), batch_id)
        table.compact_if_due(spark, batch_id)
    assert table.base.numbers(spark) == [3, 5] and min(table.delta.numbers(spark)) == 4 and table.next_number(spark) == 6
    assert {r.card_id: r.transaction_id for r in table.read(spark).collect()} == {"a": 5, "b": 2, "c": 4, "d": 15}


def test_messages_round_trip(spark):
    events = spark.createDataFrame([(1, "a", 2.5, "2026-07-28T12:00:00Z")], "transaction_id bigint, card_id string, amount double, timestamp string")
    back = parsed_events(to_messages(events).select("value")).first()
    assert back[REASONS] == [] and back.event_time is not None and back.amount == 2.5
