"""T1, T2, T4, A6 with keyed state, against plain sums over each card's events."""

import random

import numpy as np
import pytest
from pyspark.sql import Row

from cardmill.operators.rolling import STREAM_FEATURES
from cardmill.streaming import stateful
from cardmill.streaming.features import StreamTables
from cardmill.streaming.source import file_events
from test_stream import SAMPLES, event, write


def run(spark, folder, root, files=1000, **options):
    tables = StreamTables(str(root))
    query = stateful.start_stateful(file_events(spark, str(folder), files), tables, **options)
    query.awaitTermination(300)
    return tables, query


def vectors(spark, tables):
    return {r["transaction_id"]: tuple(r[f] for f in STREAM_FEATURES) for r in tables.vectors.read(spark).collect()}


def expected(arrivals):
    """Vectors of events in order of arrival, and ids of the late ones."""
    cards, out, late = {}, {}, set()
    for e, seconds in arrivals:
        own = cards.setdefault(e["card_id"], [])
        newest = max((t for t, *_ in own), default=seconds)
        if seconds < newest - 5:
            late.add(e["transaction_id"])
            continue
        at = max(seconds, newest)
        own.append((at, e["amount"], e.get("c2", 0.0)))

        def since(window):
            return [x for x in own if x[0] >= at - window]

        hour, day = since(3600), since(86_400)
        amounts = [a for _, a, _ in day]
        out[e["transaction_id"]] = (
            len(since(60)), len(since(300)), len(hour), sum(a for _, a, _ in hour), sum(a for _, a, _ in hour) / len(hour),
            sum(amounts) / len(day), float(np.std(amounts)), max(amounts), sum(c for *_, c in hour),
        )
    return out, late


def random_arrivals(seed, n, span):
    """Events of few cards in files of rising time, some a little or far behind."""
    chance = random.Random(seed)
    rows, clock, last = [], 0, 0
    for i in range(n):
        clock += chance.choice([0, 0, 1, 7, 60, 300, span])
        seconds = clock - chance.choice([0, 0, 0, 0, 3, 5, 6, 400])
        card = chance.choice(["hot", "hot", "hot", "a", "b"])
        if i and i % 60 == 0:  # the first of a file
            card, seconds, clock = "hot", last - 400, last
        last = max(clock, seconds) if card == "hot" else last
        rows.append((event(i + 1, card, chance.randrange(1, 90_000) / 100, seconds, c2=float(chance.randrange(9))), seconds))
    return rows


def near(got, want):
    assert set(got) == set(want)
    for i, values in want.items():
        assert got[i] == pytest.approx(values, rel=1e-9, abs=1e-6), i


@pytest.mark.parametrize("files,hot", [(1, {}), (1, {"hot": 3, "a": 2}), (5, {"hot": 4})])
def test_vectors_and_late_events(spark, tmp_path, files, hot):
    """However arrivals are cut and however many keys a card has. A file's events go by time."""
    arrivals = random_arrivals(3, 300, 5000)
    slices = [arrivals[i : i + 60] for i in range(0, len(arrivals), 60)]
    for number, own in enumerate(slices):
        write(tmp_path / "in", number, [e for e, _ in own])
    tables, query = run(spark, tmp_path / "in", tmp_path / "out", files, hot=hot, grace="30 days")
    want, late = expected([row for own in slices for row in sorted(own, key=lambda r: (r[1], r[0]["transaction_id"]))])
    near(vectors(spark, tables), want)
    archived = {r.transaction_id: r.late for r in tables.archive.read(spark).collect()}
    assert {i for i, is_late in archived.items() if is_late} == late
    assert set(archived) == set(want) | late
    assert late and {r.transaction_id for r in tables.quarantine.read(spark).collect()} == late
    newest = {r.card_id: r.transaction_id for r in tables.online.read(spark).collect()}
    assert set(newest) == {"hot", "a", "b"}


def test_restart_and_changed_settings(spark, tmp_path):
    """A stream that goes on has its state; the hot cards are those it began with."""
    arrivals = [r for r in random_arrivals(4, 200, 900)]
    slices = [sorted(arrivals[i : i + 40], key=lambda r: (r[1], r[0]["transaction_id"])) for i in range(0, 200, 40)]
    want, _ = expected([row for own in slices for row in own])
    for number, own in enumerate(slices):
        write(tmp_path / "in", number, [e for e, _ in own])
        tables, _ = run(spark, tmp_path / "in", tmp_path / "out", 1, hot={"hot": 2} if number == 0 else {"b": 5}, grace="30 days")
    near(vectors(spark, tables), want)


def test_bad_events_pass_and_repeats_go(spark, tmp_path):
    write(tmp_path / "in", 1, [*SAMPLES, SAMPLES[0]])
    write(tmp_path / "in", 2, [SAMPLES[1], event(9010, "11556", 5.0, 3)])
    tables, _ = run(spark, tmp_path / "in", tmp_path / "out", 1, once=True)
    got = vectors(spark, tables)
    assert set(got) == {9001, 9002, 9003, 9010} and got[9010][0] == 3
    assert tables.archive.read(spark).count() == 4
    assert tables.quarantine.read(spark).count() == len(SAMPLES) - 3


def test_repeats_are_looked_for_among_the_columns_needed(spark, tmp_path):
    write(tmp_path / "in", 1, SAMPLES)
    raw = file_events(spark, str(tmp_path / "in"))
    plan = stateful.questions(raw, {}, once=True)._jdf.queryExecution().analyzed().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "DeduplicateWithinWatermark" in line)
    assert "AS same" in plan[at + 1] and "card_type" not in plan[at + 1]


def test_state_goes_and_far_events_are_counted(spark, tmp_path):
    """A card's state goes when the watermark is a day past it; what the watermark drops is counted."""
    day = 86_400
    write(tmp_path / "in", 1, [event(i, f"c{i}", 10.0, i) for i in range(1, 21)])
    for number in range(2, 6):
        write(tmp_path / "in", number, [event(100 + number, "z", 10.0, number * day)])
    write(tmp_path / "in", 6, [event(200, "c1", 10.0, 60), event(201, "z", 1.0, 5 * day + 9)])
    tables, query = run(spark, tmp_path / "in", tmp_path / "out", 1, grace="1 hour")
    assert set(vectors(spark, tables)) == {*range(1, 21), *range(102, 106), 201}
    assert stateful.dropped_late(query) == 1
    keys = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress]
    assert keys[-1] < max(keys) / 3


def test_batch_reads_no_archive(spark, tmp_path, monkeypatch):
    from cardmill.sources.sinks import BatchParts

    monkeypatch.setattr(BatchParts, "read_days", None)
    write(tmp_path / "in", 1, SAMPLES)
    tables, _ = run(spark, tmp_path / "in", tmp_path / "out")
    assert len(vectors(spark, tables)) == 3


class Kept:
    """State of one key in memory, with the number of calls."""

    def __init__(self):
        self.calls, self.value, self.map = 0, None, {}
        self.state = stateful.CardState()
        self.state.init(self)

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def _called(self, out=None):
        self.calls += 1
        return out

    def get(self):
        return self._called(self.value)

    def update(self, value):
        self.value = self._called(value)

    def getValue(self, key):
        return self._called(self.map[key])

    def updateValue(self, key, value):
        self.map[key] = self._called(value)

    def removeKey(self, key):
        del self.map[self._called(key)]

    def registerTimer(self, _):
        self._called()

    deleteTimer = registerTimer

    def batch(self, events):
        names = ["arrived_at", "arrived_in", "arrived_no", "t", "transaction_id", "value", "own", "shares", "amt", "c2", "amount", "ok"]
        rows = [
            Row(*names)(0, "", e["transaction_id"], at * 10**6, e["transaction_id"], "", True, 1, round(e["amount"] * 1e4), round(e["c2"] * 1e4), e["amount"], True)
            for e, at in events
        ]
        for out in self.state.handleInputRows((events[0][0]["card_id"], 0), iter(rows), None):
            yield from zip(*[out[name] for name in ("transaction_id", "late", "n_1m", "n_5m", "n_1h", "sum_1h", "max_24h", "c2_1h")])


@pytest.mark.parametrize("sizes", [(3, 5), (256, 4096), (0, 1)])
def test_events_in_blocks(monkeypatch, sizes):
    monkeypatch.setattr(stateful, "TAIL_EVENTS", sizes[0])
    monkeypatch.setattr(stateful, "BLOCK_EVENTS", sizes[1])
    monkeypatch.setattr(stateful, "OUT_ROWS", 4)
    arrivals = [row for row in random_arrivals(5, 900, 9000) if row[0]["card_id"] == "hot"]
    want, late = expected(arrivals)
    kept, got, blocks = Kept(), {}, 0
    for at in range(0, len(arrivals), 7):
        for number, is_late, *values in kept.batch(arrivals[at : at + 7]):
            if not is_late:
                got[number] = values
        blocks = max(blocks, len(kept.map))
    assert set(got) == set(want) and late and (blocks > 1) == (sizes[0] < 256)
    for number, (n_1m, n_5m, n_1h, sum_1h, max_24h, c2_1h) in got.items():
        right = want[number]
        assert (n_1m, n_5m, n_1h, max_24h, c2_1h) == (*right[:3], right[7], round(right[8] * 1e4))
        assert sum_1h == round(right[3] * 1e4)


def test_calls_to_the_state_do_not_go_by_minutes():
    kept = Kept()
    for day in range(3):
        list(kept.batch([(event(day * 1440 + i, "a", 1.0, 0, c2=0.0), 60 * (day * 1440 + i)) for i in range(1440)]))
    assert kept.calls < 30


def test_range_max():
    values = np.random.default_rng(1).normal(size=37)
    find = stateful.RangeMax(values)
    start, stop = np.divmod(np.arange(38 * 38), 38)
    got = find(start, stop)
    for a, b, m in zip(start, stop, got):
        assert m == (values[a:b].max() if b > a else -np.inf)
    assert stateful.RangeMax(values[:0])(np.array([0]), np.array([0]))[0] == -np.inf


def test_card_minutes(spark, tmp_path):
    """Closed minutes only, late rows dropped and counted, state bounded."""
    write(tmp_path / "in", 1, [event(1, "a", 10.0, 0), event(2, "a", 2.5, 30), event(3, "b", 1.0, 61), event(4, "a", 9.0, 700)])
    write(tmp_path / "in", 2, [event(6, "a", 4.0, 690), event(7, "a", -4.0, 690)])
    write(tmp_path / "in", 3, [event(5, "a", 3.0, 40)])
    minutes = stateful.card_minutes(file_events(spark, str(tmp_path / "in"), 1), "2 minutes")
    writer = minutes.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    query = writer.outputMode("append").format("parquet").start(str(tmp_path / "out"))
    query.awaitTermination(120)
    rows = spark.read.schema(minutes.schema).parquet(str(tmp_path / "out")).collect()
    assert {(r.card_id, r.minute.minute, r.events, r.amount) for r in rows} == {("a", 0, 2, 12.5), ("b", 1, 1, 1.0)}
    assert stateful.dropped_late(query) == 1
    assert [o.numRowsTotal for o in query.lastProgress.stateOperators] == [1]
