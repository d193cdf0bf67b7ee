"""Rolling features from keyed state (T2, T4): minute roll-ups, timers, shares of hot cards.

Each card's last 24 hours lie in the state store: one row per minute in a roll-up, the newest events
beside it and the others in numbered blocks. A batch reads the roll-up and the blocks that its windows begin
in, so its cost follows its own rows and not what was archived. A card known to be hot has several
state keys. Every key sees the card's events, because all of them have to be answered, but keeps
only its share; the shares' answers are added up behind it. State is kept by RocksDB on the
executors and in the checkpoint, so a lost executor's keys are opened elsewhere.

Lateness goes by card as in :mod:`cardmill.streaming.features`. Besides, the watermark bounds the
state: an event more than ``grace`` behind the newest of all cards is dropped and counted by the
stream's progress (``dropped_late``). A card's state goes when the watermark is a day past it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter
from typing import Any

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cardmill.functions.columns import MICROS
from cardmill.operators.quality import REASONS
from cardmill.operators.rolling import UNITS, WINDOWS, rolling_vectors
from cardmill.streaming.features import FeatureBatch, StreamTables
from cardmill.streaming.source import ARRIVAL, parsed_events

MINUTE, DAY = 60 * MICROS, WINDOWS["24h"] * MICROS
LATENESS_MICROS = 5 * MICROS
GRACE = "1 day"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Rows that cannot be counted pass through under so many keys.
PASSING = 64

# What is summed per event, as in the batch operator: whole numbers of ten-thousandths.
SUMS = ("n", "amt", "hh", "hl", "ll", "c2")
TOTALS = {
    "n_1m": ("n", "1m"),
    "n_5m": ("n", "5m"),
    "n_1h": ("n", "1h"),
    "n_24h": ("n", "24h"),
    "sum_1h": ("amt", "1h"),
    "sum_24h": ("amt", "24h"),
    "hh_24h": ("hh", "24h"),
    "hl_24h": ("hl", "24h"),
    "ll_24h": ("ll", "24h"),
    "c2_1h": ("c2", "1h"),
}
ROLLUP = np.dtype([("minute", "<i8"), *[(name, "<i8") for name in SUMS], ("most", "<f8")])
EVENT = np.dtype([("t", "<i8"), ("amt", "<i8"), ("c2", "<i8"), ("amount", "<f8")])
INDEX = np.dtype([("number", "<i8"), ("first", "<i8"), ("last", "<i8")])
#: Events that lie beside the roll-up at most, those of a block, and answers of a row.
TAIL_EVENTS, BLOCK_EVENTS, OUT_ROWS = 256, 4096, 4096

#: What a question brings, the order of arrival first, and what of it goes on with the answer.
ORDER = [*ARRIVAL, "t", "transaction_id"]
ASKED = [*ORDER, "value", "own", "shares", "amt", "c2", "amount", "ok"]
PASSED = ["value", *ARRIVAL, "transaction_id", "own", "shares"]

ANSWER = {
    "value": T.StringType(),
    "arrived_at": T.LongType(),
    "arrived_in": T.StringType(),
    "arrived_no": T.LongType(),
    "transaction_id": T.LongType(),
    "own": T.BooleanType(),
    "shares": T.IntegerType(),
    "late": T.BooleanType(),
    "t": T.LongType(),
    **{name: T.LongType() for name in TOTALS},
    "max_24h": T.DoubleType(),
}
#: Many answers of a card in one row.
ANSWERS = T.StructType(
    [T.StructField("card_id", T.StringType()), *[T.StructField(name, T.ArrayType(kind)) for name, kind in ANSWER.items()]]
)


def sums(events: np.ndarray) -> np.ndarray:
    """One row of ``SUMS`` per event."""
    high, low = events["amt"] >> 16, events["amt"] & 65535
    return np.stack([np.ones(len(events), np.int64), events["amt"], high * high, high * low, low * low, events["c2"]], 1)


def before(rows: np.ndarray) -> np.ndarray:
    """Totals of the first 0, 1, 2, ... rows."""
    return np.vstack([np.zeros((1, rows.shape[1]), np.int64), np.cumsum(rows, axis=0)])


class RangeMax:
    """Largest value of any run of positions, from maxima of runs of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            last, step = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.maximum(last[:-step], last[step:]))

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        out = np.full(len(start), -np.inf)
        level = np.log2(np.maximum(stop - start, 1)).astype(int)
        for k, values in enumerate(self.levels):
            at = (level == k) & (stop > start)
            out[at] = np.maximum(values[start[at]], values[stop[at] - 2**k])
        return out


def answers(
    rollup: np.ndarray, edges: np.ndarray, own: np.ndarray, asked: np.ndarray, seen: np.ndarray
) -> dict[str, np.ndarray]:
    """Totals and day maximum for questions at the times ``asked``.

    ``rollup`` has the minutes kept so far, ``edges`` their events in the minutes that a window
    begins in, ``own`` the new events; a question sees the first ``seen`` of them. All go by time.
    What lies in ``[t - W, t]`` is all that was seen less what is older than ``t - W``.
    """
    whole = before(np.stack([rollup[name] for name in SUMS], 1))
    part, new = before(sums(edges)), before(sums(own))
    out = {}
    for window, seconds in WINDOWS.items():
        since = asked - seconds * MICROS
        minute = since // MINUTE
        older = whole[np.searchsorted(rollup["minute"], minute)]
        first, cut = np.searchsorted(edges["t"], minute * MINUTE), np.searchsorted(edges["t"], since)
        gone = np.searchsorted(own["t"], since)
        totals = whole[-1] + new[seen] - older - (part[cut] - part[first]) - new[np.minimum(gone, seen)]
        for name, (value, of) in TOTALS.items():
            if of == window:
                out[name] = totals[:, SUMS.index(value)]
    # The last window is the day: the rest of its first minute, the minutes after it, the new events.
    last = np.searchsorted(edges["t"], (minute + 1) * MINUTE)
    after = np.searchsorted(rollup["minute"], minute, side="right")
    rest = RangeMax(edges["amount"])(cut, last)
    minutes = RangeMax(rollup["most"])(after, np.full(len(asked), len(rollup)))
    out["max_24h"] = np.maximum.reduce([rest, minutes, RangeMax(own["amount"])(np.minimum(gone, seen), seen)])
    return out


def rolled(rollup: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The roll-up with new events added to their minutes."""
    minute = own["t"] // MINUTE
    fresh, start = np.unique(minute, return_index=True)
    more = np.zeros(len(fresh), ROLLUP)
    more["minute"] = fresh
    for name, total in zip(SUMS, np.add.reduceat(sums(own), start, axis=0).T if len(own) else []):
        more[name] = total
    more["most"] = np.maximum.reduceat(own["amount"], start) if len(own) else []
    if len(rollup) and len(more) and rollup["minute"][-1] == more["minute"][0]:  # only the last minute goes on
        for name in SUMS:
            more[name][0] += rollup[name][-1]
        more["most"][0] = max(more["most"][0], rollup["most"][-1])
        rollup = rollup[:-1]
    return np.concatenate([rollup, more])


class CardState(StatefulProcessor):
    """One share of one card: ``newest`` time, timer, roll-up and the day's events.

    The newest events lie beside the roll-up, the others in blocks; ``index`` says which minutes a block has.
    So a card of few events is read and written at once, and one of many by blocks of thousands.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "newest long, timer long, rollup binary, index binary, tail binary")
        self.blocks = handle.getMapState("blocks", "number long", "events binary")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first = next(rows)
        asked_of = itemgetter(*map(first.__fields__.index, ASKED))  # by place, which is faster than by name
        ordered = sorted(map(asked_of, chain([first], rows)), key=itemgetter(*range(len(ORDER))))
        batch = dict(zip(ASKED, zip(*ordered)))
        t = np.array(batch["t"], np.int64)
        if not batch["ok"][0]:  # such rows have keys of their own
            yield from self._answer(key[0], batch, np.zeros(len(t), bool), t, {})
            return
        newest, timer, *blobs = self.head.get() or (np.iinfo(np.int64).min, None, b"", b"", b"")
        rollup, index, tail = (np.frombuffer(blob, kind) for blob, kind in zip(blobs, (ROLLUP, INDEX, EVENT)))
        so_far = np.maximum.accumulate(np.concatenate([[newest], t]))
        late = t < np.maximum(so_far[:-1], np.iinfo(np.int64).min + LATENESS_MICROS) - LATENESS_MICROS
        counted = np.where(late, t, so_far[1:])  # a little behind counts at the newest time
        newest = int(so_far[-1])

        mine = np.array(batch["own"], bool) & ~late
        own = np.zeros(mine.sum(), EVENT)
        own["t"] = counted[mine]
        for name in ("amt", "c2", "amount"):
            own[name] = np.array(batch[name])[mine]
        asked, seen = counted[~late], np.cumsum(mine)[~late]
        found = {}
        if len(asked):
            minutes = np.concatenate([(asked - w * MICROS) // MINUTE for w in WINDOWS.values()])
            found = answers(rollup, self._edges(index, tail, np.intersect1d(minutes, rollup["minute"])), own, asked, seen)
        yield from self._answer(key[0], batch, late, counted, found)
        self._keep(rollup, index, tail, own, newest, timer)

    def _edges(self, index: np.ndarray, tail: np.ndarray, minutes: np.ndarray) -> np.ndarray:
        """Stored events by time, with all of the given minutes."""
        needed = np.searchsorted(minutes, index["first"]) < np.searchsorted(minutes, index["last"], side="right")
        blobs = [self.blocks.getValue((n,))[0] for n in index["number"][needed].tolist()]
        return np.concatenate([*(np.frombuffer(blob, EVENT) for blob in blobs), tail])

    def _keep(
        self, rollup: np.ndarray, index: np.ndarray, tail: np.ndarray, own: np.ndarray, newest: int, timer: int | None
    ) -> None:
        """New events in, blocks that no window reaches any more out."""
        least = (newest - DAY) // MINUTE
        for n in index["number"][index["last"] < least].tolist():
            self.blocks.removeKey((n,))
        number = int(index["number"][-1]) + 1 if len(index) else 0
        index, rollup = index[index["last"] >= least], rollup[rollup["minute"] >= least]
        own = own[own["t"] // MINUTE >= least]
        tail = np.concatenate([tail, own])
        tail = tail[tail["t"] // MINUTE >= least]
        if len(tail) > TAIL_EVENTS:
            more = []
            for at in range(0, len(tail), BLOCK_EVENTS):
                block = tail[at : at + BLOCK_EVENTS]
                self.blocks.updateValue((number,), (block.tobytes(),))
                more.append((number, block["t"][0] // MINUTE, block["t"][-1] // MINUTE))
                number += 1
            index, tail = np.concatenate([index, np.array(more, INDEX)]), tail[:0]
        due = (newest + DAY + MINUTE) // 1000
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.head.update((newest, due, rolled(rollup, own).tobytes(), index.tobytes(), tail.tobytes()))

    def _answer(self, card: str | None, batch: dict, late: np.ndarray, t: np.ndarray, found: dict) -> Iterator[Row]:
        """Rows of up to ``OUT_ROWS`` answers, a list per column."""
        out = {name: batch[name] for name in PASSED} | {"late": late, "t": t}
        for name in (*TOTALS, "max_24h"):
            total = np.full(len(t), -np.inf) if name == "max_24h" else np.zeros(len(t), np.int64)
            if found:
                total[~late] = found[name]
            out[name] = total
        for at in range(0, len(t), OUT_ROWS):
            yield Row(card_id=card, **{name: values[at : at + OUT_ROWS] for name, values in out.items()})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.head.clear()
        self.blocks.clear()
        return iter([])

    def close(self) -> None:
        pass


def questions(raw: DataFrame, hot: dict[str, int], grace: str = GRACE, once: bool = False) -> DataFrame:
    """Messages keyed by card and share; each event once per share of its card, its own marked.

    ``hot`` names cards with the number of their state keys; it is one entry per hot card, and has
    to stay as it is for a checkpoint. ``once`` drops a transaction id seen within ``grace`` (A6).
    """
    columns = [c for c in ARRIVAL if c in raw.columns]
    events = parsed_events(raw.select("value", *columns), carry=("value",)).withWatermark("event_time", grace)
    ok = F.size(REASONS) == 0
    shares = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]) if hot else None
    count = F.coalesce(F.try_element_at(shares, "card_id"), F.lit(1)) if hot else F.lit(1)
    count = F.when(ok, count).otherwise(F.lit(1)).cast("int")
    home = F.when(ok, F.pmod(F.xxhash64("transaction_id"), count.cast("long"))).otherwise(
        F.pmod(F.xxhash64("value"), F.lit(PASSING))
    )
    zero = F.lit(0).cast("long")
    same = F.when(ok, F.col("transaction_id").cast("string")).otherwise(F.concat_ws(":", "value", *ARRIVAL))
    keyed = events.select(
        F.when(ok, F.col("card_id")).alias("card_id"),
        "value",
        *[F.coalesce(F.col(c), F.lit("") if c == "arrived_in" else zero).alias(c) for c in ARRIVAL],
        F.coalesce(F.when(ok, F.col("transaction_id")), zero).alias("transaction_id"),
        "event_time",
        F.coalesce(F.unix_micros("event_time"), zero).alias("t"),
        F.when(ok, F.rint(F.col("amount") * UNITS).cast("long")).otherwise(zero).alias("amt"),
        F.coalesce(F.when(ok, F.rint(F.col("c2") * UNITS).cast("long")), zero).alias("c2"),
        F.coalesce("amount", F.lit(0.0)).alias("amount"),
        ok.alias("ok"),
        count.alias("shares"),
        home.cast("int").alias("home"),
        *([same.alias("same")] if once else []),
    )
    if once:  # behind the projection, since Spark takes every column along to where repeats are looked for
        keyed = keyed.dropDuplicatesWithinWatermark(["same"]).drop("same")
    every = F.when(F.col("ok"), F.sequence(F.lit(0), F.col("shares") - 1)).otherwise(F.array("home"))
    return keyed.withColumn("share", F.explode(every)).withColumn("own", F.col("share") == F.col("home")).drop("home")


class StatefulBatch(FeatureBatch):
    """``foreachBatch`` handler: adds up the shares and writes the tables; the archive is only written."""

    def __call__(self, out: DataFrame, batch_id: int) -> None:
        spark, tables = out.sparkSession, self.tables
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            moved = out.where("own").drop("card_id", "transaction_id")
            placed = parsed_events(moved, carry=("late", "t")).withColumn("counted_at", F.timestamp_micros("t")).drop("t")
            self._archive(placed.where((F.size(REASONS) == 0)), batch_id)
            self._quarantine(placed, batch_id)
            on_time = out.where(F.col("card_id").isNotNull() & ~F.col("late"))
            if not on_time.isEmpty():
                tables.vectors.write(self._added(on_time), batch_id)
                written = tables.vectors.read(spark, after=batch_id - 1, before=batch_id + 1)
                tables.online.upsert(written, batch_id)
                tables.online.compact_if_due(spark, batch_id)
        finally:
            out.unpersist()

    def _added(self, on_time: DataFrame) -> DataFrame:
        event = ["transaction_id", "card_id", "t", *ARRIVAL]
        kept = [*event, *TOTALS, "max_24h"]
        several = on_time.where("shares > 1").groupBy(*event).agg(
            *[F.sum(name).alias(name) for name in TOTALS], F.max("max_24h").alias("max_24h")
        )
        rows = on_time.where("shares = 1").select(kept).unionByName(several.select(kept))
        return rolling_vectors(rows.withColumn("event_time", F.timestamp_micros("t")), rounded=self.rounded)


def hot_cards(events: DataFrame, rows_per_key: int, most_keys: int = 64) -> dict[str, int]:
    """Cards with more than ``rows_per_key`` rows and the state keys they need, at most ``most_keys``.

    There are fewer of them than ``rows / rows_per_key``.
    """
    counts = events.groupBy("card_id").count().where(F.col("count") > rows_per_key)
    keys = F.least(F.ceil(F.col("count") / rows_per_key), F.lit(most_keys)).cast("int")
    return {r.card_id: r["keys"] for r in counts.select("card_id", keys.alias("keys")).collect()}


def _settings(spark: SparkSession, tables: StreamTables, given: dict) -> dict:
    """The settings this stream began with; a first start writes those given."""
    path = f"{tables.root}/stateful"
    try:
        return json.loads(spark.read.text(path).first().value)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    spark.createDataFrame([(json.dumps(given),)], "value string").coalesce(1).write.text(path)
    return given


def start_stateful(
    raw: DataFrame,
    tables: StreamTables,
    hot: dict[str, int] | None = None,
    grace: str = GRACE,
    once: bool = False,
    rounded: bool = False,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start the job on a stream of JSON ``value`` rows with keyed state.

    Events of a card are taken in order of arrival; within one file, which numbers no rows, by time and
    transaction id. A stream that goes on uses the hot cards it began with.
    """
    spark = raw.sparkSession
    settings = _settings(spark, tables, {"hot": hot or {}, "grace": grace, "once": once})
    keyed = questions(raw, settings["hot"], settings["grace"], settings["once"])
    out = keyed.groupBy("card_id", "share").transformWithState(
        CardState(), ANSWERS, outputMode="Append", timeMode="EventTime"
    )
    out = out.select("card_id", F.inline(F.arrays_zip(*ANSWER)))
    writer = out.writeStream.foreachBatch(StatefulBatch(tables, rounded=rounded)).option(
        "checkpointLocation", tables.checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    provider = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # a query keeps the settings it was started with
    try:
        return writer.start()
    finally:
        spark.conf.set(PROVIDER, provider)


def dropped_late(query: StreamingQuery) -> int:
    """Events that the watermark kept out of the state so far, of the progress still held."""
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


def card_minutes(raw: DataFrame, grace: str = GRACE) -> DataFrame:
    """Valid events and their amount per card and minute, on a stream by event time.

    In append mode a minute comes out once the watermark is past its end, and its state goes.
    """
    events = parsed_events(raw).where(F.size(REASONS) == 0).withWatermark("event_time", grace)
    counted = events.groupBy(F.window("event_time", "1 minute"), "card_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.rint(F.col("amount") * UNITS).cast("long")).alias("units")
    )
    return counted.select("card_id", F.col("window.start").alias("minute"), "events", (F.col("units") / UNITS).alias("amount"))
