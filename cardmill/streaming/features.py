"""The streaming feature job.

One query parses the events, quarantines bad ones and, in each micro-batch, computes the
rolling vectors with the same operator the batch job uses, over the batch and the archived
events of the preceding 24 hours. The state of the stream is therefore the archive table
itself: it is shared by all executors, survives the loss of any of them, and a card that
sends most of the traffic is divided exactly as in batch. Per-key state in the state store
would keep such a card's history and all of its work in a single task.

Every batch writes folders named after its number, so repeating a batch replaces them. The
tables and the checkpoint live under one root and belong together.
"""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cardmill.operators.quality import REASONS
from cardmill.operators.retrieval import CARD_STREAM
from cardmill.operators.rolling import rolling_features
from cardmill.operators.skew import HOT_ROWS, join_per_key
from cardmill.sources.sinks import BatchParts, OnlineTable
from cardmill.streaming.source import ARRIVAL, ARRIVAL_TYPES, CORRUPT, EVENT_SCHEMA, LATE, parsed_events, quarantine_messages

LATENESS = "5 seconds"
# Arrivals per block when the newest time before each event is looked for.
ARRIVAL_BITS = 13

ARCHIVE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("c1", T.DoubleType()),
        T.StructField("c2", T.DoubleType()),
        T.StructField("product_cd", T.StringType()),
        T.StructField("p_emaildomain", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("counted_at", T.TimestampType()),
        T.StructField("late", T.BooleanType()),
        *[T.StructField(name, T.StringType() if kind == "string" else T.LongType()) for name, kind in zip(ARRIVAL, ARRIVAL_TYPES)],
        T.StructField("event_date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
VECTOR_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("card_id", T.StringType()),
        *CARD_STREAM.schema.fields,
        T.StructField("last_updated", T.TimestampType()),
    ]
)
QUARANTINE_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        T.StructField(CORRUPT, T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField(REASONS, T.ArrayType(T.StringType())),
        T.StructField("quarantine_timestamp", T.TimestampType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)


class StreamTables:
    """The tables of one stream, under one root."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.checkpoint = f"{self.root}/checkpoint"
        self.archive = BatchParts(f"{self.root}/archive", ARCHIVE_SCHEMA, day="event_date")
        self.quarantine = BatchParts(f"{self.root}/quarantine", QUARANTINE_SCHEMA)
        self.vectors = BatchParts(f"{self.root}/vectors", VECTOR_SCHEMA)
        self.online = OnlineTable(
            f"{self.root}/online", VECTOR_SCHEMA, "card_id", ("last_updated", "transaction_id")
        )


class FeatureBatch:
    """``foreachBatch`` handler."""

    def __init__(
        self,
        tables: StreamTables,
        hot_rows: int = HOT_ROWS,
        rounded: bool = False,
        quarantine_topic: dict[str, str] | None = None,
    ):
        self.tables = tables
        self.hot_rows = hot_rows
        self.rounded = rounded
        self.quarantine_topic = quarantine_topic

    def __call__(self, parsed: DataFrame, batch_id: int) -> None:
        spark, tables = parsed.sparkSession, self.tables
        # A stream's own session starts with adaptive execution off. The work below is plain
        # batch work on finished data and needs it to split skewed joins.
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        # Events without a number are numbered as they lie in the batch.
        number = F.coalesce("arrived_no", F.monotonically_increasing_id())
        parsed = parsed.withColumn("arrived_no", number).persist(StorageLevel.MEMORY_AND_DISK)
        # Several stages below read the parsed events at the same time; stored first, no executor parses again.
        parsed.count()
        placed = self._placed(parsed, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        valid = placed.where(F.size(REASONS) == 0)
        try:
            placed.count()
            parsed.unpersist()
            self._archive(valid, batch_id)
            self._quarantine(placed, batch_id)
            on_time = valid.where(~F.col("late"))
            if not on_time.isEmpty():
                tables.vectors.write(self._vectors(on_time, batch_id), batch_id)
                written = tables.vectors.read(spark, after=batch_id - 1, before=batch_id + 1)
                tables.online.upsert(written, batch_id)
                tables.online.compact_if_due(spark, batch_id)
        finally:
            placed.unpersist()

    def _placed(self, parsed: DataFrame, batch_id: int) -> DataFrame:
        """Every event, with ``late`` set on valid ones behind the newest of their card.

        The newest is that of all events that arrived before, in earlier batches or in this one,
        so it does not depend on how the arrivals are cut into batches. An event up to five
        seconds behind is taken and counts at the newest time (``counted_at``), as if it had
        happened then: what was seen before it is then the same however batches are cut.

        The newest time before an event comes from the stored one, from a roll-up of the blocks
        of arrivals before its own and from its block; no task sees all arrivals of a card.
        """
        newest = self.tables.online.newest(parsed.sparkSession, batch_id, parsed.select("card_id"))
        valid = F.size(REASONS) == 0
        block = ["card_id", "arrived_at", "arrived_in", "arrival_block"]
        rows = join_per_key(parsed, newest, "card_id").withColumn("arrival_block", F.shiftright("arrived_no", ARRIVAL_BITS))
        rows = rows.withColumn("valid_time", F.when(valid, F.col("event_time")))
        per_block = rows.where(valid).groupBy(*block).agg(F.max("valid_time").alias("block_newest"))
        earlier = Window.partitionBy("card_id").orderBy(*block[1:]).rowsBetween(Window.unboundedPreceding, -1)
        before = per_block.withColumn("blocks_newest", F.max("block_newest").over(earlier)).drop("block_newest")
        own = Window.partitionBy(*block).orderBy("arrived_no").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("own_newest", F.max("valid_time").over(own)).join(before, block, "left")
        rows = rows.withColumn("seen", F.greatest("newest", "blocks_newest", "own_newest"))
        late = valid & F.coalesce(F.col("event_time") < F.col("seen") - F.expr(f"INTERVAL {LATENESS}"), F.lit(False))
        placed = rows.withColumns({"late": late, "counted_at": F.greatest("event_time", "seen")})
        return placed.drop("newest", "arrival_block", "valid_time", "blocks_newest", "own_newest", "seen")

    def _archive(self, valid: DataFrame, batch_id: int) -> None:
        """Every valid event, appended by day."""
        rows = valid.select(
            "transaction_id",
            "card_id",
            "amount",
            F.coalesce("c1", F.lit(0.0)).alias("c1"),
            F.coalesce("c2", F.lit(0.0)).alias("c2"),
            F.coalesce("product_cd", F.lit("")).alias("product_cd"),
            F.coalesce("p_emaildomain", F.lit("")).alias("p_emaildomain"),
            F.col("event_time").alias("event_timestamp"),
            "counted_at",
            "late",
            *ARRIVAL,
            F.to_date("counted_at").alias("event_date"),
        )
        self.tables.archive.write(rows, batch_id, ("event_date",))

    def _quarantine(self, placed: DataFrame, batch_id: int) -> None:
        """Rejected and late events with their reasons."""
        reasons = F.when(F.col("late"), F.array(F.lit(LATE))).otherwise(F.col(REASONS))
        rows = (
            placed.withColumn(REASONS, reasons)
            .where(F.size(REASONS) > 0)
            .drop("late", "counted_at", *ARRIVAL)
            .withColumn("quarantine_timestamp", F.current_timestamp())
        )
        if self.quarantine_topic:
            quarantine_messages(rows).write.format("kafka").options(**self.quarantine_topic).save()
        dated = rows.withColumns(
            {
                "year": F.date_format("quarantine_timestamp", "yyyy"),
                "month": F.date_format("quarantine_timestamp", "MM"),
            }
        )
        self.tables.quarantine.write(dated, batch_id, ("year", "month"))

    def _history(self, on_time: DataFrame, batch_id: int) -> DataFrame:
        """Archived events of the batch's days and the days before them."""
        spark, archive = on_time.sparkSession, self.tables.archive
        day = F.to_date("counted_at")
        days = on_time.select(F.explode(F.array(day.cast("string"), F.date_sub(day, 1).cast("string"))).alias("day"))
        stored = archive.days(spark)  # one name per day of the archive
        needed = [r.day for r in days.where(F.col("day").isin(stored)).distinct().collect()] if stored else []
        return archive.read_days(spark, sorted(needed), batch_id).where(~F.col("late"))

    def _vectors(self, on_time: DataFrame, batch_id: int) -> DataFrame:
        """Vectors of the batch's events over the archive and the batch."""
        counted = F.col("counted_at").alias("event_time")
        columns = ["transaction_id", "card_id", "amount", "c2", counted, "batch_id", *ARRIVAL]
        history = self._history(on_time, batch_id).select(columns)
        history = join_per_key(history, on_time.select("card_id").distinct(), "card_id", "left_semi")
        new = on_time.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(columns)
        vectors = rolling_features(
            history.unionByName(new),
            self.hot_rows,
            carry=("batch_id",),
            rounded=self.rounded,
            arrival=("batch_id", *ARRIVAL),
        )
        return vectors.where(F.col("batch_id") == batch_id).drop("batch_id")


class ProgressLog(StreamingQueryListener):
    """Valid and corrupt counts and the rate of every batch, to the log."""

    def __init__(self, logger: logging.Logger | None = None):
        self.logger = logger or logging.getLogger("cardmill.stream")

    def onQueryStarted(self, event) -> None:
        self.logger.info("stream %s started", event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get("events")
        if counts is not None:
            self.logger.info(
                "batch %s: %s valid, %s corrupt, %.1f rows/s",
                progress.batchId,
                counts.valid_rows,
                counts.corrupt_rows,
                progress.processedRowsPerSecond,
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.logger.info("stream %s ended", event.id)


def start_features(
    raw: DataFrame,
    tables: StreamTables,
    hot_rows: int = HOT_ROWS,
    rounded: bool = False,
    available_now: bool = True,
    interval: str = "1 minute",
    quarantine_topic: dict[str, str] | None = None,
    log_progress: bool = True,
) -> StreamingQuery:
    """Start the job on a stream of JSON ``value`` rows.

    Counts and rate of every batch go to the log (T7), once per session. ``available_now`` consumes what is there and ends (S5); otherwise a batch starts every
    ``interval``. Offsets are kept in the checkpoint (T6).
    """
    spark = raw.sparkSession
    if log_progress and not getattr(spark, "_cardmill_progress", None):
        spark._cardmill_progress = ProgressLog()
        spark.streams.addListener(spark._cardmill_progress)
    ok = F.size(REASONS) == 0
    counted = parsed_events(raw).observe(
        "events", F.count_if(ok).alias("valid_rows"), F.count_if(~ok).alias("corrupt_rows")
    )
    writer = counted.writeStream.foreachBatch(FeatureBatch(tables, hot_rows, rounded, quarantine_topic)).option(
        "checkpointLocation", tables.checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
