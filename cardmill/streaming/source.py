"""Event sources and their parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmill.functions.columns import parse_event_time
from cardmill.operators.quality import REASONS, ROLLING_CHECKS, failed_checks

# Fixed format of an event in the topic.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("transaction_dt", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("product_cd", T.StringType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("card_category", T.StringType()),
        T.StructField("p_emaildomain", T.StringType()),
        T.StructField("addr1", T.DoubleType()),
        T.StructField("c1", T.DoubleType()),
        T.StructField("c2", T.DoubleType()),
    ]
)
# Place of an event in the order of arrival: the time and name of its file (none in a topic) and
# its number there. A topic is keyed by card, so offsets order the events of a card.
ARRIVAL = ["arrived_at", "arrived_in", "arrived_no"]
ARRIVAL_TYPES = ["bigint", "string", "bigint"]
CORRUPT = "corrupt_record"
MALFORMED = "malformed_json"
BAD_TIME = "bad_timestamp"
LATE = "late_event"


def kafka_events(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The topic from its earliest offset. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("offset").alias("arrived_no"))
    )


def file_events(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """A folder of JSON-lines files as the topic."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(path)
    return lines.select(
        "value",
        F.unix_micros("_metadata.file_modification_time").alias("arrived_at"),
        F.col("_metadata.file_path").alias("arrived_in"),
    )


def to_messages(events: DataFrame) -> DataFrame:
    """F8: events keyed by card, as they lie in the topic."""
    return events.select(F.col("card_id").alias("key"), F.to_json(F.struct(*events.columns)).alias("value"))


def parsed_events(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed events with their event time and the reasons a row must be quarantined.

    A line that is no JSON object and a time that cannot be read are reasons like any failed
    check; nothing is replaced by the current time. The arrival columns of the source are kept,
    and those named in ``carry``. Rows without a number there are numbered when their batch is worked on.
    """
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    place = {"arrived_at": F.lit(0), "arrived_in": F.lit(""), "arrived_no": F.lit(None)}
    places = [
        (F.col(name) if name in raw.columns else place[name]).cast(kind).alias(name)
        for name, kind in zip(ARRIVAL, ARRIVAL_TYPES)
    ]
    events = raw.select(F.from_json("value", schema, options).alias("e"), *places, *carry).select("e.*", *ARRIVAL, *carry)
    events = events.withColumn("event_time", parse_event_time(F.col("timestamp")))
    malformed = F.col(CORRUPT).isNotNull()
    reasons = failed_checks(ROLLING_CHECKS, (F.col("event_time").isNull(), BAD_TIME))
    return events.withColumn(REASONS, F.when(malformed, F.array(F.lit(MALFORMED))).otherwise(reasons))


def quarantine_messages(quarantined: DataFrame) -> DataFrame:
    """Rejected events for the quarantine topic, keyed by card."""
    return quarantined.select(
        F.coalesce("card_id", F.lit("bad_event")).alias("key"),
        F.to_json(F.struct(*quarantined.columns)).alias("value"),
    )
