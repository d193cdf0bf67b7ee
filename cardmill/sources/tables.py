"""Scans (S1-S3, S6, S15) and the adapters that read the test tables as transactions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the raw CSV that are read; any other column of the file is ignored by name.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("TransactionID", T.LongType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("TransactionDT", T.DoubleType()),
        T.StructField("TransactionAmt", T.DoubleType()),
        T.StructField("ProductCD", T.StringType()),
        T.StructField("card1", T.LongType()),
        T.StructField("card4", T.StringType()),
        T.StructField("card6", T.StringType()),
        T.StructField("P_emaildomain", T.StringType()),
        T.StructField("addr1", T.DoubleType()),
        T.StructField("C1", T.DoubleType()),
        T.StructField("C2", T.DoubleType()),
        T.StructField("D4", T.DoubleType()),
    ]
)


def raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw file with declared types; columns are matched to the header by name."""
    text = spark.read.option("header", True).csv(path)
    return text.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in RAW_SCHEMA if field.name in text.columns]
    )


def typed_transactions(raw: DataFrame) -> DataFrame:
    """Seven typed columns, rows without a card removed."""
    return raw.where(F.col("card1").isNotNull()).select(
        F.col("TransactionID").cast("bigint").alias("transaction_id"),
        F.col("isFraud").cast("int").alias("is_fraud"),
        F.col("TransactionDT").cast("double").alias("transaction_dt"),
        F.col("TransactionAmt").cast("double").alias("amount"),
        F.col("card1").cast("string").alias("card_id"),
        F.col("addr1").cast("double").alias("addr1"),
        F.col("D4").cast("double").alias("d4"),
    )


def first_transactions(transactions: DataFrame, limit: int = 50_000) -> DataFrame:
    """Four columns of the first ``limit`` rows by transaction id.

    File order has no meaning on a cluster, so the id gives the order.
    """
    pruned = transactions.select("transaction_id", "is_fraud", "amount", "card_id")
    return smallest(pruned, "transaction_id", limit)


def smallest(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest integer key, in order, for an ``n`` of many thousands.

    A plain ordered limit sends up to ``n`` rows of every partition to one task. Counts of
    key ranges first show which ranges can hold the result; the first ``n`` occupied ranges
    always suffice. Only rows in those are sorted.
    """
    key_range = F.shiftright(F.col(key).cast("bigint"), 16)
    counts = df.where(F.col(key).isNotNull()).groupBy(key_range.alias("key_range")).agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy("key_range").limit(n)  # at most n short rows
    up_to = Window.orderBy("key_range").rowsBetween(Window.unboundedPreceding, 0)
    totals = first.withColumn("upto", F.sum("n").over(up_to))
    # The range in which the n-th row lies, or the last one when there are fewer rows.
    enough = F.min(F.when(F.col("upto") >= n, F.col("key_range")))
    last = totals.agg(F.coalesce(enough, F.max("key_range"))).scalar()
    return df.where(key_range <= last).orderBy(key).limit(n)


def replay_order(raw: DataFrame) -> DataFrame:
    """S3/L1: the whole file in time order (a range-partitioned sort)."""
    return raw.orderBy("TransactionDT", "TransactionID")


def partition_days(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """Days of a ``year=/month=/day=`` table, oldest first, from its folder names alone."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*/day=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(tuple(int(x) for x in re.findall(r"(?:year|month|day)=(\d+)", str(s.getPath()))[-3:]) for s in found)


def partition_of(lake: DataFrame, day: tuple[int, int, int]) -> DataFrame:
    """Rows of one day; literals on the partition columns, so only its files are listed."""
    year, month, number = day
    of_day = (F.col("year").cast("int") == year) & (F.col("month").cast("int") == month) & (F.col("day").cast("int") == number)
    return lake.where(of_day)


def latest_partition(spark: SparkSession, path: str, back: int = 0) -> DataFrame:
    """Rows of the newest day, or of the one ``back`` days of data before; empty if none."""
    days, lake = partition_days(spark, path), spark.read.parquet(path)
    return partition_of(lake, days[-1 - back]) if len(days) > back else lake.where(F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_transactions(events: DataFrame) -> DataFrame:
    """The ``events`` test table, batch or stream, as transactions."""
    k = F.get_json_object("props", "$.k").cast("double")
    event_time = F.col("ts").cast("timestamp")
    transaction_id = F.col("event_id") + 1
    return events.select(
        transaction_id.alias("transaction_id"),
        F.col("user_id").cast("string").alias("card_id"),
        F.col("value").alias("amount"),
        event_time.alias("event_time"),
        (F.unix_micros(event_time) / 1e6).alias("transaction_dt"),
        F.col("event_type").alias("product_cd"),
        k.alias("c2"),
        k.alias("addr1"),
        F.pmod(transaction_id, F.lit(7)).cast("double").alias("d4"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_fraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(table(spark, sf_dir, "events"))


def dirtied(rows: DataFrame) -> DataFrame:
    """The three corrupt shapes of the event generator, and a null card, planted by id."""
    kind = F.pmod(F.col("transaction_id"), F.lit(50))
    return rows.withColumns(
        {
            "amount": F.when(kind == 0, F.lit(-999.0)).otherwise(F.col("amount")),
            "card_id": F.when(kind == 1, F.lit("unknown_card"))
            .when(kind == 2, F.lit(""))
            .when(kind == 3, F.lit(None).cast("string"))
            .otherwise(F.col("card_id")),
        }
    )
