"""Scalar column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money is summed exactly where it can be: the sum then does not depend on the order in which
# partitions are merged. Every amount counts: one that has no exact decimal of this type (more
# than 18 places, or 1e20 and above) makes the sum of its group a sum of doubles.
MONEY = "decimal(38,18)"

MICROS = 1_000_000
DAY_SECONDS = 86_400


def money(value: Column) -> Column:
    """Amount as a decimal of the same value, null when there is none."""
    exact = value.try_cast(MONEY)
    return F.when(exact.cast("double") == value, exact)


def exact_avg(value: Column) -> Column:
    """Aggregate: mean over all values, from an exact sum if every value has one; null for an
    empty group."""
    amount = money(value)
    exact = F.when(F.count(amount) == F.count(value), F.try_sum(amount).cast("double"))
    return F.try_divide(F.coalesce(exact, F.sum(value.cast("double"))), F.count(value))


def or_default(value: Column, default) -> Column:
    """the value, or the default when it is null or NaN."""
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(None).cast("double")), F.lit(default))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def replay_time(transaction_dt: Column, base_seconds: float) -> Column:
    """P5: event time is a base instant plus the second of the day of ``transaction_dt``."""
    seconds = F.lit(float(base_seconds)) + F.pmod(transaction_dt, F.lit(float(DAY_SECONDS)))
    return F.timestamp_micros(F.round(seconds * MICROS).cast("bigint"))


def parse_event_time(text: Column) -> Column:
    """ISO-8601 text to a timestamp, null when it cannot be read."""
    return F.try_to_timestamp(text)


def date_parts(ts: Column) -> dict[str, Column]:
    """zero-padded partition values."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def normalize_raw_event(raw: DataFrame, base_seconds: float) -> DataFrame:
    """Raw transaction rows to events, with a default for every missing column."""

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(default))

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    event_time = replay_time(number("TransactionDT"), base_seconds)
    return raw.select(
        F.col("TransactionID").cast("bigint").alias("transaction_id"),
        F.coalesce(F.col("isFraud").cast("int"), F.lit(0)).alias("is_fraud"),
        number("TransactionDT").alias("transaction_dt"),
        F.date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        F.coalesce(F.col("card1").cast("bigint").cast("string"), F.lit("unknown_card")).alias("card_id"),
        number("TransactionAmt").alias("amount"),
        text("ProductCD", "W").alias("product_cd"),
        text("card4", "unknown").alias("card_type"),
        text("card6", "unknown").alias("card_category"),
        text("P_emaildomain", "unknown").alias("p_emaildomain"),
        number("addr1").alias("addr1"),
        number("C1").alias("c1"),
        number("C2").alias("c2"),
    )


def with_on_demand_features(df: DataFrame) -> DataFrame:
    """Request-time features from the amount and the looked-up vectors."""
    amount = F.col("current_amount")

    def filled(name: str) -> Column:
        return or_default(F.col(name), 0.0)

    return df.withColumns(
        {
            "amount_ratio_24h": amount_ratio(amount, filled("avg_amount_24h")),
            "amount_ratio_30d": amount_ratio(amount, filled("avg_amount_30d")),
            "amount_zscore_24h": F.try_divide(
                amount - filled("avg_amount_24h"), filled("stddev_amount_24h") + 0.01
            ),
            "is_amount_gt_30d_max": exceeds(amount, filled("max_amount_30d")),
            "is_high_velocity_5m": F.when(filled("trans_count_5m") >= 3, 1.0).otherwise(0.0),
        }
    )


def amount_ratio(amount: Column, average: Column) -> Column:
    """E3/E4."""
    return F.try_divide(amount, average + 1.0)


def exceeds(amount: Column, bound: Column) -> Column:
    """Strict comparison as 1.0 or 0.0."""
    return F.when(amount > bound, 1.0).otherwise(0.0)


def numeric_columns(df: DataFrame, excluded: tuple[str, ...]) -> list[str]:
    """Numeric columns other than ids and times."""
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in excluded
    ]


def columns_except(df: DataFrame, excluded: tuple[str, ...]) -> list[str]:
    """P11."""
    return [name for name in df.columns if name not in excluded]


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
