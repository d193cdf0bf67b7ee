"""Per-card batch features (J1, A1, A1a-A1e) and small aggregates over transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill.functions.columns import DAY_SECONDS, exact_avg

BATCH_FEATURES = [
    "trans_count_7d",
    "trans_count_30d",
    "avg_amount_30d",
    "max_amount_30d",
    "distinct_addr_7d",
    "days_since_last_trans",
]


def batch_features(
    transactions: DataFrame,
    run_time: Column | None = None,
    mode: str = "reference",
    approximate_distinct: bool = False,
) -> DataFrame:
    """One row of features per card.

    ``mode="reference"`` keeps the published semantics: only ``trans_count_7d`` looks at a
    window (seven days before the newest transaction of the whole table) and
    ``days_since_last_trans`` is the mean of ``d4``. ``mode="windowed"`` applies the 7 and
    30 day windows that the names promise and derives the days since the last transaction.

    The newest time is a scalar subquery, so no row is joined to it. A card with many
    transactions is combined before each shuffle, the distinct count on (card, address) first.
    """
    rows = transactions.where(F.col("card_id").isNotNull())
    dt = F.col("transaction_dt")
    newest = rows.agg(F.max("transaction_dt")).scalar()
    distinct = F.approx_count_distinct if approximate_distinct else F.count_distinct
    in_7d = dt >= newest - 7 * DAY_SECONDS
    if mode == "reference":
        measures = [
            F.count("transaction_id").alias("trans_count_30d"),
            F.count(F.when(in_7d, 1)).alias("trans_count_7d"),
            exact_avg(F.col("amount")).alias("avg_amount_30d"),
            F.max("amount").alias("max_amount_30d"),
            distinct("addr1").alias("distinct_addr_7d"),
            F.coalesce(F.avg("d4"), F.lit(0.0)).alias("days_since_last_trans"),
        ]
    elif mode == "windowed":
        in_30d = dt >= newest - 30 * DAY_SECONDS
        amount_30d = F.when(in_30d, F.col("amount"))
        measures = [
            F.count(F.when(in_30d, F.col("transaction_id"))).alias("trans_count_30d"),
            F.count(F.when(in_7d, 1)).alias("trans_count_7d"),
            F.coalesce(exact_avg(amount_30d), F.lit(0.0)).alias("avg_amount_30d"),
            F.coalesce(F.max(amount_30d), F.lit(0.0)).alias("max_amount_30d"),
            distinct(F.when(in_7d, F.col("addr1"))).alias("distinct_addr_7d"),
            ((newest - F.max(dt)) / DAY_SECONDS).alias("days_since_last_trans"),
        ]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    features = rows.groupBy("card_id").agg(*measures)
    stamped = features.withColumn("event_timestamp", F.current_timestamp() if run_time is None else run_time)
    return stamped.select("card_id", "event_timestamp", *BATCH_FEATURES)


def class_balance(labelled: DataFrame, label: str = "is_fraud") -> DataFrame:
    """A2: negatives per positive, the weight of a positive row in training."""
    negatives = F.count_if(F.col(label) == 0)
    positives = F.count_if(F.col(label) == 1)
    return labelled.agg(
        negatives.alias("negatives"),
        positives.alias("positives"),
        (negatives / F.greatest(F.lit(1), positives)).alias("positive_weight"),
    )


def label_summary(labelled: DataFrame, label: str = "is_fraud") -> DataFrame:
    """A3: rows, positives and their percentage."""
    return labelled.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.col(label).cast("bigint")).alias("fraud_rows"),
        F.try_divide(F.sum(F.col(label).cast("bigint")) * 100.0, F.count(F.lit(1))).alias("fraud_percent"),
    )


def first_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key, the first by ``order``.

    An aggregate rather than a ranking window: copies of one key are combined before the
    shuffle, so a key that holds most rows costs no more than any other.
    """
    row = F.struct(*[F.col(name) for name in df.columns])
    rank = F.struct(*[F.col(name) for name in order])
    return df.groupBy(key).agg(F.min_by(row, rank).alias("first_row")).select("first_row.*")
