"""A1 with true windows, kept up to date day by day from mergeable partial results.

A day's run reads that day's transactions once and stores one row per card: counts, an exact sum,
the largest amount and a HyperLogLog sketch of the addresses. The 7 and 30 day features merge stored
days; only the two days in which the windows begin are read again, from their bound on, so
counts, mean and maximum equal those over all transactions. The number of addresses is the
sketch's estimate: with 2^12 registers its standard error is 1.6 %, and a few hundred are counted exactly or nearly so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.functions.columns import DAY_SECONDS, money
from cardmill.operators.batch import BATCH_FEATURES

#: Two to this power registers in a sketch.
SKETCH_BITS = 12
WINDOW_DAYS = {"7d": 7, "30d": 30}


def day_number() -> Column:
    """Days since 1970 of a transaction."""
    return F.floor(F.col("transaction_dt") / DAY_SECONDS).cast("int")


def partials(transactions: DataFrame, *by: str) -> DataFrame:
    """One row per card (and ``by``) of what merges to the features."""
    amount, exact = F.col("amount"), money(F.col("amount"))
    return transactions.where(F.col("card_id").isNotNull()).groupBy("card_id", *by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("transaction_id").alias("ids"),
        F.count(amount).alias("amounts"),
        F.count(exact).alias("exact_amounts"),
        F.try_sum(exact).alias("exact_sum"),
        F.sum(amount.cast("double")).alias("double_sum"),
        F.max("amount").alias("max_amount"),
        F.hll_sketch_agg(F.col("addr1").cast("string"), F.lit(SKETCH_BITS)).alias("addresses"),
        F.max("transaction_dt").alias("last_dt"),
    )


class DayPartials:
    """The stored partial results under one root, and each card's newest time as of each run."""

    def __init__(self, root: str):
        self.days, self.cards = f"{root.rstrip('/')}/days", f"{root.rstrip('/')}/cards"

    def update(self, transactions: DataFrame, run: int, after: int | None = None) -> None:
        """Store the days of ``transactions`` (whole days, as many as given) as run number ``run``.

        A repeated run replaces its days and its version. ``after`` is the run before it, if any.
        """
        spark = transactions.sparkSession
        own = partials(transactions.withColumn("day", day_number()), "day")
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(self.days)
        read = spark.read.schema(own.schema).parquet(self.days)
        days = [r.day for r in transactions.select(day_number().alias("day")).distinct().collect()]
        seen = read.where(F.col("day").isin(days)).groupBy("card_id").agg(F.max("last_dt").alias("last_dt"))
        if after is not None:
            both = seen.unionByName(spark.read.schema(seen.schema).parquet(f"{self.cards}/run={after}"))
            seen = both.groupBy("card_id").agg(F.max("last_dt").alias("last_dt"))
        seen.write.mode("overwrite").parquet(f"{self.cards}/run={run}")

    def features(self, spark: SparkSession, transactions: DataFrame, run: int, run_time: Column) -> DataFrame:
        """One row per card as of a run, like ``batch_features`` with ``mode="windowed"``.

        ``transactions`` has a column ``day``; if it is stored by that, two days of it are read.
        """
        cards = spark.read.parquet(f"{self.cards}/run={run}")
        newest = cards.agg(F.max("last_dt")).first()[0]  # one number
        stored = spark.read.schema(partials(transactions, "day").schema).parquet(self.days)
        measures = {
            "7d": ["rows", "addresses"],
            "30d": ["ids", "amounts", "exact_amounts", "exact_sum", "double_sum", "max_amount"],
        }
        both = cards
        for name, columns in measures.items():
            if newest is None:
                part = stored.limit(0)
            else:
                bound = newest - WINDOW_DAYS[name] * DAY_SECONDS
                edge, last = int(bound // DAY_SECONDS), int(newest // DAY_SECONDS)
                edge_rows = transactions.where((F.col("day") == edge) & (F.col("transaction_dt") >= bound))
                inside = stored.where((F.col("day") > edge) & (F.col("day") <= last))
                part = inside.select("card_id", *columns).unionByName(partials(edge_rows).select("card_id", *columns))
            both = both.unionByName(part.select("card_id", *columns), allowMissingColumns=True)
        # A sum that did not fit is missing although there are amounts.
        overflow = F.count_if((F.col("exact_amounts") > 0) & F.col("exact_sum").isNull()) > 0
        whole = (F.sum("exact_amounts") == F.sum("amounts")) & ~overflow
        exact = F.when(whole, F.try_sum("exact_sum").cast("double"))
        mean = F.try_divide(F.coalesce(exact, F.sum("double_sum")), F.sum("amounts"))
        zero = F.lit(0).cast("long")
        merged = both.groupBy("card_id").agg(
            F.coalesce(F.sum("rows"), zero).alias("trans_count_7d"),
            F.coalesce(F.sum("ids"), zero).alias("trans_count_30d"),
            F.coalesce(mean, F.lit(0.0)).alias("avg_amount_30d"),
            F.coalesce(F.max("max_amount"), F.lit(0.0)).alias("max_amount_30d"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("addresses")), zero).alias("distinct_addr_7d"),
            ((F.lit(newest) - F.max("last_dt")) / DAY_SECONDS).alias("days_since_last_trans"),
        )
        return merged.withColumn("event_timestamp", run_time).select("card_id", "event_timestamp", *BATCH_FEATURES)
