"""Running totals over a whole table in key order, without putting the table in one task.

A window without a partition would sort everything in a single task. Here the key range
is cut at approximate quantiles into buckets of similar size. Each bucket is totalled, the
totals before a bucket are added up over that small table, and the running total within a
bucket is a window function partitioned by bucket. The bucket is a function of the key
alone, so a lost task recomputes to the same place.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUANTILE_ERROR = 0.001
MAX_BUCKETS = 10_000


def bucket_count(df: DataFrame) -> int:
    """Follows the session's shuffle parallelism, which is sized for the data."""
    parallelism = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(MAX_BUCKETS, 4 * parallelism))


def quantile_splits(df: DataFrame, key: str, buckets: int) -> list[float]:
    """Interior cut points; a job over one column that returns at most ``buckets`` numbers."""
    shares = [i / buckets for i in range(1, buckets)]
    error = max(1.0 / (4 * buckets), 1e-5) if buckets > 250 else QUANTILE_ERROR
    return sorted(set(df.approxQuantile(key, shares, error)))


def with_range_bucket(df: DataFrame, key: str, splits: list[float]) -> DataFrame:
    edges = [float("-inf"), *(splits or [0.0]), float("inf")]
    return Bucketizer(splits=edges, inputCol=key, outputCol="range_bucket").transform(df)


def running_totals(
    df: DataFrame, group: str, key: str, columns: list[str], splits: list[float]
) -> DataFrame:
    """Add ``run_<column>`` (up to and including the row) and ``total_<column>`` per group.

    ``df`` has one row per ``(group, key)`` with a numeric ``key``. ``splits`` affect only
    the balance of the tasks. Quantiles of the pooled groups suffice: a group then has cut
    points in proportion to its rows. A row without a key has no place in the order and is
    left out, on both sides of the join alike, so that ``df`` is computed once.
    """
    bucketed = with_range_bucket(df.where(F.col(key).isNotNull()), key, splits)
    per_bucket = bucketed.groupBy(group, "range_bucket").agg(*[F.sum(c).alias(c) for c in columns])
    before = Window.partitionBy(group).orderBy("range_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    offsets = per_bucket.select(
        group,
        "range_bucket",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in columns],
        *[F.sum(c).over(whole).alias(f"total_{c}") for c in columns],
    )
    within = Window.partitionBy(group, "range_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    running = bucketed.withColumns({f"run_{c}": F.sum(c).over(within) for c in columns})
    # At most one row per group and bucket: a few thousand rows by construction.
    joined = running.join(F.broadcast(offsets), [group, "range_bucket"])
    totals = {f"run_{c}": F.col(f"run_{c}") + F.col(f"before_{c}") for c in columns}
    return joined.withColumns(totals).drop("range_bucket", *[f"before_{c}" for c in columns])
