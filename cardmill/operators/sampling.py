"""Seeded samples and the stratified split (L3, L4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BUCKETS = 65_536


HASH_BITS = 60


def hash_order(key: str, seed: int) -> Column:
    """A fixed pseudo-random order of the keys, the same in any SQL engine: the first 60 bits of
    the MD5 of ``seed:key``."""
    text = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def seeded_sample(df: DataFrame, key: str, n: int = 2000, seed: int = 42) -> DataFrame:
    """L3: the ``n`` rows with the smallest hashes, however the table is partitioned.

    An ordered limit alone would bring ``n`` rows of every partition to one task. Counts per
    hash range (at most 65,536) first give the hash below which the ``n`` rows lie; only those
    few are ordered.
    """
    order = hash_order(key, seed)
    hash_range = F.shiftright(order, HASH_BITS - 16)
    counts = df.groupBy(hash_range.alias("hash_range")).agg(F.count(F.lit(1)).alias("rows"))
    so_far = Window.orderBy("hash_range").rowsBetween(Window.unboundedPreceding, 0)
    totals = counts.withColumn("upto", F.sum("rows").over(so_far))
    last = totals.agg(F.coalesce(F.min(F.when(F.col("upto") >= n, F.col("hash_range"))), F.max("hash_range"))).scalar()
    return df.where(hash_range <= last).orderBy(order, key).limit(n)


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42, output: str = "is_test"
) -> DataFrame:
    """L4: flag an exact share of each label as test rows; ``key`` is unique.

    The test size is the ceiling of ``n * share``, given to the labels in proportion with
    the largest remainders rounded up. The rows of a label with the smallest hashes are its
    test rows. Only the hash of the last one has to be found: counts per hash bucket locate
    the bucket it lies in and only that bucket is ranked. The table itself is not shuffled;
    every row is compared with the cutoff of its label.
    """
    order = hash_order(key, seed)
    bucket = F.shiftright(order, HASH_BITS - 16)
    keyed = df.select(F.col(label), F.col(key), order.alias("hash"), bucket.alias("bucket"))

    per_bucket = keyed.groupBy(label, "bucket").agg(F.count(F.lit(1)).alias("n"))
    per_label = per_bucket.groupBy(label).agg(F.sum("n").alias("label_rows"))
    everything = Window.partitionBy()  # one row per label
    exact = F.ceil(F.col("rows") * F.lit(test_share)) * F.col("label_rows") / F.col("rows")
    sized = (
        per_label.withColumn("rows", F.sum("label_rows").over(everything))
        .withColumn("exact", exact)
        .withColumn("missing", F.ceil(F.col("rows") * F.lit(test_share)) - F.sum(F.floor("exact")).over(everything))
        .withColumn(
            "place",
            F.row_number().over(everything.orderBy(F.desc(F.col("exact") - F.floor("exact")), F.asc(label))),
        )
        .select(label, (F.floor("exact") + F.when(F.col("place") <= F.col("missing"), 1).otherwise(0)).alias("quota"))
    )
    so_far = Window.partitionBy(label).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        per_bucket.withColumn("upto", F.sum("n").over(so_far))
        .join(F.broadcast(sized), label)
        .where((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
        .select(label, F.col("bucket").alias("edge_bucket"), (F.col("quota") - F.col("upto") + F.col("n")).alias("take"))
    )
    ranked = Window.partitionBy(label).orderBy("hash", key)
    cutoff = (
        keyed.join(F.broadcast(edge), label)
        .where(F.col("bucket") == F.col("edge_bucket"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") == F.col("take"))
        .select(label, F.struct(F.col("hash"), F.col(key).alias("key")).alias("cutoff"))
    )
    # One row per label.
    flagged = df.join(F.broadcast(cutoff), label, "left")
    in_test = F.coalesce(F.struct(order.alias("hash"), F.col(key).alias("key")) <= F.col("cutoff"), F.lit(False))
    return flagged.withColumn(output, in_test).select(*df.columns, output)
