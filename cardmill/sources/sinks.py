"""Sinks and versioned tables.

Object stores need no separate sync: give an ``s3a://`` path.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmill.functions.columns import date_parts
from cardmill.operators.retrieval import latest_per_key


def write_lakehouse(df: DataFrame, path: str, run_time: dt.datetime) -> None:
    """One ``year=/month=/day=`` partition of the run's date, replaced on a second run."""
    stamped = df.withColumns(date_parts(F.lit(run_time)))
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day")
        .parquet(path)
    )


def write_current(df: DataFrame, path: str) -> None:
    """The single current table."""
    df.write.mode("overwrite").parquet(path)


def write_batch_quarantine(df: DataFrame, path: str, run_date: dt.date) -> None:
    """Rejected rows by run date; earlier dates stay."""
    (
        df.withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )


def write_report(report: DataFrame, path: str) -> None:
    """A nested report row as JSON."""
    report.write.mode("overwrite").json(path)


def committed(spark: SparkSession, folder: str, part: str) -> list[int]:
    """Numbers ``n`` of the ``<part>=n`` folders whose write was completed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{part}=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


class BatchParts:
    """A table in one folder per numbered batch.

    A batch that is repeated after a failure replaces its own folder, and readers see only
    completed folders, so each batch counts once.
    """

    def __init__(self, path: str, schema: T.StructType, part: str = "batch_id", day: str | None = None):
        self.path, self.schema, self.part, self.day = path, schema, part, day

    def write(
        self, df: DataFrame, number: int, partition_by: tuple[str, ...] = (), folders: tuple[str, ...] = ()
    ) -> None:
        """Write a batch, in folders by ``partition_by``, or by ``folders`` with the rows left where
        they are. A table with a ``day`` column also notes, in one folder per day, the batches that
        have rows of it."""
        if partition_by:
            # Adaptive execution sizes the files and splits a large partition value.
            rows = df.hint("rebalance", *partition_by)
        else:
            rows = df
        rows.write.mode("overwrite").partitionBy(*partition_by, *folders).parquet(f"{self.path}/{self.part}={number}")
        if self.day:
            fs, spark = None, df.sparkSession
            for row in df.select(F.col(self.day).cast("string")).distinct().toLocalIterator():
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_days/{row[0]}/{number}")
                fs = fs or path.getFileSystem(spark._jsc.hadoopConfiguration())
                fs.create(path, True).close()

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_days/{folder}*")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return [status.getPath().getName() for status in found]

    def days(self, spark: SparkSession) -> list[str]:
        """Days that any batch has rows of."""
        return sorted(self._names(spark, ""))

    def read_days(self, spark: SparkSession, days: list[str], before: int) -> DataFrame:
        """Rows of some days in earlier batches; lists and opens no folder of any other day."""
        paths = [
            f"{self.path}/{self.part}={number}/{self.day}={day}"
            for day in days
            for number in sorted(int(n) for n in self._names(spark, f"{day}/"))
            if number < before
        ]
        return self._load(spark, paths)

    def delete(self, spark: SparkSession, numbers: list[int]) -> None:
        for n in numbers:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.part}={n}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def numbers(self, spark: SparkSession, after: int = -1, before: int | None = None) -> list[int]:
        return [
            n for n in committed(spark, self.path, self.part) if n > after and (before is None or n < before)
        ]

    def read(self, spark: SparkSession, after: int = -1, before: int | None = None) -> DataFrame:
        return self._load(spark, [f"{self.path}/{self.part}={n}" for n in self.numbers(spark, after, before)])

    def _load(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        if not paths:
            # A constant-false filter, unlike an empty frame, is removed from the plan.
            nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            return spark.range(1).where(F.lit(False)).select(*nulls)
        read = spark.read.schema(self.schema).option("basePath", self.path)
        return read.parquet(*paths).select(self.schema.fieldNames())


BUCKET = "bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, keys: list, buckets: int) -> list[int]:
    """Buckets that the rows of some keys lie in."""
    if not keys:
        return []
    one = F.explode(F.array(*[F.lit(str(key)) for key in keys])).alias("key")
    return [row[0] for row in spark.range(1).select(one).select(bucket_of(F.col("key"), buckets)).distinct().collect()]


def bucket_folders(spark: SparkSession, path: str, numbers: list[int]) -> list[str]:
    """Folders of the given buckets that exist."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}={{{','.join(map(str, numbers))}}}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return [status.getPath().toString() for status in found]


class KeyedTable:
    """Rows laid out for look-ups by key.

    A key's hash names its folder, so a look-up lists and opens that folder only; the files are
    sorted by key, so it decodes few pages of them. The rows of a hot key are cut into several files.
    """

    def __init__(self, path: str, schema: T.StructType, key: str, buckets: int = 64):
        self.path, self.schema, self.key, self.buckets = path, schema, key, buckets

    def write(self, df: DataFrame) -> None:
        """Replace the table. Missing keys are stored, too, in the folder of the empty key."""
        stored = df.select(self.schema.fieldNames())
        placed = stored.withColumn(BUCKET, bucket_of(F.coalesce(F.col(self.key).cast("string"), F.lit("")), self.buckets))
        # Adaptive execution splits a bucket that is too large for one file.
        rows = placed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, self.key)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path).select(self.schema.fieldNames())

    def lookup(self, spark: SparkSession, keys: list) -> DataFrame:
        """All rows of the given keys."""
        folders = bucket_folders(spark, self.path, buckets_of(spark, keys, self.buckets)) if keys else []
        if not folders:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
        return rows.where(F.col(self.key).isin([str(key) for key in keys])).select(self.schema.fieldNames())


class OnlineTable:
    """The latest vector per key, as a compacted base and one delta per batch.

    A batch writes only its own keys. Reading takes the newest of base and deltas; every
    ``compact_every`` batches they are merged into a new base version. Nothing is updated in
    place, so a failed writer leaves the last complete version readable. The base is cut into
    ``buckets`` by the key's hash and sorted by key, so look-ups open the files of their keys only;
    deltas are small and there are at most ``compact_every`` of them.
    """

    def __init__(
        self,
        path: str,
        schema: T.StructType,
        key: str,
        order: tuple[str, ...],
        compact_every: int = 20,
        buckets: int = 64,
    ):
        self.key, self.order, self.compact_every, self.buckets = key, order, compact_every, buckets
        self.base = BatchParts(f"{path}/base", schema, "version")
        self.delta = BatchParts(f"{path}/delta", schema)

    def upsert(self, updates: DataFrame, batch_id: int) -> None:
        self.delta.write(latest_per_key(updates, self.key, *self.order).sortWithinPartitions(self.key), batch_id)

    def next_number(self, spark: SparkSession) -> int:
        """The number after the last one stored."""
        return max([-1, *self.base.numbers(spark)[-1:], *self.delta.numbers(spark)[-1:]]) + 1

    def _rows(self, spark: SparkSession, before: int | None, buckets: list[int] | None = None) -> DataFrame:
        versions = self.base.numbers(spark, before=before)
        if not versions:
            return self.delta.read(spark, before=before)
        newest = versions[-1]
        path = f"{self.base.path}/{self.base.part}={newest}"
        base = self.base._load(spark, [path] if buckets is None else bucket_folders(spark, path, buckets))
        return base.unionByName(self.delta.read(spark, after=newest, before=before))

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        return latest_per_key(self._rows(spark, before), self.key, *self.order)

    def lookup(self, spark: SparkSession, keys: list, before: int | None = None) -> DataFrame:
        """The newest row of each given key that has one."""
        rows = self._rows(spark, before, buckets_of(spark, keys, self.buckets))
        return latest_per_key(rows.where(F.col(self.key).isin([str(key) for key in keys])), self.key, *self.order)

    def newest(self, spark: SparkSession, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """Only the key and its newest order value; reads two columns.

        With ``keys``, a frame that has the key column, only the base files that can hold them
        are read; at most one number per bucket reaches the driver for that.
        """
        buckets = None
        if keys is not None and self.base.numbers(spark, before=before):
            own = keys.where(F.col(self.key).isNotNull()).select(bucket_of(F.col(self.key), self.buckets)).distinct()
            buckets = [row[0] for row in own.collect()]
        return self._rows(spark, before, buckets).groupBy(self.key).agg(F.max(self.order[0]).alias("newest"))

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """Merge everything up to and including ``batch_id`` into a new base version.

        What the version before the new one already held is deleted, so the table keeps two
        versions and the deltas since the older one; a reader of the older version is not cut off.
        """
        older = self.base.numbers(spark, before=batch_id)
        merged = self.read(spark, before=batch_id + 1)
        merged = merged.withColumn(BUCKET, bucket_of(F.coalesce(F.col(self.key).cast("string"), F.lit("")), self.buckets))
        merged = merged.repartition(BUCKET).sortWithinPartitions(BUCKET, self.key)
        self.base.write(merged, batch_id, folders=(BUCKET,))
        if older:
            self.base.delete(spark, self.base.numbers(spark, before=older[-1]))
            self.delta.delete(spark, self.delta.numbers(spark, before=older[-1] + 1))

    def compact_if_due(self, spark: SparkSession, batch_id: int) -> None:
        versions = self.base.numbers(spark)
        last = versions[-1] if versions else -1
        if batch_id - last >= self.compact_every:
            self.compact(spark, batch_id)
