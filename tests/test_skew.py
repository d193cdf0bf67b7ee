"""Hot keys: found exactly, bounded in number, and without effect on results."""

import pytest
from pyspark.sql import functions as F

from cardmill.operators.skew import hot_keys, join_per_key


@pytest.fixture(scope="module")
def rows(spark):
    # A third of the rows belongs to one key, a tenth has none.
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))
    )
    return spark.range(3000).select("id", key.alias("card_id"))


@pytest.fixture(scope="module")
def per_key(rows):
    return rows.where("card_id != 'k5'").groupBy("card_id").agg(F.max("id").alias("top"))


def test_hot_keys(rows):
    assert [r.card_id for r in hot_keys(rows, "card_id", 500).collect()] == ["hot"]
    assert hot_keys(rows, "card_id", 10**6).count() == 0
    assert [r.card_id for r in hot_keys(rows, "card_id", 0, max_keys=4).collect()] == ["hot"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("hot_rows", [10**6, 500, 0])
def test_join_equals_plain_join(rows, per_key, how, hot_rows):
    plain = rows.join(per_key, "card_id", how)
    split = join_per_key(rows, per_key, "card_id", how, hot_rows)
    assert split.columns == plain.columns
    assert split.count() == plain.count()
    assert split.exceptAll(plain).count() == 0


def scans(df):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return final.count("FileScan")


def test_inputs_are_read_at_most_twice(rows, per_key, tmp_path, spark):
    rows.write.parquet(f"{tmp_path}/rows")
    per_key.write.parquet(f"{tmp_path}/keys")
    for hot_rows in (10**6, 0):
        stored, keys = spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/keys")
        assert scans(join_per_key(stored, keys, "card_id", "left", hot_rows)) <= 5
