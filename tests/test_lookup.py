"""Look-ups that open only the files of their keys."""

import os

from pyspark.sql import functions as F

from cardmill.sources.sinks import KeyedTable, OnlineTable

SCHEMA = "card_id string, t int, v double"


def rows(spark, n, cards=500, t=1):
    return spark.range(n).select(
        (F.col("id") % cards).cast("string").alias("card_id"), F.lit(t).alias("t"), F.col("id").cast("double").alias("v")
    )


def files_below(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)


def test_keyed_table_opens_one_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable(path, rows(spark, 1).schema, "card_id", buckets=32)
    table.write(rows(spark, 5000).unionByName(spark.createDataFrame([(None, 7, 1.0), ("", 8, 2.0)], SCHEMA)))
    found = table.lookup(spark, ["17"])
    assert sorted(r.v for r in found.collect()) == [float(v) for v in range(17, 5000, 500)]
    opened = [f for f in found.inputFiles()]
    assert len(opened) == 1 and files_below(path) >= 32
    assert found.select(F.input_file_name()).distinct().count() == 1
    assert table.lookup(spark, ["no such card"]).count() == 0 and table.lookup(spark, []).count() == 0
    assert [r.t for r in table.lookup(spark, [""]).collect()] == [8]
    assert table.read(spark).count() == 5002


def test_hot_card_is_cut_into_files(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = rows(spark, 60_000, cards=1).unionByName(rows(spark, 1000, cards=50)).repartition(8)
    table = KeyedTable(path, hot.schema, "card_id", buckets=4)
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "50000")
    try:
        table.write(hot)
    finally:
        spark.conf.set(name, before)
    found = table.lookup(spark, ["0"])
    assert found.count() == 60_020 and len(found.inputFiles()) > 1


def test_online_lookup_reads_base_files_of_its_cards(spark, tmp_path):
    path = str(tmp_path / "o")
    table = OnlineTable(path, rows(spark, 1).schema, "card_id", ("t", "v"), compact_every=2, buckets=16)
    for number in range(3):
        table.upsert(rows(spark, 1000, t=number), number)
        table.compact_if_due(spark, number)
    table.upsert(spark.createDataFrame([("17", 9, 1.0), ("new", 9, 2.0)], SCHEMA), 3)
    found = table.lookup(spark, ["17", "18", "new", "none"])
    assert {(r.card_id, r.t, r.v) for r in found.collect()} == {("17", 9, 1.0), ("18", 2, 518.0), ("new", 9, 2.0)}
    base = [f for f in table.lookup(spark, ["18"]).inputFiles() if "/base/" in f]
    assert len(base) == 1 and files_below(f"{path}/base") == 16
    newest = table.newest(spark, keys=spark.createDataFrame([("17",), ("17",), (None,)], "card_id string"))
    assert {r.card_id: r.newest for r in newest.collect()}["17"] == 9
    assert len([f for f in newest.inputFiles() if "/base/" in f]) == 1
    assert table.read(spark).count() == 501
