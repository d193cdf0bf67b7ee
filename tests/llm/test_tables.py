"""Folders of intermediate tables: noted where asked for, deleted once nothing reads them."""

import os

from cardmill.llm import common


def test_only_unread_folders_go(spark):
    common.prepare(spark)
    outside = common.written(spark.range(3), "outside")
    with common.noted() as own:
        read = common.written(spark.range(5), "read")
        unread = common.written(spark.range(7), "unread")
        with common.noted() as inner:
            common.written(spark.range(2), "inner")
    assert len(own) == 2 and len(inner) == 1
    docs = read.where("id > 1").join(outside, "id")
    assert common.dropped(spark, own + inner, docs) == own[:1]
    assert docs.count() == 1 and outside.count() == 3
    folders = [f.split(":", 1)[-1] for f in own + inner]
    assert [os.path.exists(f) for f in folders] == [True, False, False]
    assert unread.schema == read.schema
