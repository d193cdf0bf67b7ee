"""Positions of matches in texts with very many of them."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from cardmill.llm import common, pii, secret_scan, spans

WORDS = "the river 12 table b@c.de a morning x@y.zz 4 window".split()


def test_positions_equal_a_plain_search(spark):
    chance, texts = random.Random(5), ["", "a", "\U0001f600 x@y.zz"]
    texts += [" ".join(chance.choices(WORDS, k=n)) for n in (1, 3, 40, 127, 128, 129, 300, 2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = df.select("i", spans.find(F.col("text"), r"[a-z]+@[a-z.]+", 7, F.lit(True)).alias("s")).collect()
    for r in found:
        want = [(7, m.start(), m.end(), m.group()) for m in re.finditer(r"[a-z]+@[a-z.]+", texts[r.i])]
        assert [(s.kind, s.start, s.end, s.value) for s in r.s] == want
        for s in r.s:  # the context ends at the next match
            assert texts[r.i][: s.start].endswith(s.left) and texts[r.i][s.end :].startswith(s.right)


def test_spans_clear_of_others(spark):
    chance, rows = random.Random(6), []
    for i in range(300):
        pair = []
        for most in (30, 40):
            starts = [chance.randrange(200) for _ in range(chance.randrange(most))]
            pair.append([(k % 3, s, s + chance.randrange(1, 9), "v", "", "") for k, s in enumerate(starts)])
        rows.append((i, *pair))
    df = spark.createDataFrame(rows, f"i int, own {spans.SPANS}, others {spans.SPANS}")
    for r in df.select("*", spans.clear_of(F.col("own"), F.col("others")).alias("free")).collect():
        want = [s for s in r.own if not any(o.start < s.end and o.end > s.start for o in r.others)]
        assert sorted(r.free) == sorted(want)


@pytest.mark.parametrize("scan, piece", [(pii.personal_data, "ab@cd.ef "), (secret_scan.secret_scan, "token=abcdefgh1234 ")])
def test_twenty_thousand_matches(spark, scan, piece):
    common.prepare(spark)
    df = spark.createDataFrame([(1, piece * 20_000), (2, "nothing")], "doc_id long, text string")
    begun = time.time()
    found = {r.doc_id: r.n for r in scan(df).select("doc_id", F.size("spans").alias("n")).collect()}
    assert found == {1: 20_000, 2: 0} and time.time() - begun < 40
