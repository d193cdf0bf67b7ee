"""Spelling variants against a comparison of all words."""

import os
import random
import sys

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from cardmill.llm import common, spelling  # noqa: E402
from cardmill.llm.queries import QUERIES  # noqa: E402

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


def as_dict(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    want = brute.variants(brute.spelling_words(rows))
    assert as_dict(QUERIES["op12_spelling_variants"](spark, SF)) == want
    assert any(w[3] for w in want.values())


def test_words(spark):
    """Missing values, no text, copies, long runs, other letters and a clashing column."""
    common.prepare(spark)
    texts = [None, "", "  ", "Straße STRASSE naïveté÷× ÀÉÎõü", "aaaaaa Aaaaaa aaaaaab", "日本語日本語日本", "z" * 30_000, "short abcdefg-hijklmn"]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts * 12)]
    df = spark.createDataFrame([(i, t, "w", 3) for i, t in rows], "doc_id long, text string, word string, n long")
    got = {r.word: r.n for r in spelling.words(df).collect()}
    assert got == brute.spelling_words(rows)
    assert as_dict(spelling.variants(spelling.words(df))) == brute.variants(got)


@pytest.mark.parametrize("alphabet,parts", [("ab", 1), ("abé", 7), ("xyz÷ÿ", 3)])
def test_dense_words(spark, alphabet, parts):
    """Nearly all words over few letters, with runs of one letter, ties and long common beginnings."""
    common.prepare(spark)
    chance = random.Random(len(alphabet))
    counts = {}
    while len(counts) < 500:
        word = "".join(chance.choice(alphabet) for _ in range(chance.choice([1, 5, 6, 7, 8])))
        counts[chance.choice(["", "q" * 40]) + word] = int(5 ** chance.uniform(1, 7))
    counts |= {"a" * k: k**3 for k in range(6, 40)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(parts)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts + 1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = as_dict(spelling.variants(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute.variants(counts)
    assert any(form for form, *_ in got.values())


def test_no_words(spark):
    common.prepare(spark)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert as_dict(spelling.variants(spelling.words(empty))) == {}
    odd = spark.createDataFrame([(None, 7), ("", 8)], "word string, n long")
    assert as_dict(spelling.variants(odd)) == {}
