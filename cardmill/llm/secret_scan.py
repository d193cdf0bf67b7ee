"""Secrets: stated patterns, and character Markov models of random strings against ordinary
identifiers. DataFrame functions only."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill.llm.common import hash_share, numbered, text_of, written
from cardmill.llm.spans import by_start, clear_of, count_kind, find, joined

KINDS = ["assign", "access", "hex", "random"]
ASSIGN, ACCESS, HEX, RANDOM = range(4)
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_="
OTHER = len(ALPHABET)

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]++"""
_ASSIGNED = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=\-]+)$"""
_ACCESS = r"AKIA[A-Z0-9]{14,}+"
_HEX = r"[0-9a-f]{16,}+"
_RANDOM = r"(?:\G|(?<![A-Za-z0-9+/_=\-]))[A-Za-z0-9+/_=\-]{12,}+"
_NAME = r"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9_]{4,11}+(?![A-Za-z0-9+/_=\-])"

#: Labelled samples of the two models: documents that ordinary names are taken from, and stated
#: secrets. Both are chosen by a hash.
NAME_DOCS, SECRETS = 3000, 20_000
#: Least mean log-likelihood ratio per character pair of a reported string, and least sum of all
#: its pairs: the fewer pairs a string has, the clearer each must be.
LEAST, LEAST_SUM = 1.0, 19.0


def base_spans(text: Column) -> Column:
    """Spans of the stated patterns: assign, access, hex."""
    assign = find(text, _ASSIGN, ASSIGN, text.rlike("[:=]"))
    long = F.filter(assign, lambda s: F.length(F.regexp_extract(s["value"], _ASSIGNED, 1)) >= 12)
    return F.concat(long, find(text, _ACCESS, ACCESS, text.contains("AKIA")), find(text, _HEX, HEX, text.rlike(_HEX)))


def pairs(value: Column) -> Column:
    """Numbers of the character pairs of a string."""
    places = F.transform(F.split(value, ""), lambda c: F.when(c == "", None).otherwise(F.position(c, F.lit(ALPHABET))))
    places = F.transform(F.filter(places, lambda p: p.isNotNull()), lambda p: F.when(p == 0, OTHER).otherwise(p - 1))
    steps = F.arrays_zip(F.slice(places, 1, F.greatest(F.size(places) - 1, F.lit(0))).alias("a"), F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))).alias("b"))
    return F.transform(steps, lambda p: p["a"] * (OTHER + 1) + p["b"])


def ratios(random: dict[int, int], ordinary: dict[int, int], prior: float = 0.5, backing: float = 5.0) -> list[float]:
    """Log-likelihood ratio per character pair of two first-order models.

    Chances of a character after another lean on its chance anywhere (weight ``backing``), and
    that on a flat one. Without samples of random strings their model is flat, as it should be.
    A pair without a letter says nothing: a number or date is no key, however random.
    """
    other = [i for i in range(OTHER + 1) if not ALPHABET[i : i + 1].isalpha()]
    size = OTHER + 1

    def model(counts: dict[int, int]) -> list[float]:
        single = [prior + sum(counts.get(a * size + b, 0) for a in range(size)) for b in range(size)]
        anywhere = [x / sum(single) for x in single]
        out = []
        for a in range(size):
            row = [counts.get(a * size + b, 0) + backing * anywhere[b] for b in range(size)]
            total = sum(row)
            out += [math.log(x / total) for x in row]
        return out

    told = [r - o for r, o in zip(model(random), model(ordinary))]
    for a in other:
        for b in other:
            told[a * size + b] = 0.0
    return told


def score(value: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio over the string's character pairs."""
    weights = F.from_json(F.lit(json.dumps([round(x, 6) for x in table])), "array<double>")
    own = pairs(value)
    total = F.aggregate(own, F.lit(0.0), lambda done, pair: done + F.element_at(weights, pair + 1))
    return F.when(F.size(own) > 0, total / F.size(own)).otherwise(F.lit(0.0))


def random_string(value: Column, table: list[float]) -> Column:
    mean = score(value, table)
    return (mean >= LEAST) & (mean * F.greatest(F.length(value) - 1, F.lit(0)) >= LEAST_SUM)


def train(texts: DataFrame, found: DataFrame, n_docs: int) -> list[float]:
    """The ratio table from labelled samples, as counts of at most 67 * 67 pairs per model.

    Random strings are the values of stated secrets (their keyword cut off); ordinary ones are
    the names and words of fewer than 12 characters, which are not scored, in documents without any.
    """

    def sampled(rows: DataFrame, n: int, most: int, *key: str) -> DataFrame:
        return rows.where(F.xxhash64(*key) <= F.lit(hash_share(n, most)))

    def counted(values: DataFrame) -> dict[int, int]:
        each = values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(F.explode(pairs(F.col("value"))).alias("pair"), "n")
        return dict(tuple(r) for r in each.groupBy("pair").agg(F.sum("n")).collect())

    assigned = F.regexp_extract("span.value", _ASSIGNED, 1)
    secrets = found.select(F.explode("base").alias("span")).select(F.when(F.col("span.kind") == ASSIGN, assigned).otherwise(F.col("span.value")).alias("value"))
    secrets = secrets.distinct()  # a copied secret is one sample
    random = sampled(secrets, secrets.count(), SECRETS, "value")
    stated = F.col("text").rlike(_HEX) | F.col("text").rlike(_ASSIGN) | F.col("text").rlike(_ACCESS)
    plain = sampled(texts, n_docs, NAME_DOCS, "doc_id").where(~stated)
    names = plain.select(F.explode(F.regexp_extract_all("text", F.lit(_NAME), F.lit(0))).alias("value"))
    return ratios(counted(random), counted(names))


def secret_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of secrets per row: doc_id, base (stated patterns) and spans (all, by start).

    Strings of 12 or more characters of ``[A-Za-z0-9+/_=-]`` that overlap no stated span are
    added (kind ``random``) when the Markov model of random strings explains them better than
    that of ordinary names by at least 1.0 a character pair and 19 in all. Missing texts have no spans;
    repeated rows are judged alike; without stated secrets the random model is flat.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    text = F.col("text")
    more = find(text, _RANDOM, RANDOM, text.rlike(r"[A-Za-z0-9+/_=\-]{12}"))
    found = numbered(texts, F.col("doc_id"), base_spans(text).alias("base"), more.alias("more"))
    found = written(found.withColumn("more", clear_of(F.col("more"), F.col("base"))), "secret-spans")
    table = train(texts, found, found.count())
    added = F.filter("more", lambda s: random_string(s["value"], table))
    spans = F.when(F.size("more") > 0, F.concat("base", added)).otherwise(F.col("base"))
    return found.select("doc_id", by_start(F.col("base")).alias("base"), by_start(spans).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and hashes of the spans per row."""
    counts = [count_kind(F.col("base"), i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])]
    base = F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, joined(F.col("spans"), KINDS).alias("spans"))
