"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs
them, a classifier trained on the result decides. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill.llm.common import numbered, text_of, written
from cardmill.llm.spans import by_kind, clear_of, count_kind, find, joined, no_spans

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)

# The stated patterns. Possessive repeats and the guards before a match change no result: what
# they skip cannot match. They keep the time linear and the stack flat on very long runs.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[ \-]?[0-9]){15,}+"
_PHONE = r"\+[0-9][ ().0-9\-]+[0-9]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"

# Candidates beyond the stated kinds: spelled-out mail addresses and numbers written like a
# telephone or card number.
_SPELLED = r"[A-Za-z0-9._%+\-]++ ?[\[(]at[\])] ?[A-Za-z0-9\-]++(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9\-]++)++"
_NUMBER = r"(?<![0-9A-Za-z.+\-])\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}(?![0-9A-Za-z\-])"
_GROUPED = r"(?<![0-9A-Za-z.+\-])[0-9]{4}(?:[ .\-][0-9]{4}){2}[ .\-][0-9]{3,7}(?![0-9A-Za-z\-])"

CONTEXT_WORDS = {
    EMAIL: r"(?i)\b(?:e-?mail|mail|contact|write)\b",
    IP: r"(?i)\b(?:ip|host|server|address|login)\b",
    CARD: r"(?i)\b(?:card|visa|credit|payment|account)\b",
    PHONE: r"(?i)\b(?:tel|phone|call|fax|mobile|contact|cell)\b",
}
OTHER_WORDS = r"(?i)(?:\b(?:id|no|order|isbn|issn|version|page|total|price|part|serial|item)\b[ .:#]*$)"
#: Gazetteers: domains of mail providers, first digits of card issuers, free-call prefixes.
MAIL_DOMAINS = ["gmail", "yahoo", "hotmail", "outlook", "icloud", "proton", "example", "gmx", "aol"]
CARD_STARTS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
AREA_STARTS = r"^(?:800|888|877|866|855|212|213|310|312|415|617|646|702|718)"

LABELERS = ["pattern", "context", "other_context", "gazetteer", "checksum"]
#: Spans with at least this probability are added.
LEAST = 0.9


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit holds."""
    places = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(places, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans of the stated patterns: email, ip, card, phone."""
    email = find(text, _EMAIL, EMAIL, text.contains("@"))
    ip = F.filter(find(text, _IP, IP, text.rlike(r"[0-9]\.[0-9]")), lambda s: s["value"].rlike(rf"^(?:{_PART}\.){{3}}{_PART}$"))
    card = F.filter(find(text, _CARD, CARD, text.rlike(r"[0-9][ \-]?[0-9][ \-]?[0-9]")), lambda s: (F.length(_digits(s["value"])) <= 19) & luhn(_digits(s["value"])))
    phone = F.filter(find(text, _PHONE, PHONE, text.contains("+")), lambda s: F.length(_digits(s["value"])).between(8, 15))
    return F.concat(email, ip, card, phone)


def more_spans(text: Column) -> Column:
    """Candidates of the labelers beside the stated patterns."""
    spelled = find(text, _SPELLED, EMAIL, text.rlike(r"[\[(]at[\])]"))
    number = find(text, _NUMBER, PHONE, text.rlike(r"[0-9]{3}[ .\-][0-9]{4}"))
    grouped = find(text, _GROUPED, CARD, text.rlike(r"[0-9]{4}[ .\-][0-9]{4}"))
    return F.concat(spelled, number, grouped)


def votes(span: Column, stated: Column) -> dict[str, Column]:
    """Each labeler's vote: 1 personal, 0 not, null no opinion."""
    value, kind = span["value"], span["kind"]
    digits = _digits(value)
    near = F.lit(False)
    for number, words in CONTEXT_WORDS.items():
        near = near | ((kind == number) & (span["left"].rlike(words) | span["right"].rlike(words)))
    known = (
        F.when(kind == EMAIL, F.when(F.lower(value).rlike("|".join(MAIL_DOMAINS)), 1))
        .when(kind == CARD, F.when(digits.rlike(CARD_STARTS), 1).otherwise(0))
        .when(kind == PHONE, F.when(digits.rlike(AREA_STARTS), 1))
    )
    plain = digits.rlike(r"^([0-9])\1*$") | F.lit("01234567890123456789").contains(digits)
    return {
        "pattern": F.when(stated, 1),
        "context": F.when(near, 1),
        "other_context": F.when(span["left"].rlike(OTHER_WORDS), 0),
        "gazetteer": known,
        "checksum": F.when(kind == CARD, luhn(digits).cast("int")).when((kind == PHONE) & plain, 0),
    }


#: Votes that each labeler is taken to have cast before any data: right six, wrong one, none five.
PRIOR = {1: (6.0, 1.0), 0: (1.0, 6.0), None: (5.0, 5.0)}


def reliabilities(counts: list[tuple[tuple, int]], rounds: int = 50) -> tuple[float, list[dict]]:
    """Share of personal spans, and per labeler the chance of each vote on (personal, other) spans.

    Expectation-maximisation over counted vote patterns. Spans of the stated patterns (first
    labeler) are known to be personal and anchor it; no opinion counts as a vote of its own.
    """
    share, rates = 0.5, [{v: (a / 12, b / 12) for v, (a, b) in PRIOR.items()} for _ in LABELERS]
    for _ in range(rounds):
        sums = [{v: list(p) for v, p in PRIOR.items()} for _ in LABELERS]
        positive, total = 1.0, 2.0
        for pattern, n in counts:
            p = posterior(pattern, share, rates)
            positive, total = positive + n * p, total + n
            for vote, s in zip(pattern, sums):
                s[vote][0] += n * p
                s[vote][1] += n * (1 - p)
        share = positive / total
        rates = []
        for s in sums:
            own, other = (sum(p[k] for p in s.values()) for k in (0, 1))
            rates.append({v: (p[0] / own, p[1] / other) for v, p in s.items()})
    return share, rates


def posterior(pattern: tuple, share: float, rates: list[dict]) -> float:
    """Probability of a personal span given the votes."""
    if pattern[0] == 1:
        return 1.0
    odds = math.log(share / (1 - share))
    for vote, rate in zip(pattern[1:], rates[1:]):
        odds += math.log(rate[vote][0] / rate[vote][1])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


FEATURES = ["kind", "context", "other_context", "grouped", "known", "valid"]


def features(span: Column) -> dict[str, Column]:
    """What the classifier sees of a span: its kind, surroundings and shape, not the votes."""
    vote = votes(span, F.lit(False))
    return {
        "kind": span["kind"],
        "context": F.coalesce(vote["context"], F.lit(0)),
        "other_context": F.when(vote["other_context"].isNotNull(), 1).otherwise(0),
        "grouped": span["value"].rlike(r"[ .()\-]").cast("int"),
        "known": F.coalesce(vote["gazetteer"] + 1, F.lit(0)),
        "valid": F.coalesce(vote["checksum"] + 1, F.lit(0)),
    }


def fit_classifier(rows: list[tuple[tuple, float, float]], rounds: int = 400, penalty: float = 0.05) -> dict[tuple[str, int], float]:
    """Logistic regression over (feature, value) pairs on expected labels.

    ``rows`` are (features, number of spans, expected number of personal ones).
    """
    weights: dict[tuple[str, int], float] = {("bias", 0): 0.0}
    total = sum(n for _, n, _ in rows) or 1.0
    active = [([("bias", 0), *zip(FEATURES, f)], n / total, p / total) for f, n, p in rows]
    for keys, _, _ in active:
        weights.update({k: 0.0 for k in keys if k not in weights})
    for _ in range(rounds):
        slope = {k: -penalty * w / max(1.0, total) for k, w in weights.items()}
        for keys, n, p in active:
            error = p - n / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[k] for k in keys)))))
            for k in keys:
                slope[k] += error
        for k in weights:
            weights[k] += 2.0 * slope[k]
    return weights


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of personal data per row: doc_id, base (of the stated patterns) and spans (all).

    Five labelers (pattern, two of context, gazetteer, checksum) vote on every stated span and
    every further candidate. Counts of vote patterns (at most 3^5) give their reliabilities, the
    expected labels train a classifier over the spans' features (at most 4 * 2^3 * 3^2 kinds),
    and a candidate above 0.9 that overlaps no stated span is added. Stated spans always stay.
    A missing text has no spans; repeated rows are judged alike; a corpus without spans adds none.
    Spans are structs of kind, start, end (code points, end exclusive) and value.
    """
    text = text_of(text_column)
    rows = numbered(docs, F.col(id_column).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "row", base_spans(F.col("text")).alias("base"), more_spans(F.col("text")).alias("more"))
    rows = rows.withColumn("more", clear_of(F.col("more"), F.col("base")))
    rows = written(rows, "pii-spans")
    stated = rows.select("row", F.explode("base").alias("span"), F.lit(True).alias("stated"))
    further = rows.select("row", F.explode("more").alias("span"), F.lit(False).alias("stated"))
    spans = stated.unionByName(further)
    voted = spans.select(*[v.alias(k) for k, v in votes(F.col("span"), F.col("stated")).items()])
    counts = [(tuple(r[:-1]), r[-1]) for r in voted.groupBy(*LABELERS).count().collect()]
    share, rates = reliabilities(sorted(counts, key=str))
    seen = spans.select(
        *[v.alias(f"v_{k}") for k, v in votes(F.col("span"), F.col("stated")).items()],
        *[v.alias(f"f_{k}") for k, v in features(F.col("span")).items()],
    )
    grouped = seen.groupBy(*seen.columns).count().collect()
    train: dict[tuple, list[float]] = {}
    for r in grouped:
        cell = train.setdefault(tuple(r[len(LABELERS) : -1]), [0.0, 0.0])
        cell[0] += r[-1]
        cell[1] += r[-1] * posterior(tuple(r[: len(LABELERS)]), share, rates)
    weights = fit_classifier([(k, n, p) for k, (n, p) in sorted(train.items())])

    def personal(span: Column) -> Column:
        score = F.lit(weights[("bias", 0)])
        for name, value in features(span).items():
            own = F.lit(0.0)
            for (feature, level), weight in weights.items():
                if feature == name:
                    own = F.when(value == level, F.lit(weight)).otherwise(own)
            score = score + own
        return score >= math.log(LEAST / (1 - LEAST))

    added = F.when(F.size("more") > 0, F.filter("more", personal)).otherwise(no_spans())
    spans = by_kind(F.concat("base", added))
    return rows.select("doc_id", by_kind(F.col("base")).alias("base"), spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and hashes of the spans per row."""
    counts = [count_kind(F.col("base"), i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    base = F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, joined(F.col("spans"), KINDS).alias("spans"))
