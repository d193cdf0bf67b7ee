"""Mixing sources to target weights: exact budgets by subset sums over document lengths."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill.llm.common import WORD, n_cells, numbered, ranked, text_of, written

#: Largest budget (words) that the knapsack table covers; larger rests are first filled greedily.
TABLE_WORDS = 1 << 17
#: Drawn documents that are released before the knapsack.
RELEASED = 64


def targets(sources: list[tuple[int, int]], weights: list[float], most: float = 3.0) -> list[float]:
    """Target words per source: shares of all words by weight, none above ``most`` times its size.

    What a source cannot take is shared among the others by weight until none is above.
    """
    total = float(sum(size for _, size in sources))
    limit = [most * size for _, size in sources]
    out = [0.0] * len(sources)
    free = set(range(len(sources)))
    while free:
        weight = sum(weights[i] for i in free)
        share = {i: total * weights[i] / weight for i in free}
        full = {i for i in free if share[i] >= limit[i]}
        for i in full or free:
            out[i] = limit[i] if full else share[i]
            total -= out[i]
        free -= full or free
    return out


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their lengths add up to the budget.

    An even draw over the ordered lengths comes within about one document of the budget. Some of
    its documents are released again, so that there is a choice. What remains is a bounded
    knapsack over the documents not taken, solved exactly by dynamic programming over sums (one
    bit per sum, table by table until the budget is met).
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget <= 0 or total == 0:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    take, seen = [], 0
    for n, c in zip(lengths, counts):
        take.append((seen + c) * budget // total - seen * budget // total)
        seen += c
    rest = budget - sum(n * t for n, t in zip(lengths, take))
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        while rest < 0 and take[i] > 0:
            take[i] -= 1
            rest += lengths[i]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if rest <= TABLE_WORDS:
            break
        more = min(counts[i] - take[i], rest // lengths[i]) if lengths[i] else 0
        take[i] += more
        rest -= more * lengths[i]
    chosen = [i for i, t in enumerate(take) for _ in range(min(t, RELEASED))]
    for i in chosen[:: max(1, len(chosen) // RELEASED)]:
        if rest + lengths[i] <= TABLE_WORDS and take[i] > 0:
            take[i] -= 1
            rest += lengths[i]
    full = (1 << (rest + 1)) - 1
    items, tables = [], [1]
    order = list(range(len(lengths)))
    random.Random(budget).shuffle(order)
    for i in order:
        free = min(counts[i] - take[i], rest // lengths[i]) if lengths[i] else 0
        size = 1
        while free > 0 and not tables[-1] >> rest & 1:
            several = min(size, free)
            items.append((i, several))
            tables.append((tables[-1] | tables[-1] << several * lengths[i]) & full)
            free -= several
            size *= 2
    sum_found = tables[-1].bit_length() - 1
    for (i, several), before in zip(reversed(items), reversed(tables[:-1])):
        if not before >> sum_found & 1:
            take[i] += several
            sum_found -= several * lengths[i]
    return take


def _fit_source(frame: pd.DataFrame) -> pd.DataFrame:
    """Repeats and number of extra documents per length of one source, from its length counts."""
    frame = frame.sort_values("size")
    words, target = int((frame["size"] * frame["n"]).sum()), float(frame["target"].iloc[0])
    repeats = int(target // words) if words else 0
    extra = fit(frame["size"].tolist(), frame["n"].tolist(), round(target - repeats * words) if words else 0)
    return frame.assign(repeats=repeats, extra=extra)[["source_no", "size", "source_size", "target", "repeats", "extra"]]


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    cycle: tuple[float, ...] = (1.0, 2.0, 3.0),
    most: float = 3.0,
    seed: int = 42,
    carry: Column | None = None,
) -> DataFrame:
    """How often the mix takes each row: doc_id, size, source_size, target, taken (and ``carry``).

    Size is the number of words (missing text: 0). Sources are ordered by code point, the missing
    one last, and weigh 1, 2, 3 in turn. They share all words by weight, none above three times
    its own. A source is repeated whole as often as its target allows. The remaining budget is a
    subset sum over its counts of documents by exact length; which documents of a length are
    taken is decided by a seeded hash of the id. ``taken`` is repeats times size.

    The driver sees one row per source. The sums are solved per source from its length counts,
    in tasks. Ranks inside a length are taken over cells, so a source or a group of copies with
    a third of all rows is dealt to many tasks.
    """
    extra = [] if carry is None else [carry.alias("carry")]
    source = F.col(source_column).cast("string")
    rows = numbered(
        docs,
        F.col(id_column).alias("doc_id"),
        F.coalesce(source, F.lit("")).alias("source"),
        source.isNull().alias("no_source"),
        F.regexp_count(text_of(text_column), F.lit(f"{WORD}+")).cast("long").alias("size"),
        *extra,
    )
    rows = written(rows, "mix-rows")
    counts = written(rows.groupBy("source", "no_source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    sums = counts.groupBy("no_source", "source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("n"))
    sources = [tuple(r) for r in sums.orderBy("no_source", "source").collect()]
    weights = [cycle[i % len(cycle)] for i in range(len(sources))]
    goals = targets([(i, int(s[2])) for i, s in enumerate(sources)], weights, most)
    plan = [(s[0], s[1], i, int(s[2]), goals[i]) for i, s in enumerate(sources)]
    schema = "no_source boolean, source string, source_no long, source_size long, target double"
    plan = docs.sparkSession.createDataFrame(plan, schema)
    classes = (
        counts.join(plan, ["no_source", "source"])
        .groupBy("source_no")
        .applyInPandas(
            _fit_source, "source_no long, size long, source_size long, target double, repeats long, extra long"
        )
    )
    classes = written(classes.join(plan.select("source_no", "source", "no_source"), "source_no"), "mix-classes")
    n_rows = sum(s[3] for s in sources)
    seeded = rows.withColumn("draw", F.xxhash64("doc_id", F.lit(seed)))
    cell = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(n_cells(n_rows)))
    placed = ranked(seeded, ["source", "no_source", "size"], ["draw", "doc_id", "row"], cell, "rank", classes)
    times = F.col("repeats") + F.when(F.col("rank") < F.col("extra"), 1).otherwise(0)
    return placed.select(
        "doc_id", "size", "source_size", "target", (times * F.col("size")).alias("taken"), *(["carry"] if extra else [])
    )
