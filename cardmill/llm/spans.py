"""Positions of pattern matches as column expressions. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:int,start:int,end:int,value:string,left:string,right:string>>"
#: Characters of context kept on each side of a match.
CONTEXT = 24
#: Values of a running total that are added up in one go.
BLOCK = 128


def no_spans() -> Column:
    return F.array().cast(SPANS)


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` makes of ``start`` and all values up to each one.

    Values are taken in blocks: an array that grows by one is copied each time, so only short ones do.
    """

    def grown(items: Column, first: Column) -> Column:
        every = F.aggregate(items, F.array(first), lambda done, x: F.concat(done, F.array(step(F.element_at(done, -1), x))))
        return F.slice(every, 2, F.size(items))

    def scanned(own: Column) -> Column:
        last = F.greatest(F.ceil(F.size(own) / F.lit(BLOCK)).cast("int") - 1, F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(own, i * BLOCK + 1, BLOCK))
        ends = grown(F.transform(blocks, lambda b: F.aggregate(b, start, step)), start)
        before = F.concat(F.array(start), F.slice(ends, 1, F.size(ends) - 1))
        return F.flatten(F.zip_with(blocks, before, lambda b, done: F.transform(grown(b, start), lambda x: step(done, x))))

    # Bound to a variable: an expression in a function of the elements is worked out for each of them.
    return F.element_at(F.transform(F.array(values), scanned), 1)


def find(text: Column, pattern: str, kind: int, when: Column) -> Column:
    """Leftmost non-overlapping matches as spans in code points; none where ``when`` is false.

    The text between matches and the matches themselves, laid end to end, give the positions.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    before, after = F.slice(between, 1, F.size(found)), F.slice(between, 2, F.size(found))
    ends = running(F.zip_with(before, found, lambda a, b: F.length(a) + F.length(b)), F.lit(0), lambda x, y: x + y)
    parts = F.arrays_zip(before.alias("a"), found.alias("b"), after.alias("c"), ends.alias("end"))

    def span(part: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            (part["end"] - F.length(part["b"])).alias("start"),
            part["end"].alias("end"),
            part["b"].alias("value"),
            F.right(part["a"], F.lit(CONTEXT)).alias("left"),
            F.substring(part["c"], 1, CONTEXT).alias("right"),
        )

    return F.when(when, F.transform(parts, span)).otherwise(no_spans())


def clear_of(spans: Column, others: Column) -> Column:
    """Those ``spans`` that overlap none of the ``others``.

    In the order of the others' starts and the spans' ends, a span is overlapped when one of the
    others before it reaches beyond its start.
    """
    starts = F.transform(others, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("rank"), s["end"].alias("reach"), s.alias("span")))
    stops = F.transform(spans, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("rank"), F.lit(0).alias("reach"), s.alias("span")))
    events = F.array_sort(F.concat(starts, stops))
    reach = running(F.transform(events, lambda e: e["reach"]), F.lit(0), lambda x, y: F.greatest(x, y))
    told = F.arrays_zip(events.alias("event"), reach.alias("reach"))
    free = F.filter(told, lambda t: (t["event"]["rank"] == 0) & (t["reach"] <= t["event"]["span"]["start"]))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), F.transform(free, lambda t: t["event"]["span"])).otherwise(spans)


def joined(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(n) for n in names])
    each = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", each)


def by_kind(spans: Column) -> Column:
    """In the order of kind, start, end."""
    return F.array_sort(spans)


def by_start(spans: Column) -> Column:
    """In the order of start, kind, end."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("at"), s["kind"].alias("kind"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda k: k["span"])


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
