"""Conversation repair: the cheapest row edits that make the roles alternate.

A path through a graph of edits has one whole number as its weight. The high digits are its cost.
The low digits, three bits each, are the letters of its edits from the first place on, with zeros
after the last, so the smallest number is the cheapest path and, among those, the one whose letters
come first in ASCII order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmill.llm.common import SPACE, attach, written

#: Letters by digit; zero is the padding behind the last letter.
LETTERS = "0DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
DIGIT = 3
#: States of ``(s?(ua)+)?``: nothing yet, after a first s, after u, after a. Two of them may end.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
STATES, ENDS = range(4), (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: Rows of a conversation that are searched at once; longer ones are joined from such parts.
PART_ROWS = 256

#: Start and end state -> cost and, by number of letters, the digits of the cheapest path.
Ways = dict[tuple[int, int], tuple[int, dict[int, int]]]


def _offer(ways: dict, key, cost: int, count: int, digits: int) -> None:
    """Take a path unless a cheaper one is known; equally cheap ones stay by number of letters."""
    known = ways.get(key)
    if known is None or cost < known[0]:
        ways[key] = (cost, {count: digits})
    elif cost == known[0]:
        digits_of = known[1]
        digits_of[count] = min(digits, digits_of.get(count, digits))


def _search(rows: list[tuple[str, bool, bool]], start: int, width: int) -> dict[int, dict[int, int]]:
    """Least weight by state and number of inserted rows, over all edits of the rows from ``start``.

    A row is its role's initial, whether it has to go and whether it is cut off. An edge adds its
    cost above ``width`` digits and its letter at its place, which rows and inserts before it fix.
    """
    high = DIGIT * width
    edges = [(role, STEP[state, role], state) for state, role in STEP]
    by_state: dict[int, list] = {s: [] for s in STATES}
    for role, to, state in edges:
        by_state[state].append((role, to))

    def relaxed(nodes: dict[int, dict[int, int]]) -> dict[int, dict[int, int]]:
        """Only the cheapest weights of each state; equally cheap ones with other inserts stay."""
        kept = {}
        for state, weights in nodes.items():
            if len(weights) > 1:
                cost = min(w >> high for w in weights.values())
                weights = {j: w for j, w in weights.items() if w >> high == cost}
            kept[state] = weights
        return kept

    def put(nodes: dict[int, dict[int, int]], state: int, inserts: int, weight: int) -> None:
        weights = nodes.setdefault(state, {})
        if inserts not in weights or weight < weights[inserts]:
            weights[inserts] = weight

    def inserted(nodes: dict[int, dict[int, int]], before: int) -> dict[int, dict[int, int]]:
        """With rows put in after ``before`` edited rows; two in a row already reach every state."""
        for _ in range(2):
            wider = {state: dict(weights) for state, weights in nodes.items()}
            for state, weights in nodes.items():
                for j, weight in weights.items():
                    letter = INSERT << high - DIGIT * (before + j + 1)
                    for role, to in by_state[state]:
                        if role in ROLES:
                            put(wider, to, j + 1, weight + (INSERT_COST << high) + letter)
            nodes = relaxed(wider)
        return nodes

    nodes = inserted({start: {0: 0}}, 0)
    for i, (initial, forced, cut) in enumerate(rows):
        after: dict[int, dict[int, int]] = {}
        stays = TRUNCATED_COST if cut else 0
        for state, weights in nodes.items():
            for j, weight in weights.items():
                place = high - DIGIT * (i + j + 1)
                put(after, state, j, weight + (DELETE_COST << high) + (DELETE << place))
                if forced:
                    continue
                for role, to in by_state[state]:
                    if role == initial:
                        put(after, to, j, weight + (stays << high) + (KEEP << place))
                    if role in ROLES:
                        put(after, to, j, weight + (REROLE_COST + stays << high) + (REROLE << place))
        nodes = inserted(relaxed(after), i + 1)
    return nodes


def ways_of(rows: list[tuple[str, bool, bool]], starts=STATES) -> Ways:
    """The cheapest edits of the rows from each start state to each end state."""
    width = 3 * len(rows) + 2  # at most two inserts before each row and behind the last
    high = DIGIT * width
    ways: Ways = {}
    for start in starts:
        for end, weights in _search(rows, start, width).items():
            for j, weight in weights.items():
                count = len(rows) + j
                digits = (weight & (1 << high) - 1) >> DIGIT * (width - count)
                _offer(ways, (start, end), weight >> high, count, digits)
    return ways


def joined(left: Ways, right: Ways) -> Ways:
    """The cheapest edits of two adjoining parts."""
    ways: Ways = {}
    for (start, middle), (cost, digits_of) in left.items():
        for end in STATES:
            if (middle, end) in right:
                more, behind = right[middle, end]
                for n, digits in digits_of.items():
                    for m, tail in behind.items():
                        _offer(ways, (start, end), cost + more, n + m, digits << DIGIT * m | tail)
    return ways


def joined_all(parts: list[Ways]) -> Ways:
    """All parts in order, neighbours first, so that long numbers are built few times."""
    while len(parts) > 1:
        parts = [reduce(joined, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def repeated(ways: Ways, times: int) -> Ways:
    """The part ``times`` times over."""
    whole = None
    while times:
        if times & 1:
            whole = ways if whole is None else joined(whole, ways)
        ways, times = joined(ways, ways) if times > 1 else ways, times >> 1
    return whole


def spelled(digits: int, count: int) -> str:
    return f"{digits:o}".rjust(count, "0").translate(str.maketrans("01234", LETTERS)) if count else ""


def cheapest(ways: Ways) -> tuple[int, str]:
    """Cost and letters of the path of least weight that may end where it ends."""
    ended = [ways[0, end] for end in ENDS if (0, end) in ways]
    width = max(n for _, digits_of in ended for n in digits_of)
    weights = [
        ((cost << DIGIT * width) + (digits << DIGIT * (width - n)), n)
        for cost, digits_of in ended
        for n, digits in digits_of.items()
    ]
    weight, count = min(weights)
    low = weight & (1 << DIGIT * width) - 1
    return weight >> DIGIT * width, spelled(low >> DIGIT * (width - count), count)


WAY = "array<struct<start:int,end:int,cost:long,letters:string>>"
KEPT = "array<struct<place:long,key:string,role:string>>"
COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal")


def _packed(ways: Ways) -> list[dict]:
    return [
        {"start": s, "end": e, "cost": cost, "letters": spelled(digits, n)}
        for (s, e), (cost, digits_of) in ways.items()
        for n, digits in digits_of.items()
    ]


def _unpacked(packed: list[dict]) -> Ways:
    ways: Ways = {}
    numbers = str.maketrans(LETTERS, "01234")
    for way in packed:
        digits = int(way["letters"].translate(numbers) or "0", 8)
        _offer(ways, (way["start"], way["end"]), way["cost"], len(way["letters"]), digits)
    return ways


def _legal(before: str | None, after: str | None) -> bool:
    return (before, after) in {("s", "u"), ("u", "a"), ("a", "u")}


class _Part:
    """Adjoining rows of one conversation: counts, what its ends look like, and rows to edit."""

    def __init__(self, conv_id, number: int):
        self.out = {"conv_id": conv_id, "part": number, "turns": 0, "keys": [], "forms": ""} | dict.fromkeys(COUNTS, 0)
        self.rows: list[tuple[str, bool, bool]] = []
        self.ways: Ways | None = None

    def add(self, row: dict, times: int, first: bool) -> None:
        """A row ``times`` times over; beyond the first it is a duplicate (or blank) and has to go."""
        out, initial = self.out, (row["role"] or "")[:1]
        if not out["n_rows"]:
            out |= {"first": initial, "low": None, "high": None}
        else:
            out["illegal"] += not _legal(out["last"], initial)
        out["illegal"] += times - 1  # no initial may follow itself
        out["n_rows"] += times
        turn = row["turn"]
        if turn is not None and turn != out["high"]:
            out["turns"] += 1
            out["low"] = turn if out["low"] is None else out["low"]
            out["high"] = turn
        out["last"] = initial
        again = not first or row["duplicate"]
        if row["blank"]:
            out["blank"] += times
        else:
            out["duplicate"] += times if again else times - 1
            out["truncated"] += bool(row["truncated"] and not again)
        free = not (row["blank"] or again)
        out["forms"] += ("o" if free else "x") + "x" * (times - 1)
        if free:
            out["keys"].append(row["key"])
        if times <= PART_ROWS:
            self.rows += [(initial, not free, row["truncated"])] + [(initial, True, False)] * (times - 1)
        else:
            self.ways = repeated(ways_of([(initial, True, False)]), times)

    def searched(self, starts=STATES) -> Ways:
        return self.ways or ways_of(self.rows, starts)


def _parts(batches: Iterator[pa.RecordBatch], task: int) -> Iterator[tuple[_Part, bool]]:
    """Parts of the rows in order, each with whether its conversation is seen to end with it."""
    part, number = None, task << 40
    for batch in batches:
        for row in batch.to_pylist():
            conv_id, times = row["conv_id"], row["times"]
            long = times > PART_ROWS
            if part is not None:
                change = part.out["conv_id"] != conv_id
                full = part.ways or len(part.rows) + (1 if long else times) > PART_ROWS
                if change or full:
                    yield part, change
                    part = None
            if part is None:
                part, number = _Part(conv_id, number), number + 1
            if not long:
                part.add(row, times, True)
                continue
            part.add(row, 1, True)  # copies without end have a part of their own
            yield part, False
            part, number = _Part(conv_id, number), number + 1
            part.add(row, times - 1, False)
    if part is not None:
        yield part, False


def _settled(parts: list[dict], ways: Ways) -> Iterator[dict]:
    """The cheapest edits of a conversation's parts: rows that stay, by part, and one summary."""
    cost, audit = cheapest(ways)
    total = dict(parts[0])
    for before, after in zip(parts, parts[1:]):
        for name in COUNTS:
            total[name] += after[name]
        total["illegal"] += not _legal(before["last"], after["first"])
        seen = total["high"] is not None and after["low"] == total["high"]
        total["turns"] += after["turns"] - seen
        total["low"] = after["low"] if total["low"] is None else total["low"]
        total["high"] = total["high"] if after["high"] is None else after["high"]
    gaps = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["turns"]
    kept_rows = len(audit) - audit.count("D")
    place, at = 0, 0
    for i, part in enumerate(parts):
        keys, kept, done = iter(part["keys"]), [], 0
        last = i == len(parts) - 1
        while at < len(audit) and (last or done < len(part["forms"])):
            letter = audit[at]
            at += 1
            key = None
            if letter != "I":
                if part["forms"][done] == "o":
                    key = next(keys)
                done += 1
            if letter != "D":
                role = None if letter == "K" else ROLES["ua"[(place - kept_rows % 2) % 2]]
                kept.append({"place": place, "key": key, "role": role})
                place += 1
        first = {"gaps": gaps, "cost": cost, "audit": audit} | {n: total[n] for n in COUNTS} if i == 0 else {}
        yield {"conv_id": part["conv_id"], "part": part["part"], "settled": True, "kept": kept} | first


def _searched(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Whole conversations settled; parts of those that go on in another part or task as they are."""
    from pyspark import TaskContext

    out: list[dict] = []
    begins = False  # the first conversation may have begun in the task before, the last may go on
    for part, ends in _parts(batches, TaskContext.get().partitionId()):
        if begins and ends:
            out += _settled([part.out], part.searched((0,)))
        else:
            out.append(part.out | {"settled": False, "ways": _packed(part.searched())})
        begins = ends
        if len(out) >= 1000:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([row.get(f.name) for row in rows], f.type) for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def truncated(text: Column) -> Column:
    return ~blank(text) & ~text.rlike(rf"[.!?]{SPACE}*\z")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows and one report for each conversation.

    Repaired rows: ``conv_id``, ``place`` (from 0), ``role`` and ``text``; an inserted row has an
    empty text. Report: ``conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Rows go by turn, those without one first; rows of one turn go by role and by SHA-256 of
    conversation, role and text, so equal rows stand together. A missing role or text counts as one space, and rows without a
    conversation are one conversation. Other columns are not read. No rows give no rows.

    Equal rows are counted before they move, and equal role and text at other turns are told apart
    by a join that deals hot keys to many tasks. The rest is sorted by range, so a conversation of
    any length is cut over tasks: each part of 256 rows keeps its cheapest edits between all states,
    and only those of a conversation come together.
    """
    spark = conversations.sparkSession
    space = F.lit(" ")
    key = F.sha2(F.concat_ws("\0", F.coalesce(F.col("conv_id").cast("string"), F.lit("\1")), "role", "text"), 256)
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), space).alias("role"),
        F.coalesce(F.col("text"), space).alias("text"),
    ).withColumn("key", key)
    flags = [F.first(blank(F.col("text"))).alias("blank"), F.first(truncated(F.col("text"))).alias("truncated")]
    counted = rows.groupBy("conv_id", "turn", "role", "key").agg(F.count(F.lit(1)).alias("times"), *flags)
    light = written(counted.withColumn("row", F.monotonically_increasing_id()), "conversations-rows")
    seen = light.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first")
    )
    here = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    marked = attach(light, seen, "key", "n").select(
        "conv_id", "turn", "role", "key", "times", "blank", "truncated", (F.col("first") < here).alias("duplicate")
    )
    in_order = marked.repartitionByRange("conv_id", "turn", "role", "key").sortWithinPartitions(
        "conv_id", "turn", "role", "key"
    )

    conv_type = light.schema["conv_id"].dataType
    longs = [*COUNTS, "turns", "low", "high", "gaps", "cost"]
    fields = [T.StructField("conv_id", conv_type), T.StructField("settled", T.BooleanType())]
    fields += [T.StructField(n, T.LongType()) for n in ["part", *longs]]
    fields += [T.StructField(n, T.StringType()) for n in ["first", "last", "forms", "audit"]]
    fields += [T.StructField("keys", T.ArrayType(T.StringType()))]
    fields += [T.StructField("ways", T._parse_datatype_string(WAY)), T.StructField("kept", T._parse_datatype_string(KEPT))]
    schema = T.StructType(fields)
    arrow = _arrow(schema)

    parts = written(in_order.mapInArrow(lambda batches: _searched(batches, arrow), schema), "conversations-parts")

    def settle(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        out = _settled(rows, joined_all([_unpacked(r["ways"]) for r in rows]))
        return pa.Table.from_batches([_batch(list(out), arrow)])

    open_parts = parts.where(~F.col("settled")).groupBy("conv_id").applyInArrow(settle, schema)
    settled = written(parts.where("settled").unionByName(open_parts), "conversations-settled")
    report = settled.where(F.col("audit").isNotNull()).select("conv_id", *COUNTS, "gaps", "cost", "audit")
    kept = settled.select("conv_id", F.explode("kept").alias("k")).select("conv_id", "k.*")
    texts = rows.groupBy("key").agg(F.first("role").alias("own_role"), F.first("text").alias("text"))
    full = kept.where(F.col("key").isNotNull()).join(texts, "key").unionByName(
        kept.where(F.col("key").isNull()), allowMissingColumns=True
    )
    repaired = full.select(
        "conv_id",
        "place",
        F.coalesce("role", "own_role").alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return repaired, report


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256`` of the ``role:text`` lines of each repaired conversation.

    A conversation's rows pass through one task in order, a batch at a time, because each step of
    the hash needs the one before it; nothing of them is kept.
    """
    lines = repaired.select("conv_id", "place", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema = T.StructType([repaired.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    arrow = _arrow(schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv_id, state, out = False, None, None, []
        for batch in batches:
            for number, line in zip(batch["conv_id"].to_pylist(), batch["line"].to_pylist()):
                if not begun or number != conv_id:
                    if begun:
                        out.append({"conv_id": conv_id, "repaired_sha256": state.hexdigest()})
                    begun, conv_id, state = True, number, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            yield _batch(out, arrow)
            out = []
        if begun:
            yield _batch([{"conv_id": conv_id, "repaired_sha256": state.hexdigest()}], arrow)

    return ordered.mapInArrow(hashed, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut off, repeated or given another role, as ``crc32(conv_id:turn)`` says.

    A missing value counts as one space, in the hashed text and in what remains of the row.
    """
    space = F.lit(" ")
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    text = F.coalesce(F.col("text"), space)
    fault = F.crc32(F.concat(conv_id, F.lit(":"), turn).cast("binary")) % 20
    emptied = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(F.coalesce(F.col("role"), space))
    copies = F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))
    return conversations.select(
        "conv_id", "turn", role.alias("role"), emptied.alias("text"), F.explode(copies).alias("_copy")
    ).drop("_copy")
