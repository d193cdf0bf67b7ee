"""Sharding by a minimax contiguous partition of ordered atomic groups. DataFrame functions only."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm.common import n_cells, numbered, ranked, text_of, written

FIRST_DEPTH = 4
KEY_LENGTH = 32


class _Line:
    """Cells in key order. A cell of several groups may still be cut inside (``soft``)."""

    def __init__(self, cells: list[tuple[str, int, int]]):
        self.prefix = [c[0] for c in cells]
        self.soft = [c[2] > 1 and len(c[0]) < KEY_LENGTH for c in cells]
        self.ends = [0, *accumulate(c[1] for c in cells)]

    def chain(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Greedy cuts. Hopeful ones cut soft cells anywhere, others nowhere."""
        cuts, at = [], 0
        for _ in range(shards):
            reach = min(at + capacity, self.ends[-1])
            cell = bisect_right(self.ends, reach) - 1
            if not (hopeful and cell < len(self.soft) and self.soft[cell]):
                reach = self.ends[cell]
            at = max(at, reach)
            cuts.append(at)
        return cuts

    def least(self, shards: int, hopeful: bool) -> int:
        """Smallest feasible capacity, by binary search with the greedy check."""
        low, high = 1, max(1, self.ends[-1])
        while low < high:
            middle = (low + high) // 2
            if self.chain(middle, shards, hopeful)[-1] >= self.ends[-1]:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[str]]:
    """Smallest largest shard over groups ``(key, size)`` in key order, and where shards 1.. begin.

    Keys are 32 hex digits, evenly spread. Only sums over key prefixes reach the driver: first
    those of 65,536 prefixes, then of the few cells in which a cut can still fall, 256 parts
    each, until every cut is known. Bounds of the search: cells that are cut nowhere give a
    capacity that is enough, cells that are cut anywhere give one that is needed.
    """

    def sums(depth: int, among: list[str] | None = None) -> list[tuple[str, int, int]]:
        inside = groups if among is None else groups.where(F.substring("key", 1, depth - 2).isin(among))
        by = inside.groupBy(F.substring("key", 1, depth).alias("prefix"))
        return [tuple(r) for r in by.agg(F.sum("size"), F.count(F.lit(1))).collect()]

    cells = sorted(sums(FIRST_DEPTH))
    while True:
        line = _Line(cells)
        needed, enough = line.least(shards, True), line.least(shards, False)
        low, high = line.chain(needed, shards, False), line.chain(enough, shards, True)
        open_cells = {
            i
            for a, b in zip(low[:-1], high[:-1])
            for i in range(max(0, bisect_right(line.ends, a) - 1), min(len(cells), bisect_right(line.ends, b)))
            if line.soft[i] and line.ends[i] < b and line.ends[i + 1] > a
        }
        if not open_cells:
            cuts = line.chain(enough, shards, False)[:-1]
            begins = [bisect_right(line.ends, cut) - 1 for cut in cuts]
            return enough, [line.prefix[i] if i < len(cells) else "g" for i in begins]
        finer = []
        for depth in {len(cells[i][0]) for i in open_cells}:
            finer += sums(depth + 2, [cells[i][0] for i in open_cells if len(cells[i][0]) == depth])
        cells = sorted([c for i, c in enumerate(cells) if i not in open_cells] + finer)


def minimax_shards(
    docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Shard of every row: doc_id, size, text_crc32, shard, slot, capacity.

    Size is the text's UTF-8 bytes plus 1 (missing text: 1). Equal texts form a group that stays
    together; groups are ordered by the hash of their text. The capacity is the smallest for
    which greedy filling needs no more shards, found exactly. A group above an equal share takes
    a shard of its own (there are fewer such groups than shards) and the others share the rest,
    else a group with a third of all bytes would leave most shards empty. Slots run from 0 in
    each shard. Rows without an id, repeated rows and empty tables are ordinary cases.
    """
    text = text_of(text_column)
    rows = written(
        numbered(
            docs,
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("key"),
        ),
        "shard-rows",
    )
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    rest = groups.agg(F.sum("size")).first()[0] or 0
    heavy: list[str] = []
    for key, size in groups.orderBy(F.desc("size"), "key").limit(shards).collect():
        if size * (shards - len(heavy)) <= rest or len(heavy) == shards - 1:
            break
        heavy.append(key)
        rest -= size
    light = groups.where(~F.col("key").isin(heavy)) if heavy else groups
    capacity, begins = minimax_cuts(light, shards - len(heavy))
    shard = sum((F.when(F.col("key") >= begin, 1).otherwise(0) for begin in begins), F.lit(0))
    for i, key in enumerate(heavy):
        shard = F.when(F.col("key") == key, F.lit(shards - len(heavy) + i)).otherwise(shard)
    cell = F.pmod(F.xxhash64("row"), F.lit(n_cells(rows.count())))
    placed = ranked(rows.withColumn("shard", shard.cast("int")), ["shard"], ["doc_id", "row"], cell, "slot")
    return placed.select(
        "doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long"), F.lit(capacity).cast("long").alias("capacity")
    )
