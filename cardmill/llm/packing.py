"""Packing token sequences: cutting stock by column generation over a histogram of lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardmill.llm.common import memory_returned, n_cells, numbered, ranked, text_of, written
from cardmill.llm.tokens import MEMORY_PIECES, encoder

PIECE = "doc_id {id}, start long, length long, doc_tokens long, ids binary"
NAMES = ["doc_id", "start", "length", "doc_tokens", "ids"]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    remembered: int = MEMORY_PIECES,
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids: doc_id, start, length, doc_tokens, ids.

    A document's ids are those of its whole text (missing text: empty) and ``end_id``. Pieces
    are full ones from the start, then the rest. ``ids`` are little-endian 32-bit numbers.
    A worker remembers the ids of at most ``remembered`` words.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for batch in memory_returned(batches, "encoder"):
            whole = [ids + end for ids in encoder(tokenizer, remembered).batch(batch.column(1).to_pylist())]
            sizes = np.array([len(ids) // 4 for ids in whole], np.int64)
            owner = np.repeat(np.arange(len(whole)), -(-sizes // capacity))
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
            start = (np.arange(len(owner)) - first[owner]) * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            ids = [whole[i][4 * a : 4 * (a + n)] for i, a, n in zip(owner, start, length)]
            columns = [batch.column(0).take(pa.array(owner)), start, length, sizes[owner], pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], NAMES)

    return rows.mapInArrow(cut, PIECE.format(id=rows.schema["doc_id"].dataType.simpleString()))


def _best_pattern(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern that fits: an unbounded knapsack, solved by dynamic programming."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for cap in range(1, room + 1):
        fits = int(np.searchsorted(sizes, cap, "right"))
        best[cap] = best[cap - 1]
        if fits:
            gains = best[cap - sizes[:fits]] + values[:fits]
            i = int(gains.argmax())
            if gains[i] > best[cap] + 1e-12:
                best[cap], choice[cap] = gains[i], i
    pattern, cap = np.zeros(len(sizes), np.int64), room
    while cap > 0:
        if choice[cap] < 0:
            cap -= 1
        else:
            pattern[choice[cap]] += 1
            cap -= sizes[choice[cap]]
    return float(best[room]), pattern


def column_generation(
    sizes: np.ndarray, demand: np.ndarray, room: int, tolerance: float = 1e-3
) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each: the linear program of cutting stock, by simplex steps.

    Starts with one pattern per size. The knapsack prices columns by the dual values; it ends
    once no column can lower the number of sequences by more than ``tolerance`` of it, or the
    number is that close to what the sizes add up to.
    """
    m = len(sizes)
    basis = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / (room // sizes))
    cost = np.ones(m)
    use = demand / (room // sizes)
    bound = float((sizes * demand).sum()) / room
    for step in range(12 * m):
        if (cost * use).sum() <= bound * (1 + tolerance):
            break
        duals = (cost[:, None] * inverse).sum(axis=0)
        lowest = int(duals.argmin())
        if duals[lowest] < -1e-9:  # more of this size than asked for is allowed
            column, price = -np.eye(m)[lowest], 0.0
        else:
            value, pattern = _best_pattern(duals, sizes, room)
            if value <= 1 + tolerance:
                break
            column, price = pattern.astype(float), 1.0
        direction = (inverse * column).sum(axis=1)
        ratios = np.where(direction > 1e-9, use / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(ratios.argmin())
        if not np.isfinite(ratios[leave]):
            break
        pivot = inverse[leave] / direction[leave]
        inverse = inverse - np.outer(direction, pivot)
        inverse[leave] = pivot
        use = use - direction * ratios[leave]
        use[leave] = ratios[leave]
        basis[:, leave], cost[leave] = column, price
    return [(basis[:, j].astype(np.int64), float(use[j])) for j in range(m) if cost[j] and use[j] > 1e-9]


def whole_patterns(sizes: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[int, np.ndarray]]:
    """Patterns with whole counts that cover the demand: the program's, rounded down, then the
    rest, which fills less than one sequence per pattern, largest sizes first."""
    left, out = demand.copy(), []
    for pattern, use in column_generation(sizes, demand, room) if len(sizes) else []:
        times = min([int(use + 1e-9), *(left[pattern > 0] // pattern[pattern > 0]).tolist()])
        if times > 0:
            out.append((times, pattern))
            left -= times * pattern
    while left.any():
        pattern, free = np.zeros(len(sizes), np.int64), room
        for i in range(len(sizes) - 1, -1, -1):
            pattern[i] = min(left[i], free // sizes[i])
            free -= pattern[i] * sizes[i]
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        out.append((times, pattern))
        left -= times * pattern
    return out


def pack(pieces: DataFrame, capacity: int = 2048, grain: int = 8) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Lengths are counted in classes of ``grain`` ids, rounded up, so a pattern that fits in
    classes fits in ids. Only this histogram (``capacity / grain`` rows) reaches the driver.
    Each class is ranked over cells; its ranks are dealt to the patterns in order. Other columns
    are carried along; those named like the new ones are replaced.
    """
    room = capacity // grain
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    kept = F.struct(*[F.col(c) for c in names]).alias("piece")
    size = F.ceil(F.col("length") / F.lit(grain)).cast("int").alias("size")
    rows = written(numbered(pieces, kept, F.col("length").alias("n"), size), "pack-pieces")
    counted = sorted(tuple(r) for r in rows.groupBy("size").count().collect())
    sizes = np.array([c[0] for c in counted], np.int64)
    demand = np.array([c[1] for c in counted], np.int64)
    seen, first, spans = {}, 0, []
    for times, pattern in whole_patterns(sizes, demand, room):
        for i in np.flatnonzero(pattern):
            at = seen.get(i, 0)
            spans.append((int(sizes[i]), at, int(pattern[i]), first))
            seen[i] = at + int(pattern[i]) * times
        first += times
    by_size = {s: np.array([x[1:] for x in spans if x[0] == s], np.int64) for s in {x[0] for x in spans}}

    @F.pandas_udf("long")
    def sequence(size: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.zeros(len(size), np.int64)
        sizes, ranks = size.to_numpy(), rank.to_numpy()
        for s in np.unique(sizes):
            at, own = np.flatnonzero(sizes == s), by_size[int(s)]
            span = own[np.searchsorted(own[:, 0], ranks[at], "right") - 1]
            out[at] = span[:, 2] + (ranks[at] - span[:, 0]) // span[:, 1]
        return pd.Series(out)

    cell = F.pmod(F.xxhash64("row"), F.lit(n_cells(int(demand.sum()))))
    placed = ranked(rows, ["size"], ["row"], cell, "rank").withColumn("sequence_id", sequence("size", "rank"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("n"), "row").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    return placed.select("piece", "sequence_id", offset).select("piece.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ``ids`` as whole sequences: sequence_id, length, doc_ids, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("p"))
    joined = F.aggregate("p.ids", F.lit(b""), lambda done, ids: F.concat(done, ids))
    total = F.aggregate("p.length", F.lit(0).cast("long"), lambda n, x: n + x)
    return whole.select("sequence_id", total.alias("length"), F.col("p.doc_id").alias("doc_ids"), joined.alias("ids"))
