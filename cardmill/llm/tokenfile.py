"""Token files: static range asymmetric numeral coding in independent interleaved blocks.

A file set has one frequency table and blocks in ascending order of documents. A block holds
whole documents. Its ids are dealt to lanes (id i to lane i modulo the number of lanes) and each
lane is one coder; all lanes share one stream of 32-bit words. Every ``EVERY`` steps a checkpoint
keeps the lanes' states and the place in the stream, so the stretches between checkpoints decode
at the same time. Checksums cover the words and the ids. Blocks are rows of a Parquet table, so
writing, committing and reading them again is Spark's work on any file system.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardmill.llm.common import folder, memory_returned, numbered, text_of, written
from cardmill.llm.tokens import encoder

LANES, EVERY, BLOCK_IDS = 512, 512, 1 << 20
SCALE = 20
LOW = np.uint64(1 << 31)
HEAD = struct.Struct("<4sIQQIIII")
MAGIC = b"CMT1"
#: Codec of the ids between the tasks that make and that code them.
PACKED = pa.Codec("zstd", compression_level=1)
#: Bytes of documents that are encoded together.
JOINED_BYTES = 6 << 20


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of ``2 ** SCALE``; every id that occurs keeps at least 1."""
    total = int(counts.sum())
    out = np.zeros(len(counts), np.int64)
    if not total:
        return out
    there = counts > 0
    spare = (1 << SCALE) - int(there.sum())
    out[there] = 1 + counts[there] * spare // total
    out[int(counts.argmax())] += (1 << SCALE) - int(out.sum())
    return out


class Coder:
    """Encodes and decodes blocks with one frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.check = zlib.crc32(freq.astype("<u4").tobytes())

    def encode(self, ids: np.ndarray) -> bytes:
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, LOW)
        words, marks, n_words = [], [], 0
        for step in range(steps - 1, -1, -1):
            part = ids[step * LANES : (step + 1) * LANES]
            lanes = state[: len(part)]
            freq = self.freq[part]
            full = lanes >= freq << np.uint64(63 - SCALE)
            out = lanes[full].astype("<u4")
            words.append(out)
            n_words += len(out)
            lanes = np.where(full, lanes >> np.uint64(32), lanes)
            whole = lanes // freq
            state[: len(part)] = (whole << np.uint64(SCALE)) + (lanes - whole * freq) + self.start[part]
            if step % EVERY == 0:
                marks.append((n_words, state.copy()))
        stream = np.concatenate(words[::-1]).tobytes()
        marks = marks[::-1]
        places = np.array([n_words - n for n, _ in marks], "<u8").tobytes()
        states = np.concatenate([s for _, s in marks]).astype("<u8").tobytes()
        checks = zlib.crc32(stream), zlib.crc32(ids.astype("<u4").tobytes())
        return HEAD.pack(MAGIC, self.check, len(ids), n_words, len(marks), LANES, *checks) + places + states + stream

    def decode(self, data: bytes) -> np.ndarray:
        """The ids of a block, all stretches between checkpoints side by side."""
        magic, check, n, n_words, n_marks, lanes, words_crc, ids_crc = HEAD.unpack_from(data)
        if magic != MAGIC or check != self.check:
            raise ValueError("not a block of this file set")
        at = HEAD.size
        place = np.frombuffer(data, "<u8", n_marks, at).astype(np.int64)
        at += 8 * n_marks
        state = np.frombuffer(data, "<u8", n_marks * lanes, at).reshape(n_marks, lanes).copy()
        at += 8 * n_marks * lanes
        if zlib.crc32(data[at:]) != words_crc:
            raise ValueError("a block's words are damaged")
        words = np.append(np.frombuffer(data, "<u4", n_words, at).astype(np.uint64), np.uint64(0))
        out = np.zeros((n_marks, EVERY, lanes), np.uint32)
        first = np.arange(n_marks) * EVERY * lanes
        mask = np.uint64((1 << SCALE) - 1)
        lane = np.arange(lanes)
        for step in range(min(EVERY, -(-n // lanes))):
            live = (first[:, None] + step * lanes + lane) < n
            slot = state & mask
            symbol = self.symbol[slot.astype(np.int64)]
            out[:, step] = symbol
            moved = self.freq[symbol] * (state >> np.uint64(SCALE)) + slot - self.start[symbol]
            short = (moved < LOW) & live
            taken = np.cumsum(short, axis=1)
            following = words[np.minimum(place[:, None] + taken - 1, n_words)]
            moved = np.where(short, (moved << np.uint64(32)) | following, moved)
            state = np.where(live, moved, state)
            place = place + taken[:, -1]
        ids = out.reshape(-1)[:n] if n_marks else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
            raise ValueError("a block's ids are damaged")
        return ids


def joined(batches, least: int = JOINED_BYTES):
    """Arrow batches put together until they have ``least`` bytes: a piece is looked up once a batch."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def token_table(docs: DataFrame, tokenizer: str, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """A written table of doc_id, row, n and the deflated ids (with ``end_id``) of each document,
    and one row per task with the ids it made and how often each (``counts``)."""
    rows = numbered(docs, F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        own, counts = encoder(tokenizer), np.zeros(0, np.int64)
        for batch in joined(memory_returned(batches, "encoder")):
            ids = [np.frombuffer(b + end, "<u4") for b in own.batch(batch.column("text").to_pylist())]
            found = np.bincount(np.concatenate(ids)) if ids else counts
            if len(found) > len(counts):
                counts = np.pad(counts, (0, len(found) - len(counts)))
            counts[: len(found)] += found
            sizes = pa.array([len(x) for x in ids], pa.int64())
            packed = pa.array([deflate(x) for x in ids], pa.binary())
            columns = [batch.column("doc_id"), batch.column("row"), sizes, packed, pa.nulls(len(ids), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        there = np.flatnonzero(counts)
        pairs = pa.array([np.stack([there, counts[there]]).astype("<i8").tobytes()], pa.binary())
        none = [pa.nulls(1, kind) for kind in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pairs], names)

    names = ["doc_id", "row", "n", "ids", "counts"]
    return written(rows.mapInArrow(encode, "doc_id long, row long, n long, ids binary, counts binary"), "token-ids")


def deflate(ids: np.ndarray) -> bytes:
    """Ids as 16-bit halves, low ones then (if any id needs them) high ones, compressed behind a
    byte that says how many halves an id has."""
    low = (ids & 0xFFFF).astype("<u2").tobytes()
    high = (ids >> 16).astype("<u2").tobytes() if (ids >> 16).any() else b""
    return (b"\x02" if high else b"\x01") + PACKED.compress(low + high, asbytes=True)


def inflate(data: bytes, n: int) -> np.ndarray:
    raw = PACKED.decompress(memoryview(data)[1:], 2 * n * data[0])
    raw = np.frombuffer(raw, "<u2").astype(np.uint32)
    return raw if len(raw) == n else raw[:n] | raw[n:] << np.uint32(16)


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> str:
    """Writes the ids of all texts in ascending order of ids and returns the folder.

    Missing texts are empty, missing ids come first, repeated rows are all kept. Ids are made
    once and counted over all documents. The table of frequencies has one entry per vocabulary
    entry; blocks hold about 2**20 ids (a longer document has a block of its own), so a task's
    memory is bounded by that and the longest document.
    """
    spark = docs.sparkSession
    path = path or folder(spark, "tokens")
    tokens = token_table(docs, tokenizer, end_id, id_column, text_column)

    def count(frames):
        for frame in frames:
            for data in frame["counts"]:
                ids, n = np.frombuffer(data, "<i8").reshape(2, -1)
                yield pd.DataFrame({"id": ids, "n": n})

    counted = tokens.select("counts").where("counts IS NOT NULL").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n")).collect()
    counts = np.zeros(max([r[0] for r in counted], default=0) + 1, np.int64)
    counts[[r[0] for r in counted]] = [r[1] for r in counted]
    freq = frequencies(counts)
    spark.createDataFrame([(freq.tolist(),)], "freq array<long>").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(freq)

    def encode(batches):
        coder, ids, index, size, first = Coder(shared.value), [], [], 0, 0

        def close():
            docs = zlib.compress(np.array(index, "<i8").tobytes(), 1)
            row = [[first], [len(index)], [size], [docs], [coder.encode(np.concatenate(ids))]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["first", "n_docs", "n_ids", "docs", "data"])

        for batch in batches:
            doc_ids, none = batch.column("doc_id").fill_null(0).to_pylist(), batch.column("doc_id").is_null().to_pylist()
            for doc_id, no_id, n, data in zip(doc_ids, none, batch.column("n").to_pylist(), batch.column("ids").to_pylist()):
                ids.append(inflate(data, n))
                index.append((doc_id, no_id, n))
                size += n
                if size >= BLOCK_IDS:
                    yield close()
                    ids, index, size, first = [], [], 0, first + size
        if ids:
            yield close()

    ordered = tokens.where("counts IS NULL").drop("counts").repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").drop("row")
    blocks = ordered.mapInArrow(encode, "first long, n_docs long, n_ids long, docs binary, data binary")
    blocks = blocks.withColumn("part", F.spark_partition_id())
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def read_tokens(spark, path: str) -> DataFrame:
    """Documents of a file set: doc_id, start, n_tokens, ids (little-endian 32-bit numbers)."""
    freq = np.array(spark.read.parquet(f"{path}/table").first()[0], np.int64)
    shared = spark.sparkContext.broadcast(freq)
    blocks = spark.read.schema("first long, n_docs long, n_ids long, docs binary, data binary, part int").parquet(f"{path}/blocks")

    def decode(batches):
        coder = Coder(shared.value)
        for batch in batches:
            for part, first, docs, data in zip(*[c.to_pylist() for c in batch.columns]):
                index = np.frombuffer(zlib.decompress(docs), "<i8").reshape(-1, 3)
                ids, ends = coder.decode(data).astype("<u4"), np.cumsum(index[:, 2])
                columns = [
                    pa.array(np.full(len(index), part, np.int32)),
                    pa.array(index[:, 0], mask=index[:, 1] != 0),
                    pa.array(first + ends - index[:, 2]),
                    pa.array(index[:, 2]),
                    pa.array([ids[b - n : b].tobytes() for b, n in zip(ends, index[:, 2])], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "inside", "n_tokens", "ids"])

    schema = "part int, doc_id long, inside long, n_tokens long, ids binary"
    docs = blocks.select("part", "first", "docs", "data").mapInArrow(decode, schema)
    # A block knows how many ids its file has before it; what is left is one row per file.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    joined = docs.join(F.broadcast(parts), "part")
    return joined.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids")
