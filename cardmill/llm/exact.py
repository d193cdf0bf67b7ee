"""Exact deduplication: two passes with a Bloom filter; only possibly repeated rows shuffle."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm.common import SPACE, attach, numbered, text_of, written

SEGMENT_BITS = 1 << 17


def _places(hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Bit numbers of each hash, one row per probe (double hashing)."""
    h = hashes.astype(np.int64).view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((h + np.uint64(i) * step) % np.uint64(bits)).astype(np.int64) for i in range(probes)])


def _filter(digests: DataFrame, bits: int, probes: int, least: int = 2) -> np.ndarray:
    """Packed bits that at least ``least`` rows (1 or 2) set. All of it is ``bits / 8`` bytes."""

    def partial(frames):
        found = [_places(f["h"].to_numpy(), bits, probes).ravel() for f in frames if len(f)]
        if not found:
            return
        places, times = np.unique(np.concatenate(found), return_counts=True)
        weights = np.minimum(times, 2).astype(np.uint8)
        segments = places // SEGMENT_BITS
        starts = np.flatnonzero(np.r_[True, segments[1:] != segments[:-1]])
        for lo, hi in zip(starts, np.r_[starts[1:], len(places)]):
            inside = (places[lo:hi] - segments[lo] * SEGMENT_BITS).astype("<u4")
            yield pd.DataFrame({"segment": [segments[lo]], "places": [inside.tobytes()], "weights": [weights[lo:hi].tobytes()]})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        times = np.zeros(SEGMENT_BITS, np.uint8)
        for places, weights in zip(frame["places"], frame["weights"]):
            at = np.frombuffer(places, "<u4")
            times[at] = np.minimum(times[at] + np.frombuffer(weights, np.uint8), 2)
        return pd.DataFrame({"segment": frame["segment"].iloc[:1], "bits": [np.packbits(times >= least).tobytes()]})

    parts = digests.select("h").mapInPandas(partial, "segment long, places binary, weights binary")
    merged = parts.groupBy("segment").applyInPandas(merge, "segment long, bits binary").collect()
    packed = np.zeros(math.ceil(bits / SEGMENT_BITS) * SEGMENT_BITS // 8, np.uint8)
    for segment, part in merged:
        packed[segment * SEGMENT_BITS // 8 : (segment + 1) * SEGMENT_BITS // 8] = np.frombuffer(part, np.uint8)
    return packed


def in_filter(rows: DataFrame, packed: np.ndarray, probes: int = 3, bits: int | None = None) -> DataFrame:
    """Adds ``hit``: whether all bits of the row's hash ``h`` are set. Never false for a member."""
    shared = rows.sparkSession.sparkContext.broadcast(packed)
    bits = bits or len(packed) * 8

    @F.pandas_udf("boolean")
    def hit(h: pd.Series) -> pd.Series:
        at = _places(h.to_numpy(), bits, probes)
        return pd.Series((((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1) > 0).all(axis=0))

    return rows.withColumn("hit", hit("h"))


def bit_filter(hashes: DataFrame, bits_per_row: int = 16, max_bytes: int = 64 << 20, probes: int = 3) -> np.ndarray:
    """A Bloom filter of the hashes ``h``, at most ``max_bytes`` large (then with more false hits)."""
    bits = min(max_bytes * 8, hashes.count() * bits_per_row)
    return _filter(hashes, max(1, math.ceil(bits / SEGMENT_BITS)) * SEGMENT_BITS, probes, 1)


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits_per_row: int = 16,
    probes: int = 3,
    max_filter_bytes: int = 64 << 20,
) -> DataFrame:
    """Classes of equal normalised texts: doc_id, keep_id, group_size, kept, text_sha256 per row.

    Texts are equal when identical after each run of ASCII white space is one space; a missing
    text is empty. The smallest id stays (missing ids last, then the first of repeated rows).
    Pass one sets bits of every row's hash and keeps those set twice; a repeated text always
    finds all its bits there. Pass two sends rows whose bits are all set through the grouping.
    All others are alone in their class and pass straight through.

    The filter has ``bits_per_row`` bits a row and is broadcast, at most ``max_filter_bytes`` of
    it. More rows than that allows are handled in slices of the hash range, one filter each.
    """
    digest = F.sha2(F.regexp_replace(text_of(text_column), f"{SPACE}+", " "), 256)
    rows = numbered(docs, F.col(id_column).alias("doc_id"), digest.alias("text_sha256"))
    hashed = rows.withColumn("h", F.xxhash64("text_sha256"))
    n_rows = docs.count()
    slices = max(1, math.ceil(n_rows * bits_per_row / 8 / max_filter_bytes))
    bits = max(1024, math.ceil(n_rows / slices * bits_per_row))
    if slices > 1:
        hashed = hashed.withColumn("slice", F.pmod(F.xxhash64("h"), F.lit(slices)).cast("int"))
    digests = written(hashed, "exact-digests")
    parts = [digests] if slices == 1 else [digests.where(F.col("slice") == i).drop("slice") for i in range(slices)]
    tested = None
    for part in parts:
        found = in_filter(part, _filter(part, bits, probes), probes, bits).withColumnRenamed("hit", "repeated")
        tested = found if tested is None else tested.unionByName(found)
    tested = written(tested.drop("h"), "exact-tested")
    alone = tested.where(~F.col("repeated")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    maybe = tested.where("repeated").drop("repeated")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    classes = maybe.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first"))
    joined = attach(maybe, written(classes, "exact-classes"), "text_sha256", "group_size").select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(joined)
