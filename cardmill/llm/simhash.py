"""SimHash near-duplicates, linked through vantage-point trees over the fingerprints."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm.common import attach, components, hash_share, numbered, text_of, written

#: Most rows that the upper tree is fitted on (else 64 for each shard); all are then indexed.
TREE_SAMPLE = 1 << 20
#: Fingerprints a shard should have, and those a leaf compares directly.
SHARD_ROWS, LEAF_ROWS = 4096, 256

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str, words_each: int) -> int:
    """64-bit SimHash of a text's word shingles as a signed number."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words_each, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())]
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((octets + _PLACES).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = (2 * counts.ravel() > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def _distance(points: np.ndarray, centre) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(centre))


def _vantage(points: np.ndarray, radius: int, chance: random.Random) -> tuple[int, int] | None:
    """The point and the bound that copy fewest rows while splitting well; None if none splits."""
    best = None
    for _ in range(6):
        centre = points[chance.randrange(len(points))]
        away = np.bincount(_distance(points, centre), minlength=65)
        inside = np.cumsum(away)
        for bound in range(0, 64):
            left = int(inside[bound])
            copied = left - (int(inside[bound - radius]) if bound >= radius else 0)
            right = len(points) - left + copied
            if right == copied:
                break
            worst = max(left, right)
            if worst <= 0.75 * len(points) and (best is None or worst + copied < best[0]):
                best = (worst + copied, int(centre), bound)
    return best and best[1:]


def _split(points: np.ndarray, centre: int, bound: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices inside and outside the ball. By the triangle inequality a close pair across the
    boundary has its inner end within ``radius`` of it; those ends go to both sides."""
    away = _distance(points, centre).astype(np.int64)
    return np.flatnonzero(away <= bound), np.flatnonzero(away > bound - radius)


def upper_tree(sample: np.ndarray, depth: int, radius: int, seed: int = 7) -> list:
    """Nested ``[centre, bound, inner, outer]``; leaves are None. At most ``2 ** depth`` leaves."""
    chance = random.Random(seed)

    def grow(points: np.ndarray, levels: int):
        found = _vantage(points, radius, chance) if levels and len(points) >= 16 else None
        if found is None:
            return None
        inner, outer = _split(points, *found, radius)
        return [*found, grow(points[inner], levels - 1), grow(points[outer], levels - 1)]

    return grow(sample, depth)


def _route(tree, points: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
    """Shard numbers with the indices of the points that they get."""
    out, stack, leaves = [], [(tree, np.arange(len(points)))], 0
    while stack:
        node, index = stack.pop()
        if node is None:
            out.append((leaves, index))
            leaves += 1
            continue
        inner, outer = _split(points[index], node[0], node[1], radius)
        stack += [(node[2], index[inner]), (node[3], index[outer])]
    return out


class _Groups:
    """Connected groups of points, numbered by their smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def flat(self) -> np.ndarray:
        while (self.parent[self.parent] != self.parent).any():
            self.parent = self.parent[self.parent]
        return self.parent

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            x, y = self.find(i), self.find(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)


def link_shard(points: np.ndarray, radius: int, seed: int = 7) -> np.ndarray:
    """For each point the index of its group's first member, found with a tree over the shard."""
    groups, chance = _Groups(len(points)), random.Random(seed)
    stack = [np.arange(len(points))]
    while stack:
        index = stack.pop()
        found = _vantage(points[index], radius, chance) if len(index) > LEAF_ROWS else None
        if found is not None:
            inner, outer = _split(points[index], *found, radius)
            stack += [index[inner], index[outer]]
            continue
        own = points[index]
        rows = max(1, (1 << 22) // max(1, len(index)))
        for lo in range(0, len(index), rows):
            root = groups.flat()[index]
            near = np.bitwise_count(own[lo : lo + rows, None] ^ own[None, :]) <= radius
            near &= root[lo : lo + rows, None] != root[None, :]
            a, b = np.nonzero(near)
            groups.join(index[a + lo], index[b])
    return groups.flat()


def near_links(prints: DataFrame, n: int, radius: int) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly the distinct fingerprints within ``radius`` bits.

    ``prints`` has ``n`` distinct ``fp``. A tree fitted on a bounded hash sample deals them to
    shards of about 4,096; points near a boundary go to both sides, so every close pair meets
    somewhere. A shard returns one link per point to its group there, not all pairs.
    """
    depth = max(0, math.ceil(math.log2(max(1, n) / SHARD_ROWS)))
    sampled = prints.where(F.xxhash64("fp") <= F.lit(hash_share(n, min(TREE_SAMPLE, 64 << depth))))
    sample = sampled.collect() if depth else []
    points = np.sort(np.array([r[0] for r in sample], np.int64)).view(np.uint64)
    tree = upper_tree(points, depth, radius)

    def deal(frames):
        for frame in frames:
            fps = frame["fp"].to_numpy(np.int64)
            for shard, index in _route(tree, fps.view(np.uint64), radius):
                if len(index):
                    yield pd.DataFrame({"shard": shard, "fp": fps[index]})

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        fps = np.sort(frame["fp"].to_numpy(np.int64))
        first = link_shard(fps.view(np.uint64), radius)
        linked = np.flatnonzero(first != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[linked], "b": fps[first[linked]]})

    return prints.select("fp").mapInPandas(deal, "shard int, fp long").groupBy("shard").applyInPandas(link, "a long, b long")


def fingerprints(docs: DataFrame, words_each: int, id_column: str, text_column: str, carry=None) -> DataFrame:
    """A written table of doc_id, fp, row (and ``carry``) with one row per document."""
    extra = [] if carry is None else [carry.alias("carry")]

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words_each) for t in texts], dtype="int64")

    rows = docs.select(F.col(id_column).alias("doc_id"), prints(text_of(text_column)).alias("fp"), *extra)
    return written(numbered(rows, *[F.col(c) for c in rows.columns]), "simhash-rows")


def simhash_groups(
    docs: DataFrame,
    words_each: int = 3,
    radius: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry=None,
) -> DataFrame:
    """Group of every row: doc_id, fingerprint, component_id, first (and ``carry``).

    Texts are lower-cased (A-Z), cut at ASCII white space and fingerprinted by the XXH64 (seed
    42) of their shingles; texts without words have fingerprint 0 and link like any other.
    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest id
    that can be reached, ``first`` marks one row with it (missing ids last). Equal fingerprints
    are one point of the tree, so groups of exact copies cost nothing there.
    """
    rows = fingerprints(docs, words_each, id_column, text_column, carry)
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    classes = written(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), lead.alias("lead")), "simhash-classes")
    links = written(near_links(classes.select("fp"), classes.count(), radius), "simhash-links")
    labels = components(links, "simhash")
    labelled = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    labelled = written(labelled.select("fp", "n", "lead", F.coalesce("label", "fp").alias("label")), "simhash-labelled")
    leads = labelled.groupBy("label").agg(F.min("lead").alias("lead"), F.count(F.lit(1)).alias("prints"))
    known = attach(labelled.select("fp", "n", "label", F.col("fp").alias("row")), written(leads, "simhash-leads"), "label", "prints")
    known = written(known.select("fp", "n", "lead"), "simhash-known")
    return attach(rows, known, "fp", "n").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("lead.doc_id").alias("component_id"),
        (F.col("row") == F.col("lead.row")).alias("first"),
        *([] if carry is None else ["carry"]),
    )
