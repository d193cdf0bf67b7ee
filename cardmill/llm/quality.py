"""Quality rules: word counts, and a linear-chain conditional random field over a text's lines."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill.llm.common import text_of

#: Labelled documents that the field is fitted on, and lines per training sequence.
TRAIN_DOCS, TRAIN_LINES = 1500, 64
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8

_SPACE, _SYMBOL, _UPPER, _LETTER, _DIGIT, _MARK = 1, 2, 4, 8, 16, 32
#: Edges of the buckets of each line feature.
EDGES = {
    "words": (1, 3, 11),
    "word_length": (2.0, 3.5, 5.0, 7.0, 10.0),
    "upper": (1e-9, 0.1, 0.3, 0.6),
    "symbols": (1e-9, 0.02, 0.05, 0.1),
    "digits": (1e-9, 0.05, 0.2, 0.5),
    "marks": (1e-9, 0.03, 0.06, 0.12),
    "repeated": (0.5,),
    "distinct_words": (0.3, 0.5, 0.7, 0.85),
}
BASES = np.cumsum([0, *[len(e) + 1 for e in EDGES.values()]])
N_FEATURES = int(BASES[-1])


@cache
def _kinds() -> np.ndarray:
    """Kinds of the characters below 65,536; others count as letters."""
    out = np.zeros(65_537, np.uint8)
    for code in range(65_536):
        char = chr(code)
        if char in " \t\n\v\f\r":
            out[code] = _SPACE
        elif char.isalpha():
            out[code] = _LETTER | (_UPPER if char.isupper() else 0)
        elif char.isdigit():
            out[code] = _DIGIT
        else:
            out[code] = _MARK | (_SYMBOL if char in "#*$%&|<>" else 0)
    out[65_536] = _LETTER
    return out


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more in the text, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.uint64)
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashed = np.zeros(n, np.uint64)
    for i in range(window):
        hashed = hashed * np.uint64(0xBF58476D1CE4E5B9) + mixed[i : i + n]
    ordered = np.sort(hashed)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # equal windows have equal hashes
    rows = np.lib.stride_tricks.sliding_window_view(ids.astype(np.uint32), window)
    key = np.ascontiguousarray(rows).view(np.dtype((np.void, 4 * window))).ravel()
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = times[inverse.ravel()] > 1
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, np.flatnonzero(twice), 1)
    np.add.at(steps, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def line_facts(text: str) -> tuple[np.ndarray, np.ndarray, dict[str, int]]:
    """Feature numbers per line (one of each kind), words per line, and counts of the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kinds()[np.minimum(codes, 65_536)]
    feeds = codes == 10
    starts = np.r_[0, np.flatnonzero(feeds) + 1]
    line_of = np.cumsum(feeds) - feeds
    n_lines = len(starts)
    space = (kinds & _SPACE) > 0
    begins = ~space & np.r_[True, space[:-1]] if len(codes) else np.zeros(0, bool)

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.bincount(line_of[mask], minlength=n_lines).astype(float)

    words, chars, upper = per_line(begins), per_line(~space), per_line((kinds & _UPPER) > 0)
    letters, digits = per_line((kinds & _LETTER) > 0), per_line((kinds & _DIGIT) > 0)
    symbols, marks = per_line((kinds & _SYMBOL) > 0), per_line((kinds & _MARK) > 0)
    lines = text.split("\n")
    seen: set[str] = set()
    repeated, distinct = np.zeros(n_lines), np.ones(n_lines)
    for i, line in enumerate(lines):
        if words[i]:
            distinct[i] = len(set(line.split())) / words[i]
            if line in seen:
                repeated[i] = 1
            seen.add(line)
    some = np.maximum(chars, 1)
    values = [
        words,
        chars / np.maximum(words, 1),
        upper / np.maximum(letters, 1),
        symbols / some,
        digits / some,
        marks / some,
        repeated,
        distinct,
    ]
    features = np.stack([np.searchsorted(e, v, "right") + b for e, v, b in zip(EDGES.values(), values, BASES)], axis=1)
    counts = {
        "n_words": int(words.sum()),
        "word_chars": int(chars.sum()),
        "n_symbols": int(symbols.sum()),
        "n_dup_lines": int(repeated.sum()),
    }
    return features, words, counts


@dataclass
class Field:
    """Two states (0 boilerplate, 1 content): a weight per feature and state, and transitions."""

    emit: np.ndarray
    move: np.ndarray

    def content(self, features: np.ndarray) -> np.ndarray:
        """Most probable states (Viterbi); equal scores count as content."""
        scores = self.emit[features].sum(axis=1)
        (m00, m01), (m10, m11) = self.move.tolist()
        low, high, back = 0.0, 0.0, []
        for i, (a, b) in enumerate(scores.tolist()):
            if i:
                to0, to1 = (high + m10 >= low + m00), (high + m11 >= low + m01)
                back.append((to0, to1))
                low, high = max(low + m00, high + m10) + a, max(low + m01, high + m11) + b
            else:
                low, high = a, b
        states = [high >= low]
        for to0, to1 in reversed(back):
            states.append(to1 if states[-1] else to0)
        return np.array(states[::-1], bool)


def fit(samples: list[tuple[np.ndarray, int]], rounds: int = 120, penalty: float = 1.0) -> Field:
    """Maximum likelihood with an L2 penalty: forward-backward over padded sequences.

    Each sample is one sequence of lines whose document has the label. No sample gives the field
    of zeros, under which every line is content.
    """
    emit, move = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    parts = [(f[i : i + TRAIN_LINES], y) for f, y in samples for i in range(0, len(f), TRAIN_LINES)]
    if not parts:
        return Field(emit, move)
    longest = max(len(f) for f, _ in parts)
    x = np.zeros((len(parts), longest, len(EDGES)), np.int64)
    live = np.zeros((len(parts), longest), bool)
    for i, (f, _) in enumerate(parts):
        x[i, : len(f)], live[i, : len(f)] = f, True
    y = np.array([label for _, label in parts])
    flat = x[live]
    speed = [np.zeros_like(emit), np.zeros_like(move)]
    scale = [np.zeros_like(emit), np.zeros_like(move)]
    for step in range(1, rounds + 1):
        scores = emit[x].sum(axis=2)
        alpha, beta = np.zeros(scores.shape), np.zeros(scores.shape)
        alpha[:, 0] = scores[:, 0]
        for t in range(1, longest):
            on = np.logaddexp(alpha[:, t - 1, :1] + move[0], alpha[:, t - 1, 1:] + move[1]) + scores[:, t]
            alpha[:, t] = np.where(live[:, t, None], on, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = scores[:, t + 1] + beta[:, t + 1]
            on = np.logaddexp(ahead[:, :1] + move[:, 0], ahead[:, 1:] + move[:, 1])
            beta[:, t] = np.where(live[:, t + 1, None], on, 0)
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        chance = np.exp(alpha + beta - total[:, None, None])
        truth = np.eye(2)[y][:, None, :]
        error = (truth - chance)[live]
        grad_emit = np.zeros_like(emit)
        for column in range(len(EDGES)):
            np.add.at(grad_emit, flat[:, column], error)
        both = live[:, 1:]
        pair = alpha[:, :-1, :, None] + move + (scores + beta)[:, 1:, None, :] - total[:, None, None, None]
        expected = np.exp(np.where(both[..., None, None], pair, -np.inf)).sum(axis=(0, 1))
        found = np.zeros((2, 2))
        for k in (0, 1):
            found[k, k] = both.sum(axis=1)[y == k].sum()
        for own, grad, s, q in zip((emit, move), (grad_emit, found - expected), speed, scale):
            grad = grad - penalty * own
            s += 0.1 * (grad - s)
            q += 0.001 * (grad**2 - q)
            own += 0.1 * (s / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-9)
    return Field(emit, move)


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", bound: int = TRAIN_DOCS) -> Field:
    """Fits the field on at most ``bound`` labelled documents, chosen by a hash of the id.

    Lines of a document of quality 1 count as content, those of quality 0 as boilerplate.
    """
    rated = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
    chosen = rated.orderBy(F.xxhash64("_id"), "_id", "_y").limit(bound)
    joined = docs.join(F.broadcast(chosen), F.col(id_column) == F.col("_id")).select("_id", "_y", text_of(text_column).alias("text"))

    def facts(batches):
        for batch in batches:
            found = [line_facts(t)[0].astype(np.uint8) for t in batch.column("text").to_pylist()]
            arrays = [batch.column("_id"), batch.column("_y"), pa.array([f.tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "y", "f"])

    rows = joined.mapInArrow(facts, f"id {rated.schema['_id'].dataType.simpleString()}, y int, f binary").collect()
    rows.sort(key=lambda r: (str(r["id"]), r["y"], bytes(r["f"])))
    return fit([(np.frombuffer(r["f"], np.uint8).reshape(-1, len(EDGES)).astype(np.int64), r["y"]) for r in rows])


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double"


def judge(text: Column, field: Field) -> Column:
    """Counts and content share of a text as one struct column (``SCHEMA``)."""

    @F.pandas_udf(SCHEMA)
    def facts(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            features, words, counts = line_facts(text)
            content = words[field.content(features)].sum()
            share = float(content / words.sum()) if words.any() else 0.0
            repeats = repeat_words(text.encode("utf-8", "surrogatepass").split())
            out.append((*counts.values(), repeats, share))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return facts(text)


def quality_rules(
    docs: DataFrame, field: Field, least_content: float = 0.5, text_column: str = "text", carry: list[Column] | None = None
) -> DataFrame:
    """Verdict on every document: ``carry`` (default: doc_id), the counts, base_failed, kept.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated 8-word windows.
    Otherwise the document is kept when at least half of its words are in lines that the field
    marks as content. A missing text has no words. Every row is judged by itself, so repeated
    rows get equal verdicts.
    """
    rows = docs.select(*(carry or ["doc_id"]), judge(text_of(text_column), field).alias("_facts"))
    failed = (F.col("_facts.n_words") < MIN_WORDS) | (100 * F.col("_facts.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_facts.n_words"))
    rows = rows.withColumns({"base_failed": failed, "kept": ~failed & (F.col("_facts.content_share") >= least_content)})
    return rows.select(*[c for c in rows.columns if c not in ("_facts", "base_failed", "kept")], "_facts.*", "base_failed", "kept")
