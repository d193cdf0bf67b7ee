"""Quality classifier: learned vectors of words, character n-grams and word repeats, averaged over a document."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmill.llm.common import hash_share, text_of, written

#: Hash buckets that words and n-grams share, and numbers in a bucket's vector.
BUCKETS, SIZE = 1 << 17, 16
#: Characters in an n-gram of a word between ``<`` and ``>``.
GRAMS = (3,)
#: A word that stands so many words before as well has a bucket for that, whatever the word.
REPEATS = (1, 2, 3, 4)
#: Most labelled documents that the vectors are learned from, and most (document, bucket) entries of them.
TRAIN_DOCS, TRAIN_ENTRIES = 2000, 8_000_000
EPOCHS, RATE, SEED = 4, 0.5, 42
#: Score from which a document is predicted to be good.
LIMIT = 0.7
#: Words whose sums one Python worker remembers.
MEMORY_WORDS = 300_000
#: Letters of a word whose n-grams are hashed at once.
CHUNK = 1 << 16


@dataclass
class Model:
    """``weight`` of a bucket: the difference of both classes' outputs for its vector."""

    weight: np.ndarray
    bias: float


def buckets(word: bytes) -> Iterator[list[int]]:
    """Buckets of a word: its own and those of its n-grams, some at a time."""
    digest = zlib.crc32
    yield [digest(word) % BUCKETS]
    marked = b"<" + word + b">"
    if not marked.isascii():
        marked = marked.decode("utf-8", "surrogatepass")
    for k in GRAMS:
        for start in range(0, max(0, len(marked) - k + 1), CHUNK):
            places = range(start, min(start + CHUNK, len(marked) - k + 1))
            grams = [marked[i : i + k] for i in places]
            if isinstance(marked, str):
                grams = [gram.encode("utf-8", "surrogatepass") for gram in grams]
            yield [digest(gram, k) % BUCKETS for gram in grams]


def split(text: str) -> list[bytes]:
    """Words between ASCII white space, with A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def repeats(words: list[bytes]) -> Iterator[tuple[int, int]]:
    """Bucket and number of the words that stand some words before as well."""
    for k in REPEATS:
        yield zlib.crc32(b"\0" + bytes([k])) % BUCKETS, sum(map(eq, words[k:], words))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of all its buckets."""
    counts = np.zeros(BUCKETS)
    words = split(text)
    found, times = [], []
    for word, n in Counter(words).items():
        for part in buckets(word):
            found += part
            times += [n] * len(part)
        if len(found) >= CHUNK:
            counts += np.bincount(found, times, BUCKETS)
            found, times = [], []
    for bucket, n in repeats(words):
        found.append(bucket)
        times.append(n)
    counts += np.bincount(found, times, BUCKETS)
    distinct = np.flatnonzero(counts)
    return distinct.astype(np.int32), (counts[distinct] / max(1, counts.sum())).astype(np.float32)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is not learned from."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % 4 == 2


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Stochastic gradient descent on softmax outputs of averaged vectors, one document a step.

    No samples, or all of one label, give a model without an opinion of any word.
    """
    chance = np.random.default_rng(SEED)
    vectors = chance.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    output = np.zeros((2, SIZE), np.float32)
    share = sum(label for *_, label in samples)
    share = (share + 1) / (len(samples) + 2)
    bias = np.log(np.array([1 - share, share], np.float32))
    steps, at = EPOCHS * len(samples), 0
    if len({label for *_, label in samples}) > 1:
        for _ in range(EPOCHS):
            for i in chance.permutation(len(samples)):
                found, parts, label = samples[i]
                rate = RATE * (1 - at / steps)
                at += 1
                if not len(found):
                    continue
                mean = parts @ vectors[found]
                scores = output @ mean + bias
                wrong = np.exp(scores - scores.max())
                wrong /= wrong.sum()
                wrong[label] -= 1
                back = output.T @ wrong
                output -= rate * np.outer(wrong, mean)
                bias -= rate * wrong
                vectors[found] -= rate * np.outer(parts / parts.max(), back)
    difference = output[1] - output[0]
    return Model((vectors @ difference).astype(np.float64), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the labelled documents that are not held out.

    Of labels of one document the smallest counts, of its texts the one of smallest hash. Learned from are at
    most about ``TRAIN_DOCS`` documents, those of smallest hash, while they have ``TRAIN_ENTRIES``
    (document, bucket) entries together; a text's entries are at most ``BUCKETS``. Tasks count the
    buckets of whole texts; the driver sees only those counts.
    """
    own = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    own = own.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("label"))
    bound = hash_share(own.count(), TRAIN_DOCS)
    chosen = own.where(F.xxhash64("doc_id") <= F.lit(bound))
    text = text_of()
    texts = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    @F.pandas_udf("found array<int>, share array<float>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([features(t) for t in texts], columns=["found", "share"])

    sample = written(one.select("doc_id", "label", counted("text").alias("f")), "classifier-sample")
    rows, entries = [], 0
    for row in sample.orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        entries += len(row.f.found)
        if entries > TRAIN_ENTRIES:
            break
        rows.append((np.array(row.f.found, np.int32), np.array(row.f.share, np.float32), row.label))
    return fit(rows)


class Scorer:
    """Scores of texts; sums over the buckets of common words are remembered."""

    def __init__(self, model: Model):
        self.weight, self.bias, self.known = model.weight.tolist(), model.bias, {}

    def sums(self, word: bytes) -> tuple[float, int]:
        """Weight and number of a word's buckets."""
        total, count = 0.0, 0
        for part in buckets(word):
            total += sum(map(self.weight.__getitem__, part))
            count += len(part)
        return total, count

    def score(self, text: str) -> float:
        known, total, count = self.known, 0.0, 0
        words = split(text)
        for word, times in Counter(words).items():
            sums = known.get(word)
            if sums is None:
                sums = self.sums(word)
                if len(known) < MEMORY_WORDS and len(word) < 64:
                    known[word] = sums
            total += sums[0] * times
            count += sums[1] * times
        for bucket, times in repeats(words):
            total += self.weight[bucket] * times
            count += times
        logit = self.bias + (total / count if count else 0.0)
        return 1 / (1 + math.exp(-min(max(logit, -700.0), 700.0)))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score`` and ``predicted`` of every row, from its whole text alone.

    A missing or empty text gets the score of the bias, which is the share of good labels. Repeated rows are scored
    each. A missing ``doc_id`` counts as empty for ``held_out``. No rows give no rows.
    """
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value)
        for texts in batches:
            yield pd.Series([scorer.score(text) for text in texts], dtype="float64")

    scored = docs.select("doc_id", held_out().alias("held_out"), score(text_of()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))
