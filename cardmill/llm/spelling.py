"""Spelling variants: words one edit apart, found by pairs of forward and reversed trie nodes."""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmill.llm.common import text_of, written

#: Letters that make up a word: ASCII and U+00C0 to U+00FF.
LETTER = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Least length and least number of occurrences of a word, and how much more frequent its form is.
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 6, 5, 5
#: A node's number is its task's number in these high bits and a running number below.
TASK_BITS = 40


def words(docs: DataFrame, every: int = 199) -> DataFrame:
    """``word`` and ``n`` of all runs of letters, with a letter left out of some.

    Runs are the longest of their kind, with only A to Z lower-cased. Where ``every`` divides the CRC-32 of
    ``<doc_id>:<run>``, the letter at the remainder by the run's length goes. A missing text has no
    runs, a missing ``doc_id`` counts as empty. Runs too short to become a word are not looked at.
    """
    runs = F.regexp_extract_all(text_of(), F.lit(f"({LETTER}{{{LEAST_LENGTH},}})"), F.lit(1))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (hashed % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(hashed % every == 0, short).otherwise(F.col("run"))
    counted = found.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def _numbered(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted words with the numbers of the trie nodes from the root to each.

    In this order the words below a node stand together, so a word shares with the one before it
    exactly the nodes of their common beginning; every further letter makes a new node.
    """
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    node = task << TASK_BITS
    place, before, nodes = node, "", []
    for batch in batches:
        columns: tuple[list, list, list] = ([], [], [])
        for word in batch["word"].to_pylist():
            shared = len(commonprefix((before, word)))
            fresh = len(word) - shared
            nodes = nodes[:shared] + list(range(node + 1, node + fresh + 1))
            node, place, before = node + fresh, place + 1, word
            for column, value in zip(columns, (word, place, nodes)):
                column.append(value)
        arrays = [pa.array(c, f.type) for c, f in zip((*columns, [task] * len(columns[0])), schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def trie(words: DataFrame, name: str) -> DataFrame:
    """``word``, ``place`` in sorted order and ``nodes``, the trie nodes of its beginnings from one letter on.

    Tasks hold adjoining ranges of the sorted words. Where the first word of a task begins as the
    last one before it does, the numbers of those nodes are replaced by the ones known there. The driver
    sees the first and the last word of each task.
    """
    spark = words.sparkSession
    schema = T.StructType(
        [
            T.StructField("word", T.StringType()),
            T.StructField("place", T.LongType()),
            T.StructField("nodes", T.ArrayType(T.LongType())),
            T.StructField("task", T.LongType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    ordered = words.select("word").repartitionByRange("word").sortWithinPartitions("word")
    local = written(ordered.mapInArrow(lambda batches: _numbered(batches, arrow), schema), name)
    edges = (
        local.groupBy("task")
        .agg(*[f(F.struct("place", "word", "nodes")).alias(a) for f, a in ((F.min, "first"), (F.max, "last"))])
        .orderBy("task")
        .collect()
    )
    same: dict[int, dict[int, int]] = {}
    before, known = "", []
    for row in edges:
        shared = len(commonprefix((before, row["first"]["word"])))
        same[row["task"]] = dict(zip(row["first"]["nodes"][:shared], known))
        before = row["last"]["word"]
        known = [same[row["task"]].get(node, node) for node in row["last"]["nodes"]]
    renamed = [(task, nodes) for task, nodes in same.items() if nodes]
    table = spark.createDataFrame(renamed, "task long, same map<long,long>")
    found = F.transform("nodes", lambda node: F.coalesce(F.element_at("same", node), node))
    nodes = F.when(F.col("same").isNull(), F.col("nodes")).otherwise(found)
    return local.join(F.broadcast(table), "task", "left").select("word", "place", nodes.alias("nodes"))


def _pairs(numbered: DataFrame) -> DataFrame:
    """One row per word and place where a letter is skipped or could come in.

    ``before`` and ``behind`` are the trie nodes of what comes before and behind that place; both
    together spell out all other letters. ``first`` marks the first of equal adjoining letters:
    skipping any of them leaves the same word, so only that one counts.
    """
    length = F.size("nodes")

    def node(nodes: str, count: Column) -> Column:
        return F.when(count > 0, F.get(nodes, count - 1)).otherwise(F.lit(-1).cast("long"))

    def pair(i: Column, skipped: int) -> Column:
        first = (i == 0) | (F.substr("word", i + 1, F.lit(1)) != F.substr("word", i, F.lit(1)))
        return F.struct(
            node("nodes", i).alias("before"),
            node("back", length - i - skipped).alias("behind"),
            F.lit(bool(skipped)).alias("skipped"),
            (first if skipped else F.lit(False)).alias("first"),
        )

    skips = F.transform(F.sequence(F.lit(0), length - 1), lambda i: pair(i, 1))
    gaps = F.transform(F.sequence(F.lit(0), length), lambda i: pair(i, 0))
    return numbered.select(F.col("place").alias("id"), "n", F.explode(F.concat(skips, gaps)).alias("p")).select(
        "id", "n", "p.*"
    )


def _near(pairs: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and ``best``, the most frequent near word (of equal ones the first), of words with any.

    Words that skip a letter at one pair of nodes differ in that letter, so there are no more of
    them than letters, and one word at most has nothing at that place. Every near word is met
    once: a replaced letter at its place, a skipped one at the first of its kind. Each word takes
    the best of its group or, if it is that itself, the second; no pairs are formed.
    """
    member = F.struct("n", (-F.col("id")).alias("minus"), "first")
    groups = pairs.groupBy("before", "behind").agg(
        F.sort_array(F.collect_list(F.when(F.col("skipped"), member)), asc=False).alias("skips"),
        F.max(F.when(~F.col("skipped"), member)).alias("whole"),
    )
    groups = groups.where(F.size("skips") + F.col("whole").isNotNull().cast("int") > 1)
    groups = groups.withColumn("firsts", F.filter("skips", lambda m: m["first"]))

    def ranked(m: Column) -> Column:
        return F.struct(m["n"].alias("n"), m["minus"].alias("minus"))

    def skip(m: Column) -> Column:
        best, second = F.get("skips", F.lit(0)), F.get("skips", F.lit(1))
        other = F.when(best["minus"] == m["minus"], ranked(second)).otherwise(ranked(best))
        other = F.when(other["n"].isNotNull(), other)
        whole = F.when(m["first"] & F.col("whole").isNotNull(), ranked(F.col("whole")))
        count = F.size("skips") - 1 + whole.isNotNull().cast("int")
        return F.struct((-m["minus"]).alias("id"), count.alias("near"), F.greatest(other, whole).alias("best"))

    longer = F.get("firsts", F.lit(0))
    whole = F.struct(
        (-F.col("whole.minus")).alias("id"), F.size("firsts").alias("near"), ranked(longer).alias("best")
    )
    found = F.concat(F.transform("skips", skip), F.when(F.col("whole").isNull(), F.array()).otherwise(F.array(whole)))
    each = groups.select(F.explode(found).alias("m")).select("m.*").where(F.col("near") > 0)
    return each.groupBy("id").agg(F.sum("near").cast("long").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``id`` and ``root`` of words with a form: each round follows the chains twice as far.

    Counts rise by a factor along a chain, so there are a handful of rounds.
    """
    roots = written(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("id").alias("root"), F.col("root").alias("far"))
        moved = roots.join(further, "root", "left").select("id", F.coalesce("far", "root").alias("root"), "far")
        moved = written(moved, "spelling-roots")
        roots = moved.select("id", "root")
        if not moved.where(F.col("far").isNotNull()).limit(1).count():
            return roots


def variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with their counts ``n``.

    Two words are near if one inserted, deleted or replaced code point makes them equal. ``form``
    is the near word of largest ``n`` (of equal ones the first in code-point order) if that is at
    least five times the word's; ``root`` follows forms to the last. Words without a form have
    null there and are their own root. Rows without a word are left out; no words give no rows.
    """
    known = written(words.select("word", "n").where(F.col("word").isNotNull() & (F.col("word") != "")), "spelling-words")
    forward = trie(known, "spelling-trie")
    backward = trie(known.select(F.reverse("word").alias("word")), "spelling-back")
    backward = backward.select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    numbered = written(known.join(forward, "word").join(backward, "word"), "spelling-numbered")
    near = _near(_pairs(numbered)).select(
        "id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.minus")).alias("best_id")
    )
    own = numbered.select(F.col("place").alias("id"), "word", "n")
    has_form = F.col("best_n") >= F.col("n") * FORM_FACTOR
    linked = written(
        own.join(near, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best_id")).alias("form")
        ),
        "spelling-near",
    )
    forms = linked.where(F.col("form").isNotNull()).select("id", "form")
    named = own.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    last = own.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    with_form = forms.join(_roots(forms), "id").join(named, "form").join(last, "root").drop("form", "root")
    return linked.drop("form").join(with_form, "id", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        F.col("n").cast("long").alias("n"),
        "n_near",
        F.col("form_n").cast("long").alias("form_n"),
    )
