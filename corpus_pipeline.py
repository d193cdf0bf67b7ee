"""The training corpus pipeline: quality rules, line deduplication, near-duplicates, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's documents. All but the last return the columns of ``docs``.
Repeated rows are separate documents for quality, mixing and packing; line deduplication cuts
rows with the same id and text alike; near-duplicate removal keeps one row of each group.

A stage's own tables are deleted when the next stage of the session begins, except those its
documents are read from. So write a stage's result before another stage is called, and run one pipeline
at a time in a session.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.llm.common import dropped, noted, prepare, table, written
from cardmill.llm.lines import dedup_lines
from cardmill.llm.mixing import mix
from cardmill.llm.packing import pack, token_pieces
from cardmill.llm.quality import quality_rules, train
from cardmill.llm.queries import vocabulary
from cardmill.llm.simhash import simhash_groups


#: Folders that the stages so far have left.
_LEFT: list[str] = []


def _stage(function: Callable) -> Callable:
    """A stage that first deletes what the stages before it left."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        _LEFT[:] = dropped(spark, _LEFT, docs)
        with noted() as own:
            out = function(spark, docs, sf_dir)
        _LEFT.extend(own)
        return out

    return run_stage


#: Words whose ids a worker remembers. Workers of the stages before are still there in packing, and tasks
#: take turns among them, so several hold an encoder at a time.
REMEMBERED = 150_000


def _whole(docs: DataFrame):
    return F.struct(*[F.col(c) for c in docs.columns])


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. The field is fitted on the labelled documents of
    the whole collection."""
    field = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    judged = quality_rules(docs, field, carry=[_whole(docs).alias("doc")])
    return judged.where("kept").select("doc.*")


@_stage
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one whose every line with a word went is left out."""
    cleaned = dedup_lines(docs.select(_whole(docs).alias("whole"), "doc_id", "text"))
    gone = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = cleaned.where(~F.coalesce(gone, F.lit(False)))
    new = {"text": F.col("text"), "n_chars": F.coalesce(F.length("text"), F.col("whole.n_chars")) if "n_chars" in docs.columns else None}
    columns = {c: new.get(c, F.col("whole").getField(c)) for c in docs.columns}
    return kept.select(*[value.cast(docs.schema[c].dataType).alias(c) for c, value in columns.items()])


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id."""
    return simhash_groups(docs, carry=_whole(docs)).where("first").select("carry.*")


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    taken = mix(docs, carry=_whole(docs)).where(F.col("taken") > 0)
    times = (F.col("taken") / F.col("size")).cast("int")
    return taken.select("carry", F.explode(F.array_repeat(F.lit(0), times))).select("carry.*")


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, and their place in sequences of 2,048 ids."""
    pieces = token_pieces(docs, vocabulary("word_bpe_49k.json"), remembered=REMEMBERED)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained models, fingerprints, subset sums and token ids: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is a table in the shared folder."""
    prepare(spark)
    docs, done = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noted() as own:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        done = dropped(spark, done, docs) + own
    return STAGES[-1][1](spark, docs, sf_dir)
