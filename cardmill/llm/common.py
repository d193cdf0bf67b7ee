"""Shared pieces: written tables, hot-key joins, ranks inside classes, connected components."""

from __future__ import annotations

import ctypes
import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardmill.session import configure, scratch_dir

#: ASCII white space; the words of a text are the runs of everything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"

#: A key counts as hot when it holds more than one row in so many; hence there are fewer hot keys.
HOT_PART = 256
#: Tasks that the rows of one hot key are dealt to.
HOT_SLICES = 64

#: Words of a batch of texts are Python objects of some ten times its size: batches stay small.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings of these operators; makes the package known to the Python workers."""
    configure(spark)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not getattr(context, "_cardmill_shipped", False):
        package = Path(__file__).resolve().parents[1]
        archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cardmill-")), "cardmill.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(archive)
        context._cardmill_shipped = True
    return spark


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{scratch_dir(spark)}/cardmill/{name}-{uuid.uuid4().hex}"


#: Folders written on behalf of the callers of ``noted``, innermost last.
_NOTED: list[list[str]] = []


@contextmanager
def noted():
    """Collects the folders that ``written`` makes inside the block."""
    _NOTED.append([])
    try:
        yield _NOTED[-1]
    finally:
        _NOTED.pop()


def dropped(spark: SparkSession, folders: list[str], still_read: DataFrame) -> list[str]:
    """Delete folders that no plan of ``still_read`` reads from; the others are returned."""
    files = [f.split(":", 1)[-1].lstrip("/") for f in still_read.inputFiles()]
    kept = []
    for path in folders:
        inside = path.split(":", 1)[-1].lstrip("/") + "/"
        if any(f.startswith(inside) for f in files):
            kept.append(path)
            continue
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return kept


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = folder(spark, name)
    if _NOTED:
        _NOTED[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: What operators keep in a Python worker from task to task, by name.
KEPT: dict[str, dict] = {}


def memory_returned(batches, own: str | None = None):
    """The batches. What other operators kept in this worker (all in ``KEPT`` but ``own``) is dropped
    first. Before the first batch and after the last, freed memory goes back to the system: workers
    are used again and would hold it beside what the next stage needs."""
    for name, kept in KEPT.items():
        if name != own:
            kept.clear()
    _return_memory()
    yield from batches
    _return_memory()


def _return_memory() -> None:
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def text_of(column: str = "text") -> Column:
    """The text; a missing one counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def numbered(docs: DataFrame, *columns: Column) -> DataFrame:
    """The given columns and ``row``, a number that tells repeated rows apart once it is written."""
    return docs.select(*columns, F.monotonically_increasing_id().alias("row"))


def hash_share(rows: int, most: int) -> int:
    """Bound on ``xxhash64`` below which about ``most`` of ``rows`` rows lie (all, if fewer)."""
    return min(2**63 - 1, -(2**63) + int(min(1.0, most / max(1, rows)) * 2**64))


def n_cells(rows: int, per_cell: int = 10_000) -> int:
    """Cells that a class is cut into, so that a cell stays small whatever the class holds."""
    return max(32, math.ceil(rows / per_cell))


def attach(rows: DataFrame, per_key: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with one row per key, with the rows of hot keys dealt to many tasks.

    ``per_key`` has the number of rows of each key in ``count``. Keys above 1/256 of all rows are
    hot. There are at most 255 of them, so their list is broadcast and their side repeated.
    """
    total = per_key.agg(F.sum(count)).first()[0] or 0
    is_hot = (F.col(count) * HOT_PART > F.lit(total)) & (F.col(count) > 1000)
    hot = per_key.where(is_hot).select(key, F.lit(True).alias("_hot"))
    slices = F.sequence(F.lit(0), F.lit(HOT_SLICES - 1))
    left = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.when(F.col("_hot"), F.pmod(F.xxhash64("row"), F.lit(HOT_SLICES)).cast("int")).otherwise(F.lit(0))
    )
    right = per_key.withColumn("_slice", F.explode(F.when(is_hot, slices).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_slice"]).drop("_slice", "_hot")


def ranked(
    rows: DataFrame,
    by: list[str],
    order: list[str],
    cell: Column,
    name: str,
    classes: DataFrame | None = None,
) -> DataFrame:
    """Gapless ranks from 0 inside each class, without a task that sees a whole class.

    ``cell`` cuts a class into small parts. Ranks run from cell to cell, in a cell by ``order``.
    ``classes`` adds columns that are the same for a whole class; it rides on the table of cells.
    """
    celled = rows.withColumn("_cell", cell)
    counts = celled.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    if classes is not None:
        offsets = offsets.join(classes, by)
    inside = F.row_number().over(Window.partitionBy(*by, "_cell").orderBy(*order))
    placed = celled.withColumn("_rank", inside).join(offsets, [*by, "_cell"])
    return placed.withColumn(name, F.col("_before") + F.col("_rank") - 1).drop("_before", "_rank", "_cell")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable node per node, from undirected links ``a``, ``b`` of any sortable type.

    Each round hooks every node to its smallest neighbour below it, if any, follows the hooks to their end and goes
    on with the links between different ends. So links of nodes that have met are not read again. Every step is a
    written table.
    """

    def apart(links: DataFrame) -> DataFrame:
        ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return written(ordered.where(F.col("a") != F.col("b")).distinct(), f"{name}-links")

    links, rounds = apart(edges), []
    while links.limit(1).count():
        ends = _ends(links.groupBy("b").agg(F.min("a").alias("end")).withColumnRenamed("b", "node"), name)
        rounds.append(ends)
        of_a, of_b = (ends.select(F.col("node").alias(x), F.col("end").alias(f"end_{x}")) for x in "ab")
        met = links.join(of_b, "b").join(of_a, "a", "left")
        links = apart(met.select(F.coalesce("end_a", "a").alias("a"), F.col("end_b").alias("b")))
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds.pop().withColumnRenamed("end", "label")
    for ends in reversed(rounds):  # an end of this round may have been hooked in a later one
        later = labels.select(F.col("node").alias("end"), "label")
        own = ends.join(later, "end", "left").select("node", F.coalesce("label", "end").alias("label"))
        labels = written(own.unionByName(labels), f"{name}-labels")
    least = labels.select("label").distinct().select(F.col("label").alias("node"), "label")
    return written(labels.unionByName(least), f"{name}-labels")


def _ends(hooks: DataFrame, name: str) -> DataFrame:
    """The end of the hooks (node, end) that lead on from each node. What one step leads to is a step of the next
    pass, so chains shrink by doubling; nodes that have come to an end are left out of it."""
    todo = every = written(hooks, f"{name}-hooks")
    done = None
    while True:
        onward = every.select(F.col("node").alias("end"), F.col("end").alias("next"))
        moved = todo.join(onward, "end", "left").select("node", F.coalesce("next", "end").alias("end"), F.col("next").isNotNull().alias("on"))
        moved = written(moved, f"{name}-hooks")
        over, todo = (moved.where(x).select("node", "end") for x in (~F.col("on"), F.col("on")))
        done = over if done is None else done.unionByName(over)
        if not todo.limit(1).count():
            return done
        every = done.unionByName(todo)


def registry() -> tuple[dict, Callable]:
    """A table of queries and the decorator that fills it."""
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    def query(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepare(spark), sf_dir)

        run.__doc__ = function.__doc__
        queries[function.__name__] = run
        return run

    return queries, query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
