"""Keys that are too large for one task.

Grouped aggregates need no help with a dominant key: they combine before the shuffle. Two
other kinds of work do. A window function puts every row of a key in one task; operators
that need one ask for the hot keys and divide them by time. A join against one row per key
sends every row of a key to one task, and adaptive execution does not split it when the
other side comes straight from an aggregate; ``join_per_key`` deals hot keys to many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 100_000
# The list of hot keys is broadcast, some tens of megabytes at most.
MAX_HOT_KEYS = 1_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and more than one row in ``max_keys``.

    The second bound makes them fewer than ``max_keys`` whatever the data; a key below it holds
    less than a millionth of all rows. Nothing is ordered or limited.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))
    all_rows = counts.agg(F.coalesce(F.sum("key_rows"), F.lit(0))).scalar()
    is_hot = (F.col("key_rows") > hot_rows) & (F.col("key_rows") * max_keys > all_rows)
    return counts.where(is_hot).select(key)


JOIN_HOT_ROWS = 1_000_000
#: Tasks that the rows of one hot key are dealt to in a join.
SLICES = 64


def join_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    how: str = "left",
    hot_rows: int = JOIN_HOT_ROWS,
) -> DataFrame:
    """Join many rows with a table that has at most one row per key.

    One shuffle join for all rows. Rows of hot keys, and rows without a key, are dealt to
    ``SLICES`` tasks by a hash of their values; the one row of a hot key is repeated for each of
    them. ``rows`` is read once for the counts and once for the join, ``per_key`` once.
    ``how`` is ``inner``, ``left`` or ``left_semi``; rows without a key match nothing.
    """
    hot = F.broadcast(hot_keys(rows, key, hot_rows).withColumn("_hot", F.lit(True)))
    hashable = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = F.pmod(F.xxhash64(*hashable), F.lit(SLICES)).cast("int")
    left = rows.join(hot, key, "left").withColumn("_slice", F.when(F.col("_hot") | F.col(key).isNull(), dealt).otherwise(0))
    slices = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(F.array(F.lit(0)))
    right = per_key.join(hot, key, "left").withColumn("_slice", F.explode(slices)).drop("_hot")
    return left.drop("_hot").join(right, [key, "_slice"], how).drop("_slice")
