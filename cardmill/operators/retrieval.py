"""Feature views and their retrieval."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmill.functions.columns import MICROS, epoch_micros, or_default, with_on_demand_features
from cardmill.operators.batch import BATCH_FEATURES
from cardmill.operators.rolling import STREAM_FEATURES
from cardmill.operators.skew import HOT_ROWS, JOIN_HOT_ROWS, hot_keys, join_per_key

DAY = 86_400

# What a card without stored features is scored with.
LOOKUP_DEFAULTS = {
    "trans_count_7d": 1.0,
    "trans_count_30d": 5.0,
    "avg_amount_30d": 150.0,
    "max_amount_30d": 500.0,
    "distinct_addr_7d": 1.0,
    "days_since_last_trans": 2.0,
}


@dataclass(frozen=True)
class FeatureView:
    """A named set of typed features of one entity, valid for ``ttl_seconds``."""

    name: str
    entity: str
    timestamp: str
    ttl_seconds: int
    schema: T.StructType

    @property
    def features(self) -> list[str]:
        return self.schema.fieldNames()

    def select_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.entity, T.StringType()),
                T.StructField(self.timestamp, T.TimestampType()),
                *self.schema.fields,
            ]
        )

    def select(self, df: DataFrame) -> DataFrame:
        """The view's columns with their declared types."""
        return df.select(
            F.col(self.entity).cast("string").alias(self.entity),
            F.col(self.timestamp),
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields],
        )


def _schema(names: list[str]) -> T.StructType:
    counts = {"distinct_addr_7d"} | {name for name in names if name.startswith("trans_count")}
    return T.StructType([T.StructField(n, T.LongType() if n in counts else T.DoubleType()) for n in names])


CARD_BATCH = FeatureView("card_batch_features", "card_id", "event_timestamp", 365 * DAY, _schema(BATCH_FEATURES))
CARD_STREAM = FeatureView("card_stream_features", "card_id", "last_updated", 7 * DAY, _schema(STREAM_FEATURES))
ON_DEMAND = "card_on_demand_features"
VIEWS = {view.name: view for view in (CARD_BATCH, CARD_STREAM)}


def latest_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest row of every key, combined before the shuffle."""
    row = F.struct(*[F.col(name) for name in df.columns])
    rank = F.struct(*[F.col(name) for name in order])
    return df.groupBy(key).agg(F.max_by(row, rank).alias("newest")).select("newest.*")


def materialize(history: DataFrame, view: FeatureView, start, end) -> DataFrame:
    """The newest feature row per card with a timestamp in ``[start, end]``."""
    in_range = F.col(view.timestamp).between(F.lit(start), F.lit(end))
    return latest_per_key(view.select(history).where(in_range), view.entity, view.timestamp, *view.features)


def lookup(df: DataFrame, card_id: str, key: str = "card_id") -> DataFrame:
    """The rows of one card."""
    return df.where(F.col(key) == str(card_id))


@dataclass(frozen=True)
class History:
    """One side of a point-in-time join: rows of ``features`` known from ``time`` on, used for at
    most ``ttl_seconds``. ``names`` are the result's columns (default: those of the features),
    ``matched`` one that says whether a row was found, whatever its values."""

    rows: DataFrame
    time: str
    ttl_seconds: int
    features: list[str]
    names: list[str] | None = None
    matched: str | None = None


def point_in_time_join(
    entities: DataFrame,
    history: DataFrame,
    features: list[str],
    key: str,
    entity_time: str,
    feature_time: str,
    ttl_seconds: int,
    hot_rows: int = HOT_ROWS,
    cell_seconds: int = 60,
    matched: str | None = None,
) -> DataFrame:
    """Each entity row with the newest feature row at or before it and within the TTL.

    See ``point_in_time_views``, of which this is the case of one history.
    """
    side = History(history, feature_time, ttl_seconds, features, matched=matched)
    return point_in_time_views(entities, [side], key, entity_time, hot_rows, cell_seconds)


def point_in_time_views(
    entities: DataFrame,
    histories: list[History],
    key: str,
    entity_time: str,
    hot_rows: int = HOT_ROWS,
    cell_seconds: int = 60,
) -> DataFrame:
    """Each entity row with the newest row at or before it of each history, if within its TTL.

    Entities and all histories are merged into one time-ordered sequence per card, and the last
    row seen of each history is carried forward. No pair of rows is ever formed, so the work is
    linear in the rows however many lie within the TTL, and the entities are shuffled once
    however many histories there are.

    A card with too many rows for one task is divided into cells of ``cell_seconds``. The
    newest rows before each cell come from a roll-up with one row per card and cell.
    Among rows of one history of the same time the largest by value is taken.
    """
    points = entities.select(
        F.col(key),
        epoch_micros(F.col(entity_time)).alias("pit_t"),
        F.struct(*entities.columns).alias("entity"),
    )
    held = [f"vector{i}" for i in range(len(histories))]
    sequence = points
    for name, side in zip(held, histories):
        at = epoch_micros(F.col(side.time))
        known = side.rows.where(F.col(key).isNotNull() & F.col(side.time).isNotNull())
        known = known.select(F.col(key), at.alias("pit_t"), F.struct(at.alias("at"), *side.features).alias(name))
        sequence = sequence.unionByName(known, allowMissingColumns=True)
    hot = hot_keys(sequence.select(key).where(F.col(key).isNotNull()), key, hot_rows)
    hot = F.broadcast(hot.withColumn("is_hot", F.lit(True)))

    cell = F.floor(F.col("pit_t") / F.lit(cell_seconds * MICROS)).cast("bigint")
    # A card that fits in one task stays whole, in a single cell. Entities without a
    # card match nothing and are only spread out.
    spread = F.pmod(F.xxhash64("entity"), F.lit(4096))
    celled = sequence.join(hot, key, "left").withColumn(
        "cell", F.when(F.col("is_hot"), cell).when(F.col(key).isNull(), spread).otherwise(F.lit(-1))
    )

    # The newest rows before each cell of a divided card.
    per_cell = celled.where(F.col("is_hot")).groupBy(key, "cell").agg(
        *[F.max(name).alias(name) for name in held], F.count("entity").alias("cell_points")
    )
    earlier = Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    brought = per_cell.withColumns({name: F.last(name, ignorenulls=True).over(earlier) for name in held})
    brought = brought.withColumn("pit_t", F.greatest(*[F.col(f"{name}.at") for name in held + held[:1]]))
    brought = brought.where((F.col("cell_points") > 0) & F.col("pit_t").isNotNull()).drop("cell_points")

    # Within one time: features before entities, so that "at or before" is inclusive.
    rows = celled.drop("is_hot").unionByName(brought, allowMissingColumns=True)
    rows = rows.withColumn("part", F.col("entity").isNotNull().cast("int"))
    so_far = (
        Window.partitionBy(key, "cell")
        .orderBy("pit_t", "part", *held)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = rows.repartition(key, "cell")
    found = found.select("entity", "pit_t", "part", *[F.last(v, ignorenulls=True).over(so_far).alias(v) for v in held])
    columns = []
    for name, side in zip(held, histories):
        fresh = F.col(f"{name}.at") >= F.col("pit_t") - F.lit(side.ttl_seconds * MICROS)
        for feature, own in zip(side.features, side.names or side.features):
            columns.append(F.when(fresh, F.col(name).getField(feature)).alias(own))
        if side.matched:
            columns.append(F.coalesce(fresh, F.lit(False)).alias(side.matched))
    return found.where(F.col("part") == 1).select("entity.*", *columns)


def historical_features(
    entities: DataFrame,
    names: list[str],
    sources: dict[str, DataFrame],
    entity_time: str = "event_timestamp",
    full_names: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Point-in-time values of ``view:feature`` names; ``sources`` holds each view's history.

    Views of the same entity are joined in one pass. ``full_names`` calls a column
    ``view__feature``; without it a name that occurs twice is an error.
    """
    wanted: dict[str, list[str]] = {}
    for name in names:
        view, feature = name.split(":")
        if feature not in VIEWS[view].features:
            raise ValueError(f"{view} has no feature {feature}")
        wanted.setdefault(view, []).append(feature)
    own = {view: [f"{view}__{f}" if full_names else f for f in features] for view, features in wanted.items()}
    columns = [*entities.columns, *[name for view in own.values() for name in view]]
    twice = sorted({name for name in columns if columns.count(name) > 1})
    if twice:
        raise ValueError(f"columns occur twice: {', '.join(twice)}")
    result = entities
    for entity in dict.fromkeys(VIEWS[view].entity for view in wanted):
        sides = [
            History(sources[view], VIEWS[view].timestamp, VIEWS[view].ttl_seconds, features, own[view])
            for view, features in wanted.items()
            if VIEWS[view].entity == entity
        ]
        result = point_in_time_views(result, sides, entity, entity_time, hot_rows)
    return result.select(columns)


def with_lookup_defaults(requests: DataFrame, online_batch: DataFrame, hot_rows: int = JOIN_HOT_ROWS) -> DataFrame:
    """The six stored features of each request's card, each with its own default."""
    stored = online_batch.select("card_id", *LOOKUP_DEFAULTS)
    joined = join_per_key(requests, stored, "card_id", hot_rows=hot_rows)
    return joined.withColumns({name: or_default(F.col(name), value) for name, value in LOOKUP_DEFAULTS.items()})


def online_features(
    requests: DataFrame,
    online: dict[str, DataFrame],
    names: list[str] | None = None,
    hot_rows: int = JOIN_HOT_ROWS,
) -> DataFrame:
    """Batch and stream vectors of each request's card, and the on-demand features.

    ``requests`` has ``card_id`` and ``current_amount``; a card without a vector gets nulls,
    which the on-demand features read as zero. ``names`` selects ``view:feature`` columns.
    The views, one row per card each, are joined first, so the requests take part in one join.
    """
    stored = None
    for view_name, rows in online.items():
        view = VIEWS[view_name]
        rows = rows.select(view.entity, *view.features)
        stored = rows if stored is None else stored.join(rows, view.entity, "full")
    entity = VIEWS[next(iter(online))].entity
    result = with_on_demand_features(join_per_key(requests, stored, entity, hot_rows=hot_rows))
    if names is None:
        return result
    return result.select(*requests.columns, *[name.split(":")[1] for name in names])
