"""The registered queries: every operator over the whole test tables.

Each takes ``(spark, sf_dir)``. Times are returned without zone so that they compare as
wall-clock UTC values.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmill.functions.columns import exact_avg, normalize_raw_event
from cardmill.operators import batch, boosting, drift, evaluation, quality, retrieval, rolling, sampling, training, windows
from cardmill.operators.trees import CompiledEnsemble, Tree, TreeSet, shap_values
from cardmill.plans import flow
from cardmill.session import configure, scratch_dir
from cardmill.sources import sinks, tables
from cardmill.streaming import features as stream_features
from cardmill.streaming import source, stateful

RUN_TIME = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
DRIFT_SPLIT = dt.datetime(2024, 1, 16, tzinfo=dt.timezone.utc)
REPLAY_BASE = 1_704_067_200.0  # 2024-01-01 UTC
WEEK = 7 * 86_400

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _zoneless(function(configure(spark), sf_dir))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return run


def _zoneless(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times}) if times else df


#: Cards of the point look-ups; the last has no rows.
LOOKUP_CARDS = ["8", "15", "21", "no such card"]


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/cardmill/{name}-{uuid.uuid4().hex}"


def _run_time() -> Column:
    return F.lit(RUN_TIME).cast("timestamp")


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.transactions(spark, sf_dir)


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.dirtied(_tx(spark, sf_dir))


def _batch(rows: DataFrame) -> DataFrame:
    return batch.batch_features(rows, _run_time())


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of scores of every transaction, from its id."""
    event_id = F.col("transaction_id") - 1
    scores = [
        F.struct(F.lit("a").alias("model"), (F.pmod(event_id * 7919, F.lit(1000)) / 1000.0).alias("score")),
        F.struct(F.lit("b").alias("model"), (F.pmod(event_id * 104729, F.lit(997)) / 997.0).alias("score")),
    ]
    return _tx(spark, sf_dir).select("is_fraud", "amount", F.inline(F.array(*scores)))


def _raw(rows: DataFrame) -> DataFrame:
    """Transactions under the column names of the raw file."""
    return rows.select(
        F.col("transaction_id").alias("TransactionID"),
        F.col("is_fraud").alias("isFraud"),
        F.col("transaction_dt").alias("TransactionDT"),
        F.col("amount").alias("TransactionAmt"),
        F.col("product_cd").alias("ProductCD"),
        F.col("card_id").try_cast("bigint").alias("card1"),
        F.lit(None).cast("string").alias("card4"),
        F.lit(None).cast("string").alias("card6"),
        F.lit(None).cast("string").alias("P_emaildomain"),
        F.col("addr1"),
        F.lit(None).cast("double").alias("C1"),
        F.col("c2").alias("C2"),
        F.col("d4").alias("D4"),
    )


# Scans and sinks


@query
def s1_typed_scan(spark, sf_dir):
    """The dirtied table as a raw CSV file, read with types; rows without a card go."""
    path = _scratch(spark, "csv")
    _raw(_dirty(spark, sf_dir)).write.option("header", True).csv(path)
    return tables.typed_transactions(tables.raw_csv(spark, path))


@query
def s2_first_rows(spark, sf_dir):
    """The first 50,000 transactions."""
    return tables.first_transactions(_tx(spark, sf_dir))


@query
def s2_binding_limit(spark, sf_dir):
    """A limit that is smaller than the table."""
    return tables.first_transactions(_tx(spark, sf_dir), 1_000)


@query
def s3_replay(spark, sf_dir):
    """S3, L1: the raw rows in replay order."""
    return tables.replay_order(_raw(_tx(spark, sf_dir))).select("TransactionID", "TransactionDT", "card1")


@query
def s7_lakehouse(spark, sf_dir):
    """Features written under year/month/day and read back, twice into one partition."""
    path = _scratch(spark, "lake")
    rows = _batch(_tx(spark, sf_dir))
    sinks.write_lakehouse(rows, path, RUN_TIME)
    sinks.write_lakehouse(rows, path, RUN_TIME)
    return spark.read.parquet(path).drop("event_timestamp")


@query
def s11_batch_quarantine(spark, sf_dir):
    """Rejected feature rows by run date."""
    path = _scratch(spark, "rejected")
    checked = quality.with_failures(_batch(_dirty(spark, sf_dir)), quality.BATCH_CHECKS)
    sinks.write_batch_quarantine(quality.failing_rows(checked), path, RUN_TIME.date())
    return spark.read.parquet(path).select("card_id", "trans_count_30d", F.array_join(quality.REASONS, ",").alias("reasons"))


def _online_by_week(spark, sf_dir):
    """An online table after one upsert per week and a compaction, with a delta on top."""
    table = sinks.OnlineTable(
        _scratch(spark, "online"), stream_features.VECTOR_SCHEMA, "card_id", ("last_updated", "transaction_id"), 2
    )
    path = _scratch(spark, "vectors")
    rolling.rolling_features(_tx(spark, sf_dir)).select(stream_features.VECTOR_SCHEMA.fieldNames()).write.parquet(path)
    vectors = spark.read.parquet(path)
    week = F.floor((F.dayofmonth("last_updated") - 1) / 7)
    for number in range(5):
        table.upsert(vectors.where(week == number), number)
        table.compact_if_due(spark, number)
    return table


@query
def s13_online_upsert(spark, sf_dir):
    """The latest vector per card after one upsert per week and a compaction."""
    return _online_by_week(spark, sf_dir).read(spark)


@query
def p12_online(spark, sf_dir):
    """The latest vectors of some cards, from the files that can hold them."""
    return _online_by_week(spark, sf_dir).lookup(spark, LOOKUP_CARDS)


@query
def p12_keyed(spark, sf_dir):
    """The transactions of some cards from a table laid out by card."""
    rows = _tx(spark, sf_dir).select("transaction_id", "card_id", "amount", "event_time")
    table = sinks.KeyedTable(_scratch(spark, "by-card"), rows.schema, "card_id")
    table.write(rows)
    return table.lookup(spark, LOOKUP_CARDS)


@query
def s15_latest_partition(spark, sf_dir):
    """The newest of two lakehouse partitions."""
    path = _scratch(spark, "lake")
    rows = _tx(spark, sf_dir)
    early = rows.where(F.col("event_time") < F.lit(DRIFT_SPLIT))
    sinks.write_lakehouse(_batch(early), path, DRIFT_SPLIT)
    sinks.write_lakehouse(_batch(rows), path, RUN_TIME)
    return tables.latest_partition(spark, path).select("card_id", "trans_count_30d", "month", "day")


# Projections and filters


@query
def p3_valid_events(spark, sf_dir):
    """Events that pass every check."""
    return quality.valid_events(_dirty(spark, sf_dir)).select("transaction_id", "card_id", "amount", "event_time")


@query
def p2_sanitized(spark, sf_dir):
    """The nine columns kept of a valid event."""
    time = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")
    rows = _dirty(spark, sf_dir).select("*", F.col("d4").alias("c1"), F.col("product_cd").alias("p_emaildomain"), time)
    return quality.sanitized(rows)


@query
def s12_messages(spark, sf_dir):
    """Rejected events as messages of the quarantine topic, read back."""
    checked = quality.failing_rows(quality.with_failures(_dirty(spark, sf_dir), quality.EVENT_CHECKS))
    messages = source.quarantine_messages(checked.select("transaction_id", "card_id", "amount", quality.REASONS))
    schema = f"transaction_id bigint, card_id string, amount double, {quality.REASONS} array<string>"
    read = messages.select(F.col("key").alias("message_key"), F.from_json("value", schema).alias("v")).select("message_key", "v.*")
    return read.withColumn("reasons", F.array_join(quality.REASONS, ",")).drop(quality.REASONS)


@query
def p4_normalized(spark, sf_dir):
    """Raw rows to events with defaults and a replayed event time."""
    return normalize_raw_event(_raw(_dirty(spark, sf_dir)), REPLAY_BASE)


@query
def p12_card(spark, sf_dir):
    """The transactions of one card."""
    return retrieval.lookup(_tx(spark, sf_dir), "8").select("transaction_id", "card_id", "amount")


# Joins and retrieval


@query
def j2_training(spark, sf_dir):
    """The training set."""
    rows = _tx(spark, sf_dir)
    return training.training_set(rows, _batch(rows))


def _two_runs(rows: DataFrame) -> DataFrame:
    """Batch features of a run in mid-month and of one after it."""
    early = rows.where(F.col("event_time") < F.lit(DRIFT_SPLIT))
    return batch.batch_features(early, F.lit(DRIFT_SPLIT).cast("timestamp")).unionByName(_batch(rows))


@query
def m1_point_in_time(spark, sf_dir):
    """The training set without features from after the transaction."""
    rows = _tx(spark, sf_dir)
    return training.training_set(rows, _two_runs(rows), point_in_time=True)


def _daily(rows: DataFrame) -> DataFrame:
    """A feature history: each card's day, known from the next midnight on."""
    known = (F.date_trunc("day", "event_time") + F.expr("INTERVAL 1 DAY")).alias("known_at")
    return rows.groupBy("card_id", known).agg(
        F.count(F.lit(1)).alias("day_count"),
        exact_avg(F.col("amount")).alias("day_avg_amount"),
        F.max("amount").alias("day_max_amount"),
    )


@query
def j3_point_in_time(spark, sf_dir):
    """Every transaction with its card's newest daily features of the last seven days."""
    rows = _tx(spark, sf_dir)
    return retrieval.point_in_time_join(
        rows.select("transaction_id", "card_id", "event_time"),
        _daily(rows),
        ["day_count", "day_avg_amount", "day_max_amount"],
        "card_id",
        "event_time",
        "known_at",
        WEEK,
    )


@query
def j3_point_in_time_hot(spark, sf_dir):
    """J3 with every card above ten rows divided into minutes."""
    rows = _tx(spark, sf_dir)
    return retrieval.point_in_time_join(
        rows.select("transaction_id", "card_id", "event_time"),
        _daily(rows),
        ["day_count", "day_avg_amount", "day_max_amount"],
        "card_id",
        "event_time",
        "known_at",
        WEEK,
        hot_rows=10,
    )


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dirty(spark, sf_dir).select("transaction_id", "card_id", F.abs("amount").alias("current_amount"))


@query
def j4_lookup(spark, sf_dir):
    """Stored features of every request's card, with defaults for unknown cards."""
    return retrieval.with_lookup_defaults(_requests(spark, sf_dir), _batch(_tx(spark, sf_dir)))


@query
def j4_lookup_hot(spark, sf_dir):
    """J4 with every card above ten requests dealt to many tasks."""
    return retrieval.with_lookup_defaults(_requests(spark, sf_dir), _batch(_tx(spark, sf_dir)), hot_rows=10)


def _online(rows: DataFrame) -> dict[str, DataFrame]:
    return {
        "card_batch_features": _batch(rows),
        "card_stream_features": retrieval.latest_per_key(
            rolling.rolling_features(rows), "card_id", "last_updated", "transaction_id"
        ),
    }


@query
def e8_historical(spark, sf_dir):
    """Named batch features at the time of every transaction, from two runs."""
    rows = _tx(spark, sf_dir)
    history = _two_runs(rows)
    entities = rows.select("transaction_id", "card_id", F.col("event_time").alias("event_timestamp"))
    names = ["card_batch_features:trans_count_7d", "card_batch_features:max_amount_30d"]
    return retrieval.historical_features(entities, names, {"card_batch_features": history})


def _two_views(spark, sf_dir, hot_rows):
    """Batch and stream features an hour after every transaction, or ten days after every third."""
    rows = _tx(spark, sf_dir)
    later = F.when(F.col("transaction_id") % 3 == 0, F.expr("INTERVAL 10 DAYS")).otherwise(F.expr("INTERVAL 1 HOUR"))
    entities = rows.select("transaction_id", "card_id", (F.col("event_time") + later).alias("event_timestamp"))
    sources = {"card_batch_features": _two_runs(rows), "card_stream_features": rolling.rolling_features(rows)}
    names = [
        "card_stream_features:trans_count_1h",
        "card_batch_features:trans_count_30d",
        "card_stream_features:max_amount_24h",
        "card_batch_features:max_amount_30d",
    ]
    return retrieval.historical_features(entities, names, sources, full_names=True, hot_rows=hot_rows)


@query
def e8_views(spark, sf_dir):
    """Features of two views at the time of each request, in one pass."""
    return _two_views(spark, sf_dir, retrieval.HOT_ROWS)


@query
def e8_views_hot(spark, sf_dir):
    """E8 with every card above ten rows divided into cells of a minute."""
    return _two_views(spark, sf_dir, 10)


ON_DEMAND_NAMES = [
    "card_batch_features:avg_amount_30d",
    "card_batch_features:max_amount_30d",
    "card_stream_features:trans_count_5m",
    "card_stream_features:avg_amount_24h",
    "card_on_demand_features:amount_ratio_24h",
    "card_on_demand_features:amount_ratio_30d",
    "card_on_demand_features:amount_zscore_24h",
    "card_on_demand_features:is_amount_gt_30d_max",
    "card_on_demand_features:is_high_velocity_5m",
]


@query
def e9_on_demand(spark, sf_dir):
    """Request-time features of every request."""
    return retrieval.online_features(_requests(spark, sf_dir), _online(_tx(spark, sf_dir)), ON_DEMAND_NAMES)


@query
def e9_on_demand_hot(spark, sf_dir):
    """E9 with every card above ten requests dealt to many tasks."""
    return retrieval.online_features(_requests(spark, sf_dir), _online(_tx(spark, sf_dir)), ON_DEMAND_NAMES, hot_rows=10)


@query
def e2_materialize(spark, sf_dir):
    """Newest daily row per card within a date range."""
    view = retrieval.FeatureView(
        "card_daily",
        "card_id",
        "known_at",
        WEEK,
        T.StructType([T.StructField("day_count", T.LongType()), T.StructField("day_max_amount", T.DoubleType())]),
    )
    start = dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc)
    return retrieval.materialize(_daily(_tx(spark, sf_dir)), view, start, DRIFT_SPLIT)


# Aggregates


@query
def a1_batch_features(spark, sf_dir):
    """Batch features per card."""
    return _batch(_tx(spark, sf_dir))


@query
def a1_wide_amounts(spark, sf_dir):
    """A1 over very large amounts and ones of many places; the mean as a share of the maximum."""
    kind = F.pmod(F.col("card_id").cast("bigint"), F.lit(3))
    amount = F.when(kind == 0, F.col("amount") * 1e12).when(kind == 1, F.col("amount") / 1e5).otherwise(F.col("amount"))
    rows = _batch(_tx(spark, sf_dir).withColumn("amount", amount))
    share = F.round(F.col("avg_amount_30d") / F.col("max_amount_30d"), 9).alias("mean_share")
    return rows.select("card_id", "trans_count_30d", "max_amount_30d", share)


@query
def a1_windowed(spark, sf_dir):
    """A1 with true 7 and 30 day windows."""
    return batch.batch_features(_tx(spark, sf_dir), _run_time(), mode="windowed")


@query
def a1_incremental(spark, sf_dir):
    """A1 with true windows from stored days: a backfill, then two daily runs, each over its own day."""
    path = _scratch(spark, "by-day")
    _tx(spark, sf_dir).withColumn("day", windows.day_number()).write.partitionBy("day").parquet(path)
    rows = spark.read.parquet(path)
    stored = windows.DayPartials(_scratch(spark, "partials"))
    last = rows.agg(F.max("day")).first()[0]
    stored.update(rows.where(F.col("day") < last - 1), 0)
    stored.update(rows.where(F.col("day") == last - 1), 1, 0)
    stored.update(rows.where(F.col("day") == last), 2, 1)
    return stored.features(spark, rows, 2, _run_time())


@query
def a2_balance(spark, sf_dir):
    """A2: class balance."""
    return batch.class_balance(_tx(spark, sf_dir))


@query
def a3_labels(spark, sf_dir):
    """A3: label summary."""
    return batch.label_summary(_tx(spark, sf_dir))


@query
def a4_null_ratio(spark, sf_dir):
    """A4: largest share of nulls over the columns, and whether it is above the bound."""
    rows = _dirty(spark, sf_dir)
    ratio = rows.agg(quality.max_null_ratio(rows).alias("max_null_ratio"))
    return ratio.withColumn("is_warning", F.col("max_null_ratio") > quality.NULL_RATIO_WARNING)


@query
def a5_counts(spark, sf_dir):
    """A5: valid and corrupt events."""
    return quality.validity_counts(_dirty(spark, sf_dir), quality.EVENT_CHECKS)


@query
def a6_dedup(spark, sf_dir):
    """The first of several copies of each transaction."""
    rows = _tx(spark, sf_dir).select("transaction_id", "card_id", "amount")
    copies = rows.unionAll(rows.withColumn("amount", F.col("amount") + 1.0))
    return batch.first_per_key(copies, "transaction_id", "amount")


# Rolling windows


@query
def w1_counts(spark, sf_dir):
    """Events per card in the last minute, five minutes and hour."""
    return rolling.rolling_features(_tx(spark, sf_dir)).select(
        "transaction_id", "card_id", "trans_count_1m", "trans_count_5m", "trans_count_1h"
    )


@query
def w2_hour(spark, sf_dir):
    """Amounts and c2 of the last hour."""
    return rolling.rolling_features(_tx(spark, sf_dir)).select(
        "transaction_id", "total_amount_1h", "avg_amount_1h", "c2_count_sum_1h"
    )


@query
def w4_day(spark, sf_dir):
    """Mean, maximum and deviation of the last 24 hours."""
    return rolling.rolling_features(_tx(spark, sf_dir)).select(
        "transaction_id", "avg_amount_24h", "max_amount_24h", "stddev_amount_24h"
    )


@query
def w4_day_divided(spark, sf_dir):
    """W1-W5 with every card divided into minutes, as a hot card is."""
    return rolling.rolling_features(_tx(spark, sf_dir), hot_rows=0)


@query
def w6_equal_times(spark, sf_dir):
    """W1, W4, W6 where many events of a card have one time: those that arrived before count."""
    rows = _tx(spark, sf_dir).withColumn("event_time", F.date_trunc("day", "event_time"))
    vectors = rolling.rolling_features(rows)
    return vectors.select("transaction_id", "trans_count_1h", "total_amount_1h", "avg_amount_24h", "max_amount_24h")


@query
def w7_rounded(spark, sf_dir):
    """The online vector's two decimal places."""
    return rolling.rolling_features(_tx(spark, sf_dir), rounded=True).select(
        "transaction_id", "total_amount_1h", "max_amount_24h", "c2_count_sum_1h"
    )


@query
def w8_latest(spark, sf_dir):
    """Latest vector per card."""
    return _online(_tx(spark, sf_dir))["card_stream_features"]


# Samples


@query
def l3_sample(spark, sf_dir):
    """L3: 2,000 transactions picked by hash."""
    rows = _tx(spark, sf_dir).select("transaction_id", "card_id", "amount")
    return sampling.seeded_sample(rows, "transaction_id")


@query
def l4_split(spark, sf_dir):
    """L4: every transaction as train or test."""
    rows = _tx(spark, sf_dir).select("transaction_id", "is_fraud")
    return sampling.stratified_split(rows, "transaction_id", "is_fraud")


@query
def l4_split_sizes(spark, sf_dir):
    """L4: rows per label and side."""
    return l4_split(spark, sf_dir).groupBy("is_fraud", "is_test").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def l5_union(spark, sf_dir):
    """Old and new archive as one table."""
    rows = _tx(spark, sf_dir).select("transaction_id", "card_id", "amount", "event_time")
    old = rows.where(F.col("event_time") < F.lit(DRIFT_SPLIT))
    new = rows.where(F.col("event_time") >= F.lit(DRIFT_SPLIT))
    return old.unionByName(new)


# Quality and drift


@query
def q1_gate_clean(spark, sf_dir):
    """Feature rows that pass the gate."""
    checked = quality.with_failures(_batch(_dirty(spark, sf_dir)), quality.BATCH_CHECKS)
    return quality.coerced(quality.clean_rows(checked), quality.BATCH_CHECKS)


@query
def q3_failures(spark, sf_dir):
    """Q2, Q3: failing events per check."""
    return quality.failure_counts(_dirty(spark, sf_dir), quality.EVENT_CHECKS)


@query
def t3_quarantine(spark, sf_dir):
    """Rejected events with their reasons."""
    checked = quality.with_failures(_dirty(spark, sf_dir), quality.EVENT_CHECKS)
    return quality.failing_rows(checked).select(
        "transaction_id", "card_id", "amount", F.array_join(quality.REASONS, ",").alias("reasons")
    )


def _column_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tx(spark, sf_dir).select("event_time", "amount", "c2", "d4", "is_fraud")
    before = F.col("event_time") < F.lit(DRIFT_SPLIT)
    return drift.column_drift(rows.where(before).drop("event_time"), rows.where(~before).drop("event_time"))


@query
def q7_drift(spark, sf_dir):
    """Drift of every numeric column between two halves of the month."""
    return _column_drift(spark, sf_dir)


@query
def q7_distance(spark, sf_dir):
    """Q7: distance drift of every numeric column between two halves of the month."""
    rows = _tx(spark, sf_dir).select("event_time", "amount", "c2", "d4", "is_fraud")
    before = F.col("event_time") < F.lit(DRIFT_SPLIT)
    found = drift.distance_drift(rows.where(before).drop("event_time"), rows.where(~before).drop("event_time"))
    return found.withColumn("drift_score", F.round("drift_score", 9))


@query
def q8_verdict(spark, sf_dir):
    """Q8: the verdict over the columns."""
    return drift.dataset_drift(_column_drift(spark, sf_dir))


# Evaluation


@query
def m7_sweep(spark, sf_dir):
    """M7: cost of each of the 90 thresholds."""
    return evaluation.threshold_curve(_scored(spark, sf_dir)).select(
        "model", "threshold_index", "threshold", "fn_cost", "fp_cost", "total_cost"
    )


@query
def m8_best_f(spark, sf_dir):
    """M7-M9: optimal thresholds and the savings."""
    return evaluation.best_thresholds(evaluation.threshold_curve(_scored(spark, sf_dir)))


@query
def m10_pr_auc(spark, sf_dir):
    """Area under the precision-recall curve, to nine places."""
    return evaluation.areas(_scored(spark, sf_dir)).select("model", F.round("pr_auc", 9).alias("pr_auc"))


@query
def m11_roc_auc(spark, sf_dir):
    """Area under the ROC curve."""
    return evaluation.areas(_scored(spark, sf_dir)).select("model", "roc_auc")


@query
def m12_confusion(spark, sf_dir):
    """Confusion counts and F1 at 0.37."""
    return evaluation.confusion(_scored(spark, sf_dir), 0.37)


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of which some are missing and some are no numbers."""
    kind = F.pmod(F.floor(F.col("score") * 1000), F.lit(20))
    gap = F.when(kind == 3, F.lit(None).cast("double")).when(kind == 4, F.lit(float("nan"))).otherwise(F.col("score"))
    return _scored(spark, sf_dir).withColumn("score", gap)


@query
def m12_missing_scores(spark, sf_dir):
    """Missing scores count as the lowest in the confusion, the sweep and the areas."""
    rows = _gappy(spark, sf_dir)
    swept = evaluation.threshold_curve(rows).where("threshold_index = 36").select(
        "model", F.col("tp").alias("sweep_tp"), F.col("fp").alias("sweep_fp"), (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("sweep_rows")
    )
    areas = evaluation.areas(rows).select("model", "roc_auc")
    return evaluation.confusion(rows, 0.37).join(swept, "model").join(areas, "model")


@query
def m13_points(spark, sf_dir):
    """Points of the ROC and precision-recall curves."""
    return evaluation.curve_points(_scored(spark, sf_dir))


@query
def m14_curve(spark, sf_dir):
    """Counts, precision, recall, F1 and F2 at each threshold."""
    return evaluation.threshold_curve(_scored(spark, sf_dir)).select(
        "model", "threshold_index", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "f2"
    )


@query
def m15_report(spark, sf_dir):
    """Per-class report at 0.5."""
    return evaluation.class_report(_scored(spark, sf_dir), 0.5)


@query
def m16_comparison(spark, sf_dir):
    """The models side by side, each at its own threshold."""
    table = evaluation.comparison(_scored(spark, sf_dir), {"a": 0.5, "b": 0.37})
    return table.withColumn("pr_auc", F.round("pr_auc", 9))


# Learning


def _trained(spark: SparkSession, sf_dir: str):
    rows = _tx(spark, sf_dir)
    path = _scratch(spark, "training")
    training.training_set(rows, _batch(rows)).write.parquet(path)
    dataset = spark.read.parquet(path)
    return dataset, *training.train_ensemble(dataset, second="forest")


@query
def m2_train_report(spark, sf_dir):
    """Both learners, the blend and the evaluation report, stored and read back.

    Figures that do not depend on the learners: sizes, features, and that every confusion matrix
    holds the whole validation set.
    """
    path = _scratch(spark, "report")
    sinks.write_report(_trained(spark, sf_dir)[2], path)
    report = spark.read.json(path)
    whole = F.lit(True)
    for model in ("boosted", "forest", "ensemble_default_05", "ensemble_optimal"):
        cells = F.flatten(f"metrics.{model}.confusion_matrix")
        whole = whole & (F.aggregate(cells, F.lit(0).cast("bigint"), lambda a, b: a + b) == F.col("val_size"))
    return report.select(
        "dataset_size", "train_size", "val_size", "feature_count", F.array_join("feature_names", ",").alias("features"), whole.alias("whole")
    )


BOOSTED = ["amount", "c2", "d4"]
#: Cuts that the first round may make, by feature.
BOOSTED_EDGES = [[float(e) for e in range(5, 250, 5)], [float(e) for e in range(4, 100, 4)], [float(e) for e in range(6)]]
POSITIVE_WEIGHT = 3.5


def _booster_input(spark: SparkSession, sf_dir: str) -> tuple:
    weight = F.when(F.col("is_fraud") == 1, POSITIVE_WEIGHT).otherwise(1.0)
    return _tx(spark, sf_dir).select("transaction_id", "is_fraud", *BOOSTED), BOOSTED, F.col("is_fraud"), weight


@query
def m2_split_gains(spark, sf_dir):
    """M2: what every cut of every feature gains in the first round of boosting."""
    gains = boosting.split_gains(*_booster_input(spark, sf_dir), BOOSTED_EDGES, boosting.Growth())
    return gains.withColumn("gain", F.round("gain", 6))


@query
def m2_first_split(spark, sf_dir):
    """M2, M3: every transaction scored after one round with one split."""
    one = boosting.Growth(trees=1, depth=1, rate=0.5)
    rows, features, label, weight = _booster_input(spark, sf_dir)
    member = boosting.fit_boosted(rows, features, label, weight, one, BOOSTED_EDGES)
    return rows.select("transaction_id", F.round(member.score(), 9).alias("score"))


@query
def m2_learned(spark, sf_dir):
    """M2: a rule over three features, learned by the leaf-wise booster: transactions that the rule and
    the score tell apart. The rule is a box of amounts and keys, whose sides are at edges of bins."""
    rows = _booster_input(spark, sf_dir)[0]
    rule = (F.col("amount") > 40) & (F.col("amount") <= 120) & (F.col("c2") > 24) & (F.col("d4") > 1)
    rows = rows.withColumn("rule", F.coalesce(rule, F.lit(False)).cast("int"))
    growth = boosting.Growth(trees=8, depth=6, leaves=12, rate=0.5)
    member = boosting.fit_boosted(rows, BOOSTED, F.col("rule"), None, growth, BOOSTED_EDGES)
    scored = rows.select("rule", (member.score() >= 0.5).cast("int").alias("predicted"))
    return scored.groupBy("rule", "predicted").agg(F.count(F.lit(1)).alias("n"))


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as they come, with amounts that are no amounts and missing cards."""
    return _dirty(spark, sf_dir).select("transaction_id", "card_id", F.col("amount").alias("current_amount"))


@query
def m5_rejected(spark, sf_dir):
    """M5: requests that are not scored, and why."""
    errors = _asked(spark, sf_dir).withColumn("errors", training.request_errors())
    return errors.where(F.size("errors") > 0).withColumn("errors", F.array_join("errors", ","))


@query
def m5_score(spark, sf_dir):
    """M3-M5: look-up, derivation, blend and decision for every valid request, with member scores
    made from the transaction's id."""
    valid = _asked(spark, sf_dir).where(F.size(training.request_errors()) == 0)
    inputs = training.request_features(valid, _batch(_tx(spark, sf_dir)))
    event_id = F.col("transaction_id") - 1
    members = inputs.withColumns(
        {
            "boosted_score": F.pmod(event_id * 7919, F.lit(1000)) / 1000.0,
            "second_score": F.pmod(event_id * 104729, F.lit(997)) / 997.0,
        }
    )
    blend = training.blended(members, {"boosted_score": 0.5, "second_score": 0.5})
    scored = blend.withColumn("prediction", evaluation.labelled(F.col("fraud_score"), 0.37))
    answers = training.decisions(scored, ["transaction_id", "card_id", "current_amount"], 0.37)
    used = F.col("features_used")
    names = ("trans_count_7d", "max_amount_30d", "is_amount_gt_30d_max")
    return answers.select(
        "transaction_id", "card_id", "current_amount", "is_fraud", "decision", "decision_threshold", *[used[n].alias(n) for n in names]
    )


def _leaf_value(value: float, cover: float) -> tuple:
    return -1, 0.0, -1, -1, value, cover


def _tree(weight: float, *nodes: tuple) -> Tree:
    return Tree(weight, *map(list, zip(*nodes)))


#: Three small trees over two features, f0 and f1; one asks for the same feature twice on a path.
FIXED_TREES = [
    _tree(0.5, (0, 100.0, 1, 2, 0.0, 8.0), _leaf_value(1.0, 4.0), (1, 50.0, 3, 4, 0.0, 4.0), _leaf_value(2.0, 3.0), _leaf_value(-1.0, 1.0)),
    _tree(1.0, (1, 20.0, 1, 2, 0.0, 8.0), _leaf_value(0.5, 2.0), (0, 300.0, 3, 4, 0.0, 6.0), _leaf_value(-0.25, 3.0), _leaf_value(4.0, 3.0)),
    _tree(0.25, (0, 200.0, 1, 2, 0.0, 8.0), (0, 50.0, 3, 4, 0.0, 4.0), _leaf_value(3.0, 4.0), _leaf_value(0.5, 2.0), _leaf_value(1.5, 2.0)),
]


@query
def m5_compiled(spark, sf_dir):
    """M3-M5: every valid request scored by a stored model of two members, as generated code."""
    path = _scratch(spark, "model")
    names = [training.AMOUNT, "trans_count_7d"]
    TreeSet(names, FIXED_TREES).write(spark, f"{path}/boosted")
    TreeSet(names, FIXED_TREES[1:]).write(spark, f"{path}/forest")
    ensemble = CompiledEnsemble(
        TreeSet.read(spark, f"{path}/boosted", names, "logistic"), TreeSet.read(spark, f"{path}/forest", names), 0.5, 0.125, 0.6
    )
    online = _batch(_tx(spark, sf_dir))
    answers = training.score_requests(_asked(spark, sf_dir), online, ensemble)
    return answers.select(
        "transaction_id", "card_id", "is_fraud", "fraud_score", "boosted_score", F.col("second_score").alias("forest_score"), "decision"
    )


@query
def m6_shap(spark, sf_dir):
    """M6: SHAP values of every transaction for three small trees, with their sum and the raw score."""
    member = TreeSet(["amount", "c2"], FIXED_TREES)
    rows = _tx(spark, sf_dir).select("transaction_id", "amount", "c2", member.raw().alias("raw_score"))
    return shap_values(rows, [member], ["transaction_id", "raw_score"])


@query
def m6_permuted(spark, sf_dir):
    """M6: the sample and its copies with one feature permuted, as they are scored."""
    rows = _tx(spark, sf_dir).withColumn("ratio", F.col("amount") * 2.0)
    return training.permuted_inputs(rows, ["amount", "c2", "ratio"], "transaction_id", 500)


@query
def m6_importance(spark, sf_dir):
    """M6: ranked feature importance."""
    dataset, ensemble, _ = _trained(spark, sf_dir)
    return training.feature_importance(dataset, ensemble)


# Streaming


def _messages(spark: SparkSession, sf_dir: str, dirty: bool) -> DataFrame:
    """The events table as a stream of JSON messages."""
    events = tables.table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events*.parquet")
    rows = tables.as_transactions(stream)
    rows = tables.dirtied(rows) if dirty else rows
    timestamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp")
    return source.to_messages(rows.select("transaction_id", "card_id", "amount", "c2", "product_cd", timestamp))


def _streamed(spark: SparkSession, sf_dir: str, dirty: bool) -> stream_features.StreamTables:
    stores = stream_features.StreamTables(_scratch(spark, "stream"))
    stream_features.start_features(_messages(spark, sf_dir, dirty), stores).awaitTermination()
    return stores


@query
def t2_stream(spark, sf_dir):
    """Rolling counts of every event from the streaming job."""
    vectors = _streamed(spark, sf_dir, dirty=False).vectors.read(spark)
    return vectors.select("transaction_id", "card_id", "trans_count_1m", "trans_count_5m", "trans_count_1h")


def _topic(spark: SparkSession, rows: DataFrame, copies: int = 1) -> DataFrame:
    """The transactions as a numbered topic that arrives in seven micro-batches of some days each.

    One pass deals the messages to the slices; each slice is then written as several files.
    """
    files = 4
    timestamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp")
    part = F.floor((F.dayofmonth("event_time") - 1) / 5).alias("slice")
    number = F.col("transaction_id").alias("arrived_no")
    messages = rows.select(
        F.to_json(F.struct("transaction_id", "card_id", "amount", "c2", "product_cd", timestamp)).alias("value"), number, part
    )
    staged, path = _scratch(spark, "slices"), _scratch(spark, "topic")
    messages.write.partitionBy("slice").parquet(staged)
    stored = spark.read.parquet(staged)
    for each in range(7):
        own = stored.where(F.col("slice") == each).select("value", "arrived_no", F.explode(F.array([F.lit(0)] * copies)))
        own.drop("col").repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema("value string, arrived_no long").option("maxFilesPerTrigger", files).parquet(path)


@query
def t2_stream_batches(spark, sf_dir):
    """All nine features of every event from a stream of seven micro-batches."""
    stores = stream_features.StreamTables(_scratch(spark, "stream"))
    stream_features.start_features(_topic(spark, _tx(spark, sf_dir)), stores).awaitTermination()
    return stores.vectors.read(spark)


def _stateful(spark: SparkSession, raw: DataFrame, **options) -> stream_features.StreamTables:
    stores = stream_features.StreamTables(_scratch(spark, "stateful"))
    stateful.start_stateful(raw, stores, **options).awaitTermination()
    return stores


@query
def t2_stateful(spark, sf_dir):
    """All nine features of every event from keyed state; busy cards have several state keys."""
    rows = _tx(spark, sf_dir)
    busy = stateful.hot_cards(rows, max(1, rows.count() // 140))
    return _stateful(spark, _topic(spark, rows), hot=busy).vectors.read(spark)


@query
def a6_stream_once(spark, sf_dir):
    """The same vectors from a topic that sends every event twice."""
    return _stateful(spark, _topic(spark, _tx(spark, sf_dir), copies=2), once=True).vectors.read(spark)


@query
def t1_card_minutes(spark, sf_dir):
    """Events and amount per card and minute, for the minutes the watermark has passed."""
    path = _scratch(spark, "minutes")
    minutes = stateful.card_minutes(_topic(spark, _tx(spark, sf_dir)), "10 minutes")
    writer = minutes.writeStream.option("checkpointLocation", _scratch(spark, "checkpoint")).trigger(availableNow=True)
    writer.outputMode("append").format("parquet").start(path).awaitTermination()
    return spark.read.schema(minutes.schema).parquet(path)


@query
def t3_stream_quarantine(spark, sf_dir):
    """Events the streaming job quarantines."""
    rows = _streamed(spark, sf_dir, dirty=True).quarantine.read(spark)
    return rows.select("transaction_id", "card_id", "amount", F.array_join(quality.REASONS, ",").alias("reasons"))


@query
def t4_archive(spark, sf_dir):
    """Events the streaming job archives."""
    rows = _streamed(spark, sf_dir, dirty=True).archive.read(spark)
    return rows.select("transaction_id", "card_id", "amount", "c2", "product_cd", "event_timestamp", "late")


# Audit and decision


@query
def o1_audit(spark, sf_dir):
    """O1: state of the online, lakehouse and quarantine tables."""
    rows = _dirty(spark, sf_dir)
    valid = quality.valid_events(rows)
    bad = quality.failing_rows(quality.with_failures(rows, quality.EVENT_CHECKS))
    online = retrieval.latest_per_key(valid.select("card_id", "event_time", "transaction_id"), "card_id", "event_time", "transaction_id")
    return flow.audit(online, "8", _batch(valid), bad)


@query
def o2_retrain(spark, sf_dir):
    """O2: the decision for each way of starting a run, given the measured drift."""
    verdict = drift.dataset_drift(_column_drift(spark, sf_dir)).select("dataset_drift")
    starts = F.array(
        *[
            F.struct(F.lit(scheduled).alias("scheduled_run"), F.lit(forced).alias("force_retrain"))
            for scheduled in (False, True)
            for forced in (False, True)
        ]
    )
    return flow.retrain_decision(verdict.select("dataset_drift", F.inline(starts)))


@query
def o3_flow(spark, sf_dir):
    """O3: batch, gate, stream, materialize, audit, drift and training in one run."""
    stores = flow.FlowTables(_scratch(spark, "flow"))
    report = flow.run_flow(
        _dirty(spark, sf_dir), _messages(spark, sf_dir, dirty=True), stores, RUN_TIME, audit_card="8", second="forest"
    )
    outcome = {
        **report["step4_verification_audit"],
        "drift_status": report["step5_drift_monitoring"],
        "trigger_reason": report["ct_trigger_reason"],
    }
    cards = stores.online_batch.read(spark).agg(F.count(F.lit(1)).alias("online_cards"))
    return cards.select("online_cards", *[F.lit(value).alias(name) for name, value in outcome.items()])
