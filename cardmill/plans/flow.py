"""Audit, retrain decision and the end-to-end run."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmill.operators.batch import batch_features
from cardmill.operators.drift import drift_report
from cardmill.operators.quality import BATCH_CHECKS, gate
from cardmill.operators.retrieval import CARD_BATCH, materialize
from cardmill.operators.training import train_ensemble, training_set
from cardmill.sources.sinks import (
    OnlineTable,
    exists,
    write_batch_quarantine,
    write_current,
    write_lakehouse,
    write_report,
)
from cardmill.sources.tables import latest_partition
from cardmill.streaming.features import StreamTables, start_features

# The reasons a run reports.
SCHEDULED = "SCHEDULED_TIME_BASED_CRON"
DRIFT = "EVENT_DRIVEN_DATA_DRIFT_DETECTED"
BASELINE = "BASELINE_PIPELINE_VERIFICATION"


def audit(online: DataFrame, card_id: str, lake: DataFrame | None, quarantine: DataFrame | None) -> DataFrame:
    """O1: one row that says whether the stores hold what a run must leave in them."""
    spark = online.sparkSession

    def one(df: DataFrame | None, count) -> DataFrame:
        return spark.range(1).select(F.lit(None).cast("bigint").alias("n")) if df is None else df.agg(count.alias("n"))

    found = one(online, F.count_if(F.col("card_id") == card_id)).scalar()
    partition_rows = one(lake, F.count(F.lit(1))).scalar()
    isolated = one(quarantine, F.count(F.lit(1))).scalar()
    return spark.range(1).select(
        F.when(found > 0, "PASSED").otherwise("READY").alias("online_store"),
        F.when(partition_rows > 0, "PASSED").otherwise("FAILED").alias("lakehouse_partition"),
        F.when(isolated.isNull(), "READY")
        .otherwise(F.concat(F.lit("PASSED ("), isolated.cast("string"), F.lit(" isolated records)")))
        .alias("quarantine_store"),
    )


def retrain_decision(state: DataFrame) -> DataFrame:
    """O2: add ``should_retrain`` and ``trigger_reason`` to ``scheduled_run, force_retrain, dataset_drift``.

    A forced run gives the scheduled reason, and without any cause the baseline run retrains.
    """
    return state.withColumns(
        {
            "should_retrain": F.lit(True),
            "trigger_reason": F.when(F.col("scheduled_run") | F.col("force_retrain"), SCHEDULED)
            .when(F.coalesce("dataset_drift", F.lit(False)), DRIFT)
            .otherwise(BASELINE),
        }
    )


def _retried(step: Callable[[], dict], retries: int = 2, wait_seconds: float = 5.0) -> dict:
    for attempt in range(retries + 1):
        try:
            return step()
        except PySparkException:
            if attempt == retries:
                raise
            time.sleep(wait_seconds)
    raise AssertionError


class FlowTables:
    """Where a run keeps its tables."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.lake = f"{self.root}/lakehouse/batch_features"
        self.current = f"{self.root}/batch_features"
        self.quarantine = f"{self.root}/lakehouse/quarantine/batch"
        self.dataset = f"{self.root}/training_set"
        self.model = f"{self.root}/model"
        self.report = f"{self.root}/evaluation_report"
        self.stream = StreamTables(f"{self.root}/stream")
        schema = CARD_BATCH.select_schema()
        self.online_batch = OnlineTable(f"{self.root}/online_batch", schema, CARD_BATCH.entity, (CARD_BATCH.timestamp,))


def refresh_batch(
    transactions: DataFrame, tables: FlowTables, run_time: dt.datetime, on_fail: str = "quarantine", mode: str = "reference"
) -> dict:
    """Step 1: features, gate, lakehouse partition, current table and quarantine."""
    features = batch_features(transactions, F.lit(run_time).cast("timestamp"), mode)
    result = gate(features, BATCH_CHECKS, on_fail)
    try:
        write_lakehouse(result.clean, tables.lake, run_time)
        write_current(result.clean, tables.current)
        if result.quarantined_rows:
            write_batch_quarantine(result.quarantined, tables.quarantine, run_time.date())
    finally:
        result.release()
    return {"status": "SUCCESS", "is_valid": result.is_valid, "quarantined_rows": result.quarantined_rows}


def lake_drift(spark: SparkSession, tables: FlowTables) -> dict:
    """Step 5: the newest partition against the one before it."""
    if not exists(spark, tables.lake):
        return {"status": "SKIPPED", "reason": "no_lakehouse"}
    days = ("year", "month", "day")
    before, newest = (latest_partition(spark, tables.lake, back).drop(*days) for back in (1, 0))
    return drift_report(before, newest)


def run_flow(
    transactions: DataFrame,
    event_stream: DataFrame,
    tables: FlowTables,
    run_time: dt.datetime,
    run_number: int | None = None,
    audit_card: str = "11556",
    force_retrain: bool = False,
    scheduled_run: bool = False,
    trees: int = 100,
    depth: int = 6,
    second: str = "leafwise",
) -> dict:
    """O3: batch, stream, materialize, audit, drift, decide and train.

    ``transactions`` are typed raw rows, ``event_stream`` a stream of JSON ``value`` rows. A run
    without a number takes the one after the last that was stored. The batch step is tried three
    times; a failure of the drift or training step is reported and does not end the run.
    """
    spark = transactions.sparkSession
    report: dict = {"step1_batch_lakehouse": _retried(lambda: refresh_batch(transactions, tables, run_time))["status"]}

    start_features(event_stream, tables.stream).awaitTermination()
    report["step2_stream_dlq"] = "SUCCESS"

    start = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    current = spark.read.parquet(tables.current)
    if run_number is None:
        run_number = tables.online_batch.next_number(spark)
    tables.online_batch.upsert(materialize(current, CARD_BATCH, start, run_time), run_number)
    tables.online_batch.compact_if_due(spark, run_number)
    report["step3_materialize"] = "SUCCESS"

    quarantined = tables.stream.quarantine
    checked = audit(
        tables.stream.online.read(spark),
        audit_card,
        spark.read.parquet(tables.lake),
        quarantined.read(spark) if quarantined.numbers(spark) else None,
    )
    report["step4_verification_audit"] = checked.first().asDict()

    try:
        drift = lake_drift(spark, tables)
    except PySparkException as error:
        drift = {"status": "FAILED", "reason": str(error)[:500]}
    report["step5_drift_monitoring"] = drift["status"]
    report["dataset_drift_detected"] = bool(drift.get("dataset_drift", False))

    state = spark.range(1).select(
        F.lit(scheduled_run).alias("scheduled_run"),
        F.lit(force_retrain).alias("force_retrain"),
        F.lit(report["dataset_drift_detected"]).alias("dataset_drift"),
    )
    decision = retrain_decision(state).first()
    report["ct_trigger_reason"] = decision.trigger_reason

    try:
        write_current(training_set(transactions, current), tables.dataset)
        ensemble, evaluation = train_ensemble(spark.read.parquet(tables.dataset), trees, depth, second=second)
        ensemble.save(spark, tables.model)
        write_report(evaluation, tables.report)
        report["step6_model_training"] = "SUCCESS"
    except PySparkException as error:
        report["step6_model_training"] = "FAILED"
        report["training_error"] = str(error)[:500]
    return report
