"""Scoring a stream of requests (M5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardmill.operators.training import FraudEnsemble, score_requests
from cardmill.sources.sinks import BatchParts

SCORE_FIELDS = [
    T.StructField("is_fraud", T.IntegerType()),
    T.StructField("fraud_score", T.DoubleType()),
    T.StructField("decision", T.StringType()),
    T.StructField("decision_threshold", T.DoubleType()),
    T.StructField("boosted_score", T.DoubleType()),
    T.StructField("second_score", T.DoubleType()),
    T.StructField("features_used", T.MapType(T.StringType(), T.DoubleType())),
]


def _scores(request_schema: T.StructType, path: str) -> BatchParts:
    return BatchParts(f"{path}/scores", T.StructType([*request_schema.fields, *SCORE_FIELDS]))


def scored_table(spark: SparkSession, request_schema: T.StructType, path: str) -> DataFrame:
    return _scores(request_schema, path).read(spark)


def start_scoring(
    requests: DataFrame,
    online_batch: Callable[[SparkSession], DataFrame],
    ensemble: FraudEnsemble,
    path: str,
    available_now: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Score each micro-batch with the batch operator and write it under its number.

    ``online_batch`` is called per batch, so newly stored features are used at once.
    """
    table = _scores(requests.schema, path)

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.conf.set("spark.sql.adaptive.enabled", "true")  # off in a stream's own session
        table.write(score_requests(batch, online_batch(spark), ensemble), batch_id)

    writer = requests.writeStream.foreachBatch(score).option("checkpointLocation", f"{path}/checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
