"""Training set, the two learners, their blend, scoring and importance."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardmill.functions.columns import amount_ratio, columns_except, exceeds, or_default
from cardmill.operators.batch import BATCH_FEATURES, class_balance, first_per_key
from cardmill.operators.boosting import Growth, fit_boosted
from cardmill.operators.evaluation import (
    FALSE_POSITIVE_COST,
    best_thresholds,
    comparison,
    labelled,
    rounded_thresholds,
    threshold_curve,
)
from cardmill.operators.quality import names_of
from cardmill.operators.retrieval import CARD_BATCH, point_in_time_join, with_lookup_defaults
from cardmill.operators.sampling import HASH_BITS, hash_order, seeded_sample, stratified_split
from cardmill.operators.skew import join_per_key
from cardmill.operators.trees import CompiledEnsemble, TreeSet

AMOUNT = "TransactionAmt"
TRAINING_FEATURES = [*BATCH_FEATURES, AMOUNT, "amount_ratio_30d", "is_amount_gt_30d_max"]
ID_COLUMNS = ("card_id", "TransactionID")
TARGET = "is_fraud"

# Rows of a task in the passes of a fit, of which a hundred trees of depth six take some six hundred.
# Each pass has a task per partition, however the table is cut.
FIT_TASK_ROWS = 50_000

ALERT = "ALERT: FRAUD DETECTED"
APPROVED = "APPROVED"


def training_set(
    labels: DataFrame,
    batch_features: DataFrame,
    point_in_time: bool = False,
    entity_time: str = "event_time",
) -> DataFrame:
    """M1: labelled transactions with the features of their card.

    By default every transaction of a card gets the card's one feature row (J2), whatever
    its time. ``point_in_time`` instead takes the newest feature row at or before the
    transaction (J3), for a history of feature rows. One row is kept per transaction id.
    """
    rows = labels.withColumn("card_id", F.col("card_id").cast("string"))
    if point_in_time:
        joined = point_in_time_join(
            rows,
            batch_features,
            BATCH_FEATURES,
            "card_id",
            entity_time,
            CARD_BATCH.timestamp,
            CARD_BATCH.ttl_seconds,
            matched="has_features",
        ).where("has_features")
    else:
        joined = join_per_key(rows, batch_features.select("card_id", *BATCH_FEATURES), "card_id", "inner")
    amount = F.col("amount")
    derived = joined.withColumns(
        {
            "TransactionID": F.col("transaction_id"),
            AMOUNT: amount,
            "amount_ratio_30d": amount_ratio(amount, F.col("avg_amount_30d")),
            "is_amount_gt_30d_max": exceeds(amount, F.col("max_amount_30d")),
        }
    )
    filled = derived.select(
        *ID_COLUMNS, TARGET, *[or_default(F.col(name), 0.0).alias(name) for name in TRAINING_FEATURES]
    )
    return first_per_key(filled, "TransactionID", "card_id", AMOUNT, TARGET)


@dataclass
class FraudEnsemble:
    """M3: two fitted members, their weights and the decision threshold.

    The second one is a forest or the trees of the leaf-wise booster.
    """

    boosted: GBTClassificationModel
    second: RandomForestClassificationModel | TreeSet
    feature_names: list[str]
    boosted_weight: float = 0.5
    second_weight: float = 0.5
    threshold: float = 0.5

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``boosted_score``, ``second_score`` and the blended ``fraud_score``."""
        assembled = VectorAssembler(inputCols=self.feature_names, outputCol="features").transform(df)
        both = self.boosted.transform(assembled)

        def positive(column: str) -> Column:
            return vector_to_array(F.col(column))[1]

        if isinstance(self.second, TreeSet):
            second = self.second.score()
        else:
            both, second = self.second.transform(both), positive("p_forest")
        return blended(
            both.withColumns({"boosted_score": positive("p_boosted"), "second_score": second}),
            {"boosted_score": self.boosted_weight, "second_score": self.second_weight},
        ).select(*df.columns, "boosted_score", "second_score", "fraud_score")

    def predict(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """M4: add the label at the tuned threshold, or at another one."""
        cut = self.threshold if threshold is None else threshold
        return self.score(df).withColumn("prediction", labelled(F.col("fraud_score"), cut))

    def compiled(self, spark: SparkSession, path: str) -> CompiledEnsemble:
        """The same scores as column expressions; the members' nodes are read from files in ``path``."""
        boosted = TreeSet.of(spark, self.boosted, self.feature_names, f"{path}/boosted")
        second = self.second
        if not isinstance(second, TreeSet):
            second = TreeSet.of(spark, second, self.feature_names, f"{path}/forest")
        return CompiledEnsemble(boosted, second, self.boosted_weight, self.second_weight, self.threshold)

    def save(self, spark: SparkSession, path: str) -> None:
        self.boosted.write().overwrite().save(f"{path}/boosted")
        if isinstance(self.second, TreeSet):
            self.second.write(spark, f"{path}/{self.second_kind}")
        else:
            self.second.write().overwrite().save(f"{path}/{self.second_kind}")
        settings = {
            "feature_names": self.feature_names,
            "boosted_weight": self.boosted_weight,
            "second_weight": self.second_weight,
            "threshold": self.threshold,
            "second_kind": self.second_kind,
        }
        spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/settings"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FraudEnsemble:
        settings = json.loads(spark.read.text(f"{path}/settings").first().value)
        if settings.pop("second_kind") == "leafwise":
            second = TreeSet.read(spark, f"{path}/leafwise", settings["feature_names"], "sigmoid")
        else:
            second = RandomForestClassificationModel.load(f"{path}/forest")
        return cls(GBTClassificationModel.load(f"{path}/boosted"), second, **settings)

    @property
    def second_kind(self) -> str:
        return "leafwise" if isinstance(self.second, TreeSet) else "forest"


def blended(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """M3: weighted sum of member scores."""
    total = None
    for name, weight in weights.items():
        part = F.lit(float(weight)) * F.col(name)
        total = part if total is None else total + part
    return df.withColumn("fraud_score", total)


def fit_ensemble(
    train: DataFrame,
    features: list[str],
    trees: int = 100,
    depth: int = 6,
    rate: float = 0.05,
    seed: int = 42,
    second: str = "leafwise",
) -> FraudEnsemble:
    """M2: boosted trees and a ``second`` learner, positives weighted by the class balance (A2).

    ``leafwise`` is the second-order booster of at most 31 leaves a tree, ``forest`` a random forest.
    """
    if second not in ("leafwise", "forest"):
        raise ValueError(f"no learner {second!r}")
    balance = class_balance(train, TARGET).first()
    weight = balance.positive_weight
    tasks = max(1, math.ceil((balance.negatives + balance.positives) / FIT_TASK_ROWS))
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(
        train.withColumn("row_weight", F.when(F.col(TARGET) == 1, float(weight)).otherwise(1.0))
    )
    rows = rows.select("features", F.col(TARGET).cast("double").alias("label"), "row_weight").repartition(tasks)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    common = {"maxDepth": depth, "seed": seed, "weightCol": "row_weight"}
    learners = {"boosted": GBTClassifier(maxIter=trees, stepSize=rate, **common)}
    if second == "forest":
        learners["forest"] = RandomForestClassifier(numTrees=trees, **common)
    fitted = {
        name: learner.setProbabilityCol(f"p_{name}")
        .setRawPredictionCol(f"raw_{name}")
        .setPredictionCol(f"label_{name}")
        .fit(rows)
        for name, learner in learners.items()
    }
    rows.unpersist()
    if second == "leafwise":
        positive = F.when(F.col(TARGET) == 1, float(weight)).otherwise(1.0)
        fitted[second] = fit_boosted(train, features, F.col(TARGET), positive, Growth(trees, depth, rate=rate))
    return FraudEnsemble(fitted["boosted"], fitted[second], list(features))


def member_scores(scored: DataFrame, second: str = "leafwise") -> DataFrame:
    """Long table ``model, is_fraud, score, amount`` of the members and the blend."""
    models = {
        "boosted": "boosted_score",
        second: "second_score",
        "ensemble_default_05": "fraud_score",
        "ensemble_optimal": "fraud_score",
    }
    each = [F.struct(F.lit(m).alias("model"), F.col(c).alias("score")) for m, c in models.items()]
    return scored.select(TARGET, F.col(AMOUNT).alias("amount"), F.inline(F.array(*each)))


def train_ensemble(
    dataset: DataFrame,
    trees: int = 100,
    depth: int = 6,
    rate: float = 0.05,
    false_positive_cost: float = FALSE_POSITIVE_COST,
    fit_rows: int | None = None,
    second: str = "leafwise",
) -> tuple[FraudEnsemble, DataFrame]:
    """Split, fit, blend, tune the threshold and report; the report is one nested row.

    The members are fitted on all rows of the training side. A caller that names ``fit_rows`` has them
    fitted on about so many, picked by a hash of the id; no registered query does.
    """
    features = columns_except(dataset, (*ID_COLUMNS, TARGET))
    split = stratified_split(dataset, "TransactionID", TARGET).persist(StorageLevel.MEMORY_AND_DISK)
    train, validation = split.where(~F.col("is_test")), split.where("is_test")
    if fit_rows is not None and (n_train := train.count()) > fit_rows:
        # The split has taken the smallest hashes of this seed; another one is independent of it.
        bound = int(2**HASH_BITS * fit_rows / n_train)
        train = train.where(hash_order("TransactionID", 43) < bound)
    ensemble = fit_ensemble(train, features, trees, depth, rate, second=second)

    members = member_scores(ensemble.score(validation), second).persist(StorageLevel.MEMORY_AND_DISK)
    blend = members.where(F.col("model") == "ensemble_optimal")
    tuning = rounded_thresholds(best_thresholds(threshold_curve(blend, false_positive_cost=false_positive_cost)))
    tuned = tuning.drop("model").first()
    ensemble.threshold = tuned.optimal_threshold
    table = comparison(members, {"ensemble_optimal": ensemble.threshold}).collect()  # four rows
    sizes = split.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_test")).alias("train"), F.count_if("is_test").alias("val")
    ).first()
    metrics = {
        r.model: {
            "threshold": round(r.threshold, 4),
            "pr_auc": None if r.pr_auc is None else round(r.pr_auc, 4),
            "roc_auc": None if r.roc_auc is None else round(r.roc_auc, 4),
            "f1_score": round(r.f1_score, 4),
            "confusion_matrix": [[r.tn, r.fp], [r.fn, r.tp]],
        }
        for r in table
    }
    report = {
        "dataset_size": sizes.n,
        "train_size": sizes.train,
        "val_size": sizes.val,
        "feature_count": len(features),
        "feature_names": features,
        "optimal_threshold": ensemble.threshold,
        "threshold_tuning": tuned.asDict(),
        "metrics": metrics | {"ensemble": metrics["ensemble_optimal"]},
    }
    members.unpersist()
    split.unpersist()
    return ensemble, report_row(dataset.sparkSession, report)


def report_row(spark: SparkSession, report: dict) -> DataFrame:
    """A report as one nested row, stamped with the time."""
    text = json.dumps(report)
    schema = spark.range(1).select(F.schema_of_json(F.lit(text))).first()[0]
    return (
        spark.createDataFrame([(text,)], "value string")
        .select(F.from_json("value", schema).alias("r"))
        .select(F.current_timestamp().alias("timestamp"), "r.*")
    )


def score_requests(
    requests: DataFrame, online_batch: DataFrame, ensemble: FraudEnsemble | CompiledEnsemble
) -> DataFrame:
    """M5: look up, derive, score and decide for every valid request.

    ``requests`` has ``card_id`` and ``current_amount``; other columns are kept. Those that
    ``request_errors`` names are not scored. A stream of requests is scored batch by batch, see
    ``cardmill.streaming.scoring``.
    """
    valid = requests.where(F.size(request_errors()) == 0)
    scored = ensemble.predict(request_features(valid, online_batch).na.fill(0.0, ensemble.feature_names))
    return decisions(scored, requests.columns, ensemble.threshold)


def request_errors() -> Column:
    """What is wrong with a request: no card, or an amount that is no number above 0."""
    amount = F.nanvl(F.col("current_amount").cast("double"), F.lit(0.0))
    failures = [
        (F.col("card_id").isNull() | (F.length(F.trim(F.col("card_id").cast("string"))) == 0), "card_id:required"),
        (~F.coalesce(amount > 0.0, F.lit(False)), "current_amount:positive"),
    ]
    return names_of(failures)


def request_features(requests: DataFrame, online_batch: DataFrame) -> DataFrame:
    """The member inputs of every request: stored features or defaults, and the derived ones."""
    amount = F.col("current_amount").cast("double")
    looked_up = with_lookup_defaults(requests.withColumn("card_id", F.col("card_id").cast("string")), online_batch)
    return looked_up.withColumns(
        {
            AMOUNT: amount,
            "amount_ratio_30d": amount_ratio(amount, F.col("avg_amount_30d")),
            "is_amount_gt_30d_max": exceeds(amount, F.col("max_amount_30d")),
        }
    )


def decisions(scored: DataFrame, kept: list[str], threshold: float) -> DataFrame:
    """The answer to every scored request; needs the member scores, ``fraud_score``, ``prediction``."""
    used = F.map_from_arrays(
        F.array(*[F.lit(n) for n in TRAINING_FEATURES]),
        F.array(*[F.round(F.col(n).cast("double"), 2) for n in TRAINING_FEATURES]),
    )
    return scored.select(
        *kept,
        F.col("prediction").alias("is_fraud"),
        F.round("fraud_score", 4).alias("fraud_score"),
        F.when(F.col("prediction") == 1, ALERT).otherwise(APPROVED).alias("decision"),
        F.lit(round(threshold, 4)).alias("decision_threshold"),
        F.round("boosted_score", 4).alias("boosted_score"),
        F.round("second_score", 4).alias("second_score"),
        used.alias("features_used"),
    )


def permuted_inputs(
    dataset: DataFrame, names: list[str], key: str = "TransactionID", sample_size: int = 2000, seed: int = 42
) -> DataFrame:
    """The sample as it is (``permuted`` empty) and once per feature with that one permuted.

    The sample is put in a hash order and each row takes the feature's value of the next row.
    """
    sample = seeded_sample(dataset.select(key, *names), key, sample_size, seed)
    place = Window.partitionBy(F.lit(0)).orderBy(hash_order(key, seed + 1), key)  # at most sample_size rows
    partners = F.struct(*names)
    paired = sample.withColumn(
        "partner", F.coalesce(F.lead(partners).over(place), F.first(partners).over(place))
    )
    copies = paired.withColumn("permuted", F.explode(F.array(F.lit(""), *[F.lit(n) for n in names])))
    return copies.withColumns(
        {n: F.when(F.col("permuted") == n, F.col(f"partner.{n}")).otherwise(F.col(n)) for n in names}
    ).drop("partner")


def feature_importance(
    dataset: DataFrame, ensemble: FraudEnsemble, key: str = "TransactionID", sample_size: int = 2000, seed: int = 42
) -> DataFrame:
    """M6: features ranked by how far the blended score moves when their values are permuted.

    One copy of the sample per feature is scored in a single pass.
    """
    names = ensemble.feature_names
    swapped = permuted_inputs(dataset, names, key, sample_size, seed)
    scored = ensemble.score(swapped).select(key, "permuted", "fraud_score")
    original = F.max(F.when(F.col("permuted") == "", F.col("fraud_score")))
    moved = scored.groupBy(key).agg(
        original.alias("original"),
        *[F.max(F.when(F.col("permuted") == n, F.col("fraud_score"))).alias(f"with_{n}") for n in names],
    )
    shifts = F.array(
        *[F.struct(F.lit(n).alias("feature"), F.abs(F.col(f"with_{n}") - F.col("original")).alias("shift")) for n in names]
    )
    return (
        moved.select(F.inline(shifts))
        .groupBy("feature")
        .agg(F.avg("shift").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
