"""Threshold tuning and evaluation of scores.

Input tables have one row per scored transaction: a label 0/1, a score and, for costs, an
amount. ``model`` names the scores when several are evaluated in one pass.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardmill.functions.columns import MONEY, money
from cardmill.operators.running import bucket_count, quantile_splits, running_totals

# Fixed values of the sweep: 90 thresholds, evenly spaced from 0.01 to 0.90.
THRESHOLDS = [0.01 + i * (0.89 / 89) for i in range(90)]
FALSE_POSITIVE_COST = 2.0
DEFAULT_AMOUNT = 100.0
TINY = 1e-9
# A missing or NaN score counts as lower than any other, in every metric.
NO_SCORE = -1.0e300


def score_value(score: Column) -> Column:
    """The score as a number; see ``NO_SCORE``."""
    none = F.lit(NO_SCORE)
    return F.coalesce(F.nanvl(score.cast("double"), none), none)


def labelled(score: Column, threshold) -> Column:
    """M4."""
    return F.when(score >= threshold, 1).otherwise(0)


def with_model(df: DataFrame, name: str = "model") -> DataFrame:
    return df if "model" in df.columns else df.withColumn("model", F.lit(name))


def threshold_curve(
    scored: DataFrame,
    label: str = "is_fraud",
    score: str = "score",
    amount: str | None = "amount",
    false_positive_cost: float = FALSE_POSITIVE_COST,
) -> DataFrame:
    """Cost, precision, recall, F1 and F2 at each of the 90 thresholds, per model.

    A score is only ever compared with the thresholds, so the rows are first combined to 91
    classes ("how many thresholds does the score reach"); the sweep itself runs over those.
    """
    edges = [float("-inf"), *THRESHOLDS, float("inf")]
    value = score_value(F.col(score))
    paid = (F.lit(DEFAULT_AMOUNT) if amount is None else F.col(amount)).cast("double")
    positive = F.col(label) == 1
    rows = with_model(scored).select("model", positive.alias("positive"), paid.alias("paid"), value.alias("value"))
    loss = money(F.col("paid"))
    classes = (
        Bucketizer(splits=edges, inputCol="value", outputCol="reached")
        .transform(rows)
        .groupBy("model", F.col("reached").cast("int").alias("reached"))
        .agg(
            F.count_if("positive").alias("pos"),
            F.count_if(~F.col("positive")).alias("neg"),
            F.sum(F.when(F.col("positive"), loss)).alias("pos_loss"),
            F.sum(F.when(F.col("positive") & loss.isNull(), F.col("paid"))).alias("pos_rest"),
        )
    )
    # Threshold i (1-based) flags the classes >= i. Every model gets all 91 classes; its own,
    # at most 91 rows, are gathered in a map so that the table is read once.
    entry = F.struct("reached", F.struct("pos", "neg", "pos_loss", "pos_rest"))
    gathered = classes.groupBy("model").agg(F.map_from_entries(F.collect_list(entry)).alias("known"))
    known = F.try_element_at("known", F.col("reached"))
    filled = gathered.withColumn("reached", F.explode(F.sequence(F.lit(0), F.lit(90)))).select(
        "model",
        "reached",
        F.coalesce(known["pos"], F.lit(0)).alias("pos"),
        F.coalesce(known["neg"], F.lit(0)).alias("neg"),
        F.coalesce(known["pos_loss"], F.lit(0).cast(MONEY)).alias("pos_loss"),
        F.coalesce(known["pos_rest"], F.lit(0.0)).alias("pos_rest"),
    )
    at_or_above = Window.partitionBy("model").orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.partitionBy("model").orderBy("reached").rowsBetween(Window.unboundedPreceding, -1)
    counted = filled.select(
        "model",
        "reached",
        F.sum("pos").over(at_or_above).alias("tp"),
        F.sum("neg").over(at_or_above).alias("fp"),
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"),
        F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn"),
        (
            F.coalesce(F.sum("pos_loss").over(below).cast("double"), F.lit(0.0))
            + F.coalesce(F.sum("pos_rest").over(below), F.lit(0.0))
        ).alias("fn_cost"),
    ).where(F.col("reached") > 0)
    thresholds = F.array(*[F.lit(t) for t in THRESHOLDS])
    precision = F.col("tp") / (F.col("tp") + F.col("fp") + TINY)
    recall = F.col("tp") / (F.col("tp") + F.col("fn") + TINY)
    rated = counted.withColumns(
        {
            "threshold_index": F.col("reached") - 1,
            "threshold": F.element_at(thresholds, F.col("reached")),
            "fp_cost": F.col("fp") * F.lit(float(false_positive_cost)),
            "precision": precision,
            "recall": recall,
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rated.select(
        "model",
        "threshold_index",
        "threshold",
        "tp",
        "fp",
        "fn",
        "tn",
        "fn_cost",
        "fp_cost",
        (F.col("fn_cost") + F.col("fp_cost")).alias("total_cost"),
        "precision",
        "recall",
        ((F.lit(2.0) * p * r) / (p + r + TINY)).alias("f1"),
        ((F.lit(5.0) * p * r) / (F.lit(4.0) * p + r + TINY)).alias("f2"),
    )


def best_thresholds(curve: DataFrame) -> DataFrame:
    """M7-M9: cost-, F1- and F2-optimal thresholds per model, with the savings against 0.5.

    Among equal values the smallest threshold wins.
    """
    index = F.col("threshold_index")

    def best_by(value: Column) -> Column:
        """First threshold with the largest value."""
        return F.max_by("threshold", F.struct(value, -index))

    at_half = F.abs(F.col("threshold") - 0.5) < 0.005
    best = curve.groupBy("model").agg(
        F.min_by("threshold", F.struct(F.col("total_cost"), index)).alias("optimal_threshold"),
        F.min("total_cost").alias("min_cost"),
        F.max(F.when(at_half, F.col("total_cost"))).alias("half_cost"),
        best_by(F.col("f1")).alias("f1_optimal_threshold"),
        best_by(F.col("f2")).alias("f2_optimal_threshold"),
        F.max("f1").alias("best_f1_score"),
        F.max("f2").alias("best_f2_score"),
    )
    half = F.when(F.col("half_cost") == 0.0, F.col("min_cost")).otherwise(F.col("half_cost"))
    saved = F.greatest(F.lit(0.0), F.col("cost_at_05") - F.col("min_cost"))
    return best.withColumn("cost_at_05", half).select(
        "model",
        "optimal_threshold",
        "min_cost",
        "cost_at_05",
        saved.alias("savings_amount"),
        (saved / (F.col("cost_at_05") + TINY) * 100.0).alias("savings_pct"),
        "f1_optimal_threshold",
        "f2_optimal_threshold",
        "best_f1_score",
        "best_f2_score",
    )


def rounded_thresholds(best: DataFrame) -> DataFrame:
    """The tuning result with the report's decimal places."""
    places = {name: 2 for name in ("min_cost", "cost_at_05", "savings_amount", "savings_pct")}
    return best.select("model", *[F.round(c, places.get(c, 4)).alias(c) for c in best.columns if c != "model"])


def score_curve(scored: DataFrame, label: str = "is_fraud", score: str = "score") -> DataFrame:
    """Cumulative counts per distinct score from the highest down, per model."""
    rows = with_model(scored).select(
        "model",
        (-score_value(F.col(score))).alias("descending"),
        (F.col(label) == 1).cast("bigint").alias("pos"),
        (F.col(label) != 1).cast("bigint").alias("neg"),
    )
    splits = quantile_splits(rows, "descending", bucket_count(rows))
    distinct = rows.groupBy("model", "descending").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    running = running_totals(distinct, "model", "descending", ["pos", "neg"], splits)
    return running.select(
        "model",
        (-F.col("descending")).alias("threshold"),
        "pos",
        "neg",
        F.col("run_pos").alias("tp"),
        F.col("run_neg").alias("fp"),
        F.col("total_pos").alias("positives"),
        F.col("total_neg").alias("negatives"),
    )


def curve_points(scored: DataFrame, label: str = "is_fraud", score: str = "score") -> DataFrame:
    """ROC and precision-recall points at every distinct score, and where both curves start.

    The start, above the highest score, has no threshold: rates and recall 0, precision 1.
    """
    point = F.struct(
        F.col("threshold"),
        F.try_divide("fp", "negatives").alias("fpr"),
        F.try_divide("tp", "positives").alias("tpr"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "positives").alias("recall"),
    )
    zero, one = F.lit(0.0), F.lit(1.0)
    start = F.struct(
        F.lit(None).cast("double").alias("threshold"), zero.alias("fpr"), zero.alias("tpr"), one.alias("precision"), zero.alias("recall")
    )
    is_highest = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
    points = F.when(is_highest, F.array(start, point)).otherwise(F.array(point))
    return score_curve(scored, label, score).select("model", F.inline(points))


def areas(scored: DataFrame, label: str = "is_fraud", score: str = "score") -> DataFrame:
    """PR-AUC and ROC-AUC per model by the trapezoid rule, null when one class is absent.

    The precision-recall curve starts at recall 0 with precision 1. A step's predecessor is
    the cumulative count less the step's own rows, so no neighbouring row is needed. The ROC
    sum stays in integers until the last division.
    """
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    seen_before = tp + fp - pos - neg
    precision = tp / (tp + fp)
    previous = F.when(seen_before > 0, F.try_divide(tp - pos, seen_before)).otherwise(1.0)
    roc_step = neg.cast("decimal(18,0)") * (2 * tp - pos).cast("decimal(18,0)")
    return score_curve(scored, label, score).groupBy("model").agg(
        F.sum(F.try_divide(pos, F.col("positives")) * (precision + previous) / 2.0).alias("pr_auc"),
        F.try_divide(
            F.sum(roc_step).cast("double"),
            F.lit(2.0) * F.max("positives").cast("double") * F.max("negatives").cast("double"),
        ).alias("roc_auc"),
    )


def confusion(scored: DataFrame, threshold: float = 0.5, label: str = "is_fraud", score: str = "score") -> DataFrame:
    """Confusion counts and F1 (0 when undefined) per model."""
    flagged = score_value(F.col(score)) >= threshold
    positive = F.col(label) == 1
    counts = with_model(scored).groupBy("model").agg(
        F.count_if(~positive & ~flagged).alias("tn"),
        F.count_if(~positive & flagged).alias("fp"),
        F.count_if(positive & ~flagged).alias("fn"),
        F.count_if(positive & flagged).alias("tp"),
    )
    return counts.select(
        "model",
        F.lit(float(threshold)).alias("threshold"),
        "tn",
        "fp",
        "fn",
        "tp",
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1_score"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def class_report(
    scored: DataFrame, threshold: float = 0.5, label: str = "is_fraud", score: str = "score"
) -> DataFrame:
    """Precision, recall, F1 and support of each class, with macro and weighted means."""
    counts = confusion(scored, threshold, label, score)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def one(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class_name"),
            _ratio(hit, hit + wrong).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _ratio(2 * hit, 2 * hit + wrong + missed).alias("f1_score"),
            (hit + missed).alias("support"),
        )

    both = counts.select(
        "model", one("Legitimate", tn, fn, fp).alias("a"), one("Fraud", tp, fp, fn).alias("b")
    )
    support = F.col("a.support") + F.col("b.support")
    measures = ("precision", "recall", "f1_score")
    macro = [((F.col(f"a.{m}") + F.col(f"b.{m}")) / 2.0).alias(m) for m in measures]
    weighted = [
        _ratio(F.col(f"a.{m}") * F.col("a.support") + F.col(f"b.{m}") * F.col("b.support"), support).alias(m)
        for m in measures
    ]
    correct = _ratio(
        F.col("a.recall") * F.col("a.support") + F.col("b.recall") * F.col("b.support"), support
    )
    rows = F.array(
        F.col("a"),
        F.col("b"),
        F.struct(F.lit("accuracy").alias("class_name"), *[correct.alias(m) for m in measures], support.alias("support")),
        F.struct(F.lit("macro avg").alias("class_name"), *macro, support.alias("support")),
        F.struct(F.lit("weighted avg").alias("class_name"), *weighted, support.alias("support")),
    )
    return both.select("model", F.inline(rows))


def comparison(scored: DataFrame, thresholds: dict[str, float], label: str = "is_fraud", score: str = "score") -> DataFrame:
    """Areas, F1 and confusion counts of every model at its own threshold, in one table."""
    cut = F.lit(0.5)
    for model, threshold in thresholds.items():
        cut = F.when(F.col("model") == model, F.lit(float(threshold))).otherwise(cut)
    flagged = scored.withColumn("flag", F.when(score_value(F.col(score)) >= cut, 1.0).otherwise(0.0))
    counts = confusion(flagged, 0.5, label, "flag").withColumn("threshold", cut)
    return areas(scored, label, score).join(counts, "model")
