"""Evaluation of a score against a 0/1 label, on tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import between_bounds, ratio_or
from tidemark.params import Params
from tidemark.workspace import Workspace
from tidemark.operators.ranking import running_totals


def predict(scored: DataFrame, threshold: Column | float, score: str = "churn_probability") -> DataFrame:
    return scored.withColumn("churn_prediction", (F.col(score) >= threshold).cast("int"))


def confusion_matrix(
    predicted: DataFrame, label: str = "churn", prediction: str = "churn_prediction"
) -> DataFrame:
    """Always four rows: actual × predicted, absent combinations as 0."""
    cells = [(actual, guess) for actual in (0, 1) for guess in (0, 1)]
    wide = predicted.agg(
        *[
            F.struct(
                F.lit(actual).alias("actual"),
                F.lit(guess).alias("predicted"),
                F.count_if((F.col(label) == actual) & (F.col(prediction) == guess)).alias("n"),
            ).alias(f"cell_{actual}{guess}")
            for actual, guess in cells
        ]
    )
    return wide.select(F.inline(F.array(*wide.columns)))


def matrix_array(matrix: DataFrame) -> DataFrame:
    """The four cells as one nested array [[tn, fp], [fn, tp]]."""

    def cell(actual: int, guess: int) -> Column:
        at = (F.col("actual") == actual) & (F.col("predicted") == guess)
        return F.max(F.when(at, F.col("n")))

    rows = [F.array(cell(actual, 0), cell(actual, 1)) for actual in (0, 1)]
    return matrix.agg(F.array(*rows).alias("matrix"))


def classification_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted mean."""

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("bigint"))

    actual, predicted = F.col("actual"), F.col("predicted")
    sums = matrix.agg(
        *[total((actual == c) & (predicted == c)).alias(f"hit_{c}") for c in (0, 1)],
        *[total(predicted == c).alias(f"predicted_{c}") for c in (0, 1)],
        *[total(actual == c).alias(f"actual_{c}") for c in (0, 1)],
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n"),
    )
    rates = sums
    for c in (0, 1):
        rates = rates.withColumns(
            {
                f"precision_{c}": ratio_or(F.col(f"hit_{c}"), F.col(f"predicted_{c}")),
                f"recall_{c}": ratio_or(F.col(f"hit_{c}"), F.col(f"actual_{c}")),
                f"f1_{c}": ratio_or(
                    F.col(f"hit_{c}") * 2, F.col(f"predicted_{c}") + F.col(f"actual_{c}")
                ),
            }
        )

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    def macro(measure: str) -> Column:
        return (F.col(f"{measure}_0") + F.col(f"{measure}_1")) / 2

    def weighted(measure: str) -> Column:
        return ratio_or(
            F.col(f"{measure}_0") * F.col("actual_0") + F.col(f"{measure}_1") * F.col("actual_1"),
            F.col("n"),
        )

    accuracy = ratio_or(F.col("hit_0") + F.col("hit_1"), F.col("n"))
    measures = ("precision", "recall", "f1")
    lines = [
        line(str(c), *[F.col(f"{m}_{c}") for m in measures], F.col(f"actual_{c}")) for c in (0, 1)
    ]
    lines.append(line("accuracy", accuracy, accuracy, accuracy, F.col("n")))
    lines.append(line("macro avg", *[macro(m) for m in measures], F.col("n")))
    lines.append(line("weighted avg", *[weighted(m) for m in measures], F.col("n")))
    return rates.select(F.inline(F.array(*lines)))


def score_totals(
    scored: DataFrame, workspace: Workspace, score: str = "churn_probability", label: str = "churn"
) -> DataFrame:
    """Positives and negatives per distinct score, with their running totals.

    Ties are merged by the map-side aggregate first, so a score shared by a third
    of all customers becomes one row.
    """
    counts = scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(counts, "score", ["pos", "neg"], workspace)


def roc_auc(totals: DataFrame) -> DataFrame:
    """Rank-sum AUC, ties counted half; null unless both classes occur.

    Twice the number of ordered pairs is summed as an exact decimal.
    """

    def exact(count: Column) -> Column:
        return count.cast("decimal(18,0)")

    pairs = F.sum(exact(F.col("pos")) * exact(F.col("before_neg") * 2 + F.col("neg")))
    positives, negatives = F.sum("pos"), F.sum("neg")
    return totals.agg(
        F.coalesce(positives, F.lit(0).cast("bigint")).alias("positives"),
        F.coalesce(negatives, F.lit(0).cast("bigint")).alias("negatives"),
        F.try_divide(
            pairs.cast("double") / 2, positives.cast("double") * negatives.cast("double")
        ).alias("auc"),
    )


def pr_curve(totals: DataFrame) -> DataFrame:
    """Precision and recall of "score >= threshold" for every distinct score.

    Without any positive label recall is 1 throughout.
    """
    hits = F.col("total_pos") - F.col("before_pos")
    false_alarms = F.col("total_neg") - F.col("before_neg")
    return totals.select(
        F.col("score").alias("threshold"),
        hits.alias("true_positives"),
        false_alarms.alias("false_positives"),
        ratio_or(hits, hits + false_alarms).alias("precision"),
        ratio_or(hits, F.col("total_pos"), 1.0).alias("recall"),
    )


def operating_threshold(curve: DataFrame, params: Params) -> DataFrame:
    """The largest threshold that keeps the target recall, then clamped.

    The clamp may raise the threshold and break the promise, so the precision and
    recall that hold after it are reported too. They belong to the smallest
    distinct score that is not below the clamped threshold.
    """
    chosen = curve.agg(
        F.max(F.when(F.col("recall") >= params.target_recall, F.col("threshold"))).alias("raw_threshold")
    )
    clamped = chosen.select(
        "raw_threshold",
        between_bounds(
            F.col("raw_threshold"), params.threshold_floor, params.threshold_ceiling
        ).alias("threshold"),
    )
    both = clamped.select(F.struct("raw_threshold", "threshold")).scalar()
    at_or_above = F.col("threshold") >= F.col("chosen.threshold")
    nearest = F.min(F.when(at_or_above, F.struct("threshold", "precision", "recall")))
    found = curve.withColumn("chosen", both).agg(nearest.alias("at"))
    return found.withColumn("chosen", both).select(
        "chosen.raw_threshold",
        "chosen.threshold",
        F.coalesce("at.precision", F.lit(0.0)).alias("precision"),
        F.coalesce("at.recall", F.lit(0.0)).alias("recall"),
    )


def threshold_sweep(scored: DataFrame, median_clv: Column, params: Params) -> DataFrame:
    """Every slider position at once: sizes, CLV at risk, live precision and recall.

    Each customer is counted once, in the cell of the highest threshold its score
    reaches; the cells (a row per threshold) are then added up from the top. No
    customer is multiplied by the number of thresholds. Precision and recall cover
    the mature customers, training rows included.
    """
    score = F.col("churn_probability")
    step = F.floor(score * 100)
    reached = (
        F.when(score >= (step + 1) / F.lit(100.0), step + 1)
        .when(score < step / F.lit(100.0), step - 1)
        .otherwise(step)
    )
    low, high = params.sweep_from_pct, params.sweep_to_pct
    # Without a score the customer is below every threshold; least and greatest would skip the null.
    cell = F.greatest(F.least(F.coalesce(reached, F.lit(low - 1)), F.lit(high)), F.lit(low - 1))
    high_value = F.col("high_value")
    cells = scored.withColumn("high_value", F.col("clv") >= median_clv).groupBy(cell.cast("bigint").alias("pct")).agg(
        F.count_if(high_value).alias("high_clv"),
        F.count_if(~high_value).alias("low_clv"),
        F.sum("clv").alias("clv"),
        F.count_if(F.col("mature") & (F.col("churn") == 1)).alias("pos"),
        F.count_if(F.col("mature") & (F.col("churn") == 0)).alias("neg"),
    )
    grid = scored.sparkSession.range(low - 1, high + 1).select(F.col("id").alias("pct"))
    counted = ("high_clv", "low_clv", "clv", "pos", "neg")
    full = grid.join(F.broadcast(cells), "pct", "left").na.fill(0, list(counted))
    order = Window.orderBy(F.desc("pct"))
    above = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = full.select(
        "pct",
        *[F.sum(c).over(above).alias(c) for c in counted],
        *[F.sum(c).over(everything).alias(f"all_{c}") for c in counted],
    )
    return (
        summed.filter(F.col("pct") >= low)
        .select(
            (F.col("pct") / F.lit(100.0)).alias("threshold"),
            F.col("high_clv").alias("win_back"),
            (F.col("all_high_clv") - F.col("high_clv")).alias("reward"),
            F.col("low_clv").alias("monitor"),
            (F.col("all_low_clv") - F.col("low_clv")).alias("no_action"),
            F.col("clv").alias("clv_at_risk"),
            ratio_or(F.col("pos"), F.col("pos") + F.col("neg")).alias("precision"),
            ratio_or(F.col("pos"), F.col("all_pos")).alias("recall"),
        )
        .orderBy("threshold")
    )


def live_metrics(scored: DataFrame, threshold: Column | float) -> DataFrame:
    """Precision and recall of one threshold over the mature customers, 0 if undefined.

    The row "mature" covers all of them, training customers included; the other
    rows show each split on its own.
    """
    flagged = F.col("churn_probability") >= threshold
    churned = F.col("churn") == 1
    per_split = scored.filter("mature").groupBy("split").agg(
        F.count_if(flagged & churned).alias("hits"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(churned).alias("churned"),
    )
    return per_split.rollup("split").agg(
        ratio_or(F.sum("hits"), F.sum("flagged")).alias("precision"),
        ratio_or(F.sum("hits"), F.sum("churned")).alias("recall"),
    ).withColumn("split", F.coalesce("split", F.lit("mature")))
