"""Customer lifetime value, risk × value quadrants, and the reports on them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import (
    at_least,
    count_text,
    days_between,
    money_text,
    month_of,
    percent_text,
    percentage_text,
    ratio_or,
)
from tidemark.params import Params

# Segment names as the reports and exports print them.
WIN_BACK = "High CLV + High Risk (Win-back)"
REWARD = "High CLV + Low Risk (Reward)"
MONITOR = "Low CLV + High Risk (Monitor)"
NO_ACTION = "Low CLV + Low Risk (No Action)"
QUADRANTS = [WIN_BACK, REWARD, MONITOR, NO_ACTION]
ALL_SEGMENTS = "All Segments"


def clv(features: DataFrame, snapshot: Column, params: Params) -> DataFrame:
    """Adds aov, tenure_days (floored), annual_frequency and clv."""
    tenure = at_least(days_between(F.col("first_purchase_date"), snapshot), params.min_tenure_days)
    value = (
        F.col("aov") * F.col("annual_frequency") * F.lit(params.lifespan_years)
        * F.lit(params.gross_margin)
    )
    return (
        features.withColumn("aov", ratio_or(F.col("monetary"), F.col("frequency"), default=None))
        .withColumn("tenure_days", tenure.cast("bigint"))
        .withColumn(
            "annual_frequency", F.col("frequency") / (F.col("tenure_days") / F.lit(params.days_per_year))
        )
        .withColumn("clv", at_least(F.coalesce(value, F.lit(0.0)), 0.0))
    )


def recency_risk(features: DataFrame) -> DataFrame:
    """A model-free risk score in [0, 1): rr / (1 + rr) of the recency ratio."""
    ratio = F.col("recency_ratio")
    return features.withColumn("churn_probability", ratio / (F.lit(1.0) + ratio))


def quadrant_of(high_value: Column, high_risk: Column) -> Column:
    return (
        F.when(high_value & high_risk, WIN_BACK)
        .when(high_value, REWARD)
        .when(high_risk, MONITOR)
        .otherwise(NO_ACTION)
    )


def tier_of(high: Column) -> Column:
    return F.when(high, "High").otherwise("Low")


def resegment(scored: DataFrame, threshold: Column | float, median_clv: Column) -> DataFrame:
    """Quadrant and tiers at a risk threshold; both comparisons are inclusive."""
    split = scored.withColumns(
        {
            "high_risk": F.coalesce(F.col("churn_probability") >= threshold, F.lit(False)),
            "high_value": F.coalesce(F.col("clv") >= median_clv, F.lit(False)),
        }
    )
    high_risk, high_value = F.col("high_risk"), F.col("high_value")
    return split.withColumns(
        {
            "quadrant": quadrant_of(high_value, high_risk),
            "risk_tier": tier_of(high_risk),
            "value_tier": tier_of(high_value),
        }
    ).drop("high_risk", "high_value")


def _listed_quadrants(spark) -> DataFrame:
    names = F.array(*[F.lit(q) for q in QUADRANTS])
    return spark.range(1).select(F.posexplode(names).alias("position", "quadrant"))


def quadrant_summary(segmented: DataFrame) -> DataFrame:
    """All four quadrants in report order; an empty one shows zeros."""
    found = segmented.groupBy("quadrant").agg(
        F.count("customer_unique_id").alias("customer_count"),
        F.sum("clv").alias("total_clv"),
        F.avg("clv").alias("avg_clv"),
        F.avg("churn_probability").alias("avg_churn_probability"),
    )
    everyone = F.sum("customer_count").over(Window.partitionBy())
    return (
        _listed_quadrants(segmented.sparkSession)
        .join(F.broadcast(found), "quadrant", "left")
        .na.fill(0, ["customer_count", "total_clv", "avg_clv", "avg_churn_probability"])
        .withColumn("share_pct", ratio_or(F.col("customer_count"), everyone) * 100)
        .orderBy("position")
        .drop("position")
    )


def quadrant_display(summary: DataFrame) -> DataFrame:
    return summary.select(
        "quadrant",
        count_text(F.col("customer_count")).alias("customer_count"),
        money_text(F.col("total_clv")).alias("total_clv"),
        money_text(F.col("avg_clv")).alias("avg_clv"),
        percent_text(F.col("avg_churn_probability")).alias("avg_churn_probability"),
        percentage_text(F.col("share_pct"), 2).alias("share_pct"),
    )


def quadrant_sizes(segmented: DataFrame) -> DataFrame:
    """Quadrants that occur, largest first, with their total CLV."""
    return (
        segmented.groupBy("quadrant")
        .agg(F.count("*").alias("customers"), F.sum("clv").alias("total_clv"))
        .orderBy(F.desc("customers"), "quadrant")
    )


def risk_kpis(segmented: DataFrame) -> DataFrame:
    at_risk = F.when(F.col("risk_tier") == "High", F.col("clv")).otherwise(0.0)
    return segmented.agg(
        F.count("*").alias("total_customers"),
        F.coalesce(F.sum(at_risk), F.lit(0.0)).alias("clv_at_risk"),
        F.avg("clv").alias("avg_clv"),
        F.count_distinct(month_of(F.col("first_purchase_date"))).alias("cohort_months"),
    )


def in_segment(segmented: DataFrame, segment: str = ALL_SEGMENTS) -> DataFrame:
    if segment == ALL_SEGMENTS:
        return segmented
    if segment not in QUADRANTS:
        raise ValueError(f"unknown segment: {segment}")
    return segmented.filter(F.col("quadrant") == segment)


def crm_export(segmented: DataFrame, segment: str = ALL_SEGMENTS) -> DataFrame:
    return in_segment(segmented, segment).select(
        "customer_unique_id", "clv", "churn_probability", "quadrant"
    )


def action_table(segmented: DataFrame, segment: str = ALL_SEGMENTS) -> DataFrame:
    """The customer list as the action report prints it."""
    return in_segment(segmented, segment).select(
        "customer_unique_id",
        "recency",
        "frequency",
        money_text(F.col("monetary"), grouped=False).alias("monetary"),
        money_text(F.col("clv"), grouped=False).alias("clv"),
        percent_text(F.col("churn_probability")).alias("churn_probability"),
        "quadrant",
    )


def segment_sample(segmented: DataFrame, size: int, seed: int) -> DataFrame:
    """Exactly min(size, N) customers, the same ones under any partitioning.

    The sample is the size smallest salted hashes. Counting the hashes by their
    first four digits (at most 65,536 counts) gives the shortest range of hashes
    that surely holds the sample; only that range is sorted. Without it every
    partition would send its own size smallest rows to the one task that merges.
    """
    draw = F.md5(F.concat(F.col("customer_unique_id").cast("string"), F.lit(f":{seed}")))
    drawn = segmented.withColumn("draw", draw)
    digits = F.substring("draw", 1, 4)
    counted = drawn.groupBy(digits.alias("digits")).agg(F.count("*").alias("n"))
    so_far = Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    enough = F.min(F.when(F.col("reached") >= size, F.col("digits")))
    cutoff = counted.withColumn("reached", F.sum("n").over(so_far)).agg(
        F.coalesce(enough, F.lit("ffff"))
    )
    return (
        drawn.filter(digits <= cutoff.scalar())
        .orderBy("draw", "customer_unique_id")
        .limit(size)
        .drop("draw")
    )


def maturity_split(
    features: DataFrame, split_date: date, scalars: Column
) -> DataFrame:
    """Adds split: train before the split date, holdout up to the maturity date."""
    first = F.col("first_purchase_date")
    mature_date = F.date_sub(F.col("run.snapshot_date"), F.col("run.churn_threshold"))
    name = (
        F.when(first < F.lit(split_date), "train").when(F.col("mature"), "holdout").otherwise("immature")
    )
    return (
        features.withColumn("run", scalars)
        .withColumn("mature", first <= mature_date)
        .withColumn("split", name)
        .drop("run")
    )


def split_summary(split: DataFrame) -> DataFrame:
    """Customers, churners and churn rate per split, and over everyone."""
    per_split = split.groupBy("split").agg(
        F.count("*").alias("customers"), F.sum("churn").cast("bigint").alias("churners")
    )
    return (
        per_split.rollup("split")
        .agg(F.sum("customers").alias("customers"), F.sum("churners").alias("churners"))
        .select(
            F.coalesce("split", F.lit("all")).alias("split"),
            "customers",
            "churners",
            ratio_or(F.col("churners"), F.col("customers")).alias("churn_rate"),
        )
    )
