"""Monthly cohorts: who first bought when, and who came back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import month_of, months_between_starts
from tidemark.workspace import Workspace


def first_purchase(orders: DataFrame) -> DataFrame:
    first = orders.groupBy("customer_unique_id").agg(F.min("order_date").alias("first_purchase_date"))
    return first.withColumn("cohort_month", month_of(F.col("first_purchase_date")))


def cohort_activity(orders: DataFrame) -> DataFrame:
    """Distinct (customer, cohort month, activity month).

    Reducing to customer-months first bounds what the window sees per customer
    by the calendar, however many orders one customer holds.
    """
    months = orders.select(
        "customer_unique_id", month_of(F.col("order_date")).alias("activity_month")
    ).distinct()
    customer = Window.partitionBy("customer_unique_id")
    return months.select(
        "customer_unique_id",
        F.min("activity_month").over(customer).alias("cohort_month"),
        "activity_month",
    )


def activity_sketches(activity: DataFrame, digits: int = 14) -> DataFrame:
    """(cohort_month, activity_month, customers): a distinct-count sketch per cohort and month, to be stored.

    Sketches of several months, cohorts or shops merge without the customers; each takes some 2 ** digits bytes at most
    and is off by about 0.8 / sqrt(2 ** digits) of the count (one standard deviation). This is an
    opt-in: all counts of the retention tables are exact.
    """
    return activity.groupBy("cohort_month", "activity_month").agg(
        F.hll_sketch_agg("customer_unique_id", F.lit(digits)).alias("customers"))


def estimated_customers(sketches: DataFrame, *by: str) -> DataFrame:
    """Distinct customers over the union of the sketches of each group."""
    union = F.hll_sketch_estimate(F.hll_union_agg("customers"))
    return sketches.groupBy(*by).agg(union.cast("bigint").alias("customers"))


def cohort_sizes(orders: DataFrame) -> DataFrame:
    """Customers per cohort; first_purchase is one row per customer, so count is enough."""
    return first_purchase(orders).groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Active customers and retention rate per cohort month and period.

    Every customer is active in the first month, so a cohort's size is its
    period-0 count: no second aggregate over the customers and no join.
    """
    counts = (
        cohort_activity(orders)
        .groupBy(
            "cohort_month",
            months_between_starts(F.col("cohort_month"), F.col("activity_month")).alias("period_diff"),
        )
        .agg(F.count("*").alias("active_customers"))
    )
    cohort = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("period_diff") == 0, F.col("active_customers"))).over(cohort)
    rate = F.round(F.col("active_customers").cast("double") / F.col("cohort_size"), 4)
    return (
        counts.withColumn("cohort_size", size)
        .select(
            "cohort_month",
            "cohort_size",
            "period_diff",
            "active_customers",
            rate.alias("retention_rate"),
        )
        .orderBy("cohort_month", "period_diff")
    )


def cohort_range(retention: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Cohorts whose month lies in the inclusive range; None leaves a side open."""
    kept = retention
    if first is not None:
        kept = kept.filter(F.col("cohort_month") >= F.lit(first))
    if last is not None:
        kept = kept.filter(F.col("cohort_month") <= F.lit(last))
    return kept


def cohort_pivot(
    retention: DataFrame,
    workspace: Workspace,
    periods: int = 12,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Cohort × period matrix of rates over the first periods that exist.

    The retention table (at most months² / 2 rows) is staged once, because the
    pivot columns have to be known before the pivot is planned.
    """
    table = workspace.stage(cohort_range(retention, first, last), "cohort-retention")
    present = table.select("period_diff").distinct().orderBy("period_diff").limit(periods)
    columns = [row.period_diff for row in present.collect()]
    wide = table.groupBy("cohort_month").pivot("period_diff", columns)
    named = wide.agg(F.max("retention_rate")).select(
        "cohort_month", *[F.col(f"`{p}`").alias(f"period_{p}") for p in columns]
    )
    return named.orderBy("cohort_month")


def acquisition_by_month(retention: DataFrame) -> DataFrame:
    """New customers per cohort month, in month order."""
    return (
        retention.groupBy("cohort_month")
        .agg(F.max("cohort_size").alias("cohort_size"))
        .orderBy("cohort_month")
    )
