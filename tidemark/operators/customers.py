"""Customer-level features from the order fact.

One pass: the fact is reduced to (customer, category), then to the customer.
Both steps combine on the map side, count distinct categories without an
Expand, and bound a hot customer's second-step rows by the number of categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    at_least,
    days_between,
    from_cents,
    ratio_or,
    smoothed_ratio,
)
from tidemark.params import Params

FEATURE_COLUMNS = [
    "recency",
    "frequency",
    "monetary",
    "purchase_freq_trend",
    "recency_ratio",
    "discount_dependency",
    "category_diversity_trend",
    "aov_trend",
]


def rfm_totals(fact: DataFrame) -> DataFrame:
    """Last order, number of orders and value per customer: rfm before the snapshot."""
    return fact.groupBy("customer_unique_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        F.sum("order_cents").alias("cents"),
    )


def rfm(totals: DataFrame, snapshot: Column) -> DataFrame:
    return totals.select(
        "customer_unique_id",
        days_between(F.col("last_order_date"), snapshot).alias("recency"),
        "frequency",
        from_cents(F.col("cents")).alias("monetary"),
        "last_order_date",
    )


def window_flags(order_date: Column, snapshot: Column, params: Params) -> tuple[Column, Column]:
    """(in the recent window, in the prior window); both are half-open."""
    recent_start = F.date_sub(snapshot, params.recent_days)
    prior_start = F.date_sub(snapshot, params.prior_days)
    recent = (order_date >= recent_start) & (order_date < snapshot)
    prior = (order_date >= prior_start) & (order_date < recent_start)
    return recent, prior


def customer_rollup(fact: DataFrame, snapshot: Column, params: Params) -> DataFrame:
    """One row per customer with everything the features need."""
    dated = fact.withColumn("snapshot", snapshot)
    recent, prior = window_flags(F.col("order_date"), F.col("snapshot"), params)
    flagged = dated.withColumns({"recent": recent, "prior": prior})
    cents = F.col("order_cents")
    no_cents = F.lit(0).cast("bigint")
    voucher = F.col("used_voucher") if "used_voucher" in fact.columns else F.lit(0)
    by_category = flagged.groupBy("customer_unique_id", "category").agg(
        F.count("*").alias("orders"),
        F.sum(cents).alias("cents"),
        F.sum(voucher).alias("voucher_orders"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.count_if("recent").alias("recent_orders"),
        F.count_if("prior").alias("prior_orders"),
        F.sum(F.when(F.col("recent"), cents).otherwise(no_cents)).alias("recent_cents"),
        F.sum(F.when(F.col("prior"), cents).otherwise(no_cents)).alias("prior_cents"),
    )
    summed = [
        F.sum(name).alias(name)
        for name in (
            "orders", "cents", "voucher_orders", "recent_orders", "prior_orders",
            "recent_cents", "prior_cents",
        )
    ]
    return by_category.groupBy("customer_unique_id").agg(
        *summed,
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.count_if(F.col("recent_orders") > 0).alias("recent_categories"),
        F.count_if(F.col("prior_orders") > 0).alias("prior_categories"),
    )


def mean_order(cents: Column, orders: Column) -> Column:
    """Mean order value; 0 where the window holds no order."""
    return ratio_or(from_cents(cents), orders, 0.0)


def window_metrics(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        "customer_unique_id",
        F.col("recent_orders").alias("freq_recent"),
        F.col("prior_orders").alias("freq_prior"),
        mean_order(F.col("recent_cents"), F.col("recent_orders")).alias("aov_recent"),
        mean_order(F.col("prior_cents"), F.col("prior_orders")).alias("aov_prior"),
        F.col("recent_categories").alias("cat_recent"),
        F.col("prior_categories").alias("cat_prior"),
    )


def voucher_dependency(fact: DataFrame) -> DataFrame:
    """Share of a customer's orders that were paid at least partly by voucher."""
    counted = fact.groupBy("customer_unique_id").agg(
        F.sum("used_voucher").cast("bigint").alias("voucher_orders"),
        F.count("order_id").alias("total_orders"),
    )
    share = ratio_or(F.col("voucher_orders"), F.col("total_orders"))
    return counted.withColumn("discount_dependency", share)


def mean_gap(first: Column, last: Column, orders: Column, median_gap: Column) -> Column:
    """Mean gap over all repeat orders, same-day ones included, floored at a day.

    Consecutive gaps add up to last - first, so the mean needs no window; a
    single purchase takes the global median.
    """
    own = ratio_or(days_between(first, last), orders - 1, default=None)
    return at_least(F.coalesce(own, median_gap), 1.0)


def avg_gap(days: DataFrame, median_gap: Column) -> DataFrame:
    """Mean gap per customer from customer-days, which the median reads as well."""
    span = days.groupBy("customer_unique_id").agg(
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.sum("orders").alias("orders"),
    )
    gap = mean_gap(F.col("first_date"), F.col("last_date"), F.col("orders"), median_gap)
    return span.select("customer_unique_id", gap.alias("avg_gap"))


def churn_flag(recency: Column, threshold: Column | int) -> Column:
    return (recency > threshold).cast("int")


def churn_label(days: DataFrame, scalars: Column) -> DataFrame:
    """Recency and label per customer; exactly the threshold is not yet churn.

    Reading the same customer-days as the scalars lets Spark reuse their exchange.
    """
    last = days.groupBy("customer_unique_id").agg(F.max("order_date").alias("last_date"))
    recency = days_between(F.col("last_date"), F.col("run.snapshot_date"))
    return (
        last.withColumn("run", scalars)
        .withColumn("recency", recency)
        .withColumn("churn", churn_flag(F.col("recency"), F.col("run.churn_threshold")))
        .select("customer_unique_id", "recency", "churn")
    )


def customer_features(rollup: DataFrame, scalars: Column) -> DataFrame:
    """Feature table plus the first purchase date the later steps split on."""
    gap = mean_gap(F.col("first_date"), F.col("last_date"), F.col("orders"), F.col("run.median_gap"))
    based = rollup.withColumn("run", scalars).withColumn(
        "recency", days_between(F.col("last_date"), F.col("run.snapshot_date"))
    )
    return based.select(
        "customer_unique_id",
        "recency",
        F.col("orders").alias("frequency"),
        from_cents(F.col("cents")).alias("monetary"),
        smoothed_ratio(F.col("recent_orders"), F.col("prior_orders")).alias("purchase_freq_trend"),
        (F.col("recency") / gap).alias("recency_ratio"),
        ratio_or(F.col("voucher_orders"), F.col("orders")).alias("discount_dependency"),
        smoothed_ratio(F.col("recent_categories"), F.col("prior_categories")).alias(
            "category_diversity_trend"
        ),
        smoothed_ratio(
            mean_order(F.col("recent_cents"), F.col("recent_orders")),
            mean_order(F.col("prior_cents"), F.col("prior_orders")),
        ).alias("aov_trend"),
        churn_flag(F.col("recency"), F.col("run.churn_threshold")).alias("churn"),
        F.col("first_date").alias("first_purchase_date"),
    )


def feature_profile(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of each numeric column."""
    columns = columns or FEATURE_COLUMNS + ["churn"]
    return column_statistics(features, columns, F.stddev_samp)


def column_statistics(frame: DataFrame, columns: list[str], deviation) -> DataFrame:
    """One wide aggregate, then its single row turned into a row per column."""
    wide = frame.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(c).alias("mean"),
                deviation(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.select(F.inline(F.array(*columns)))
