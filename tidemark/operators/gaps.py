"""Days between consecutive purchases of a customer.

All of it starts from customer-days (customer, date, number of orders). That
pre-aggregate combines on the map side and bounds a customer's window partition
by the calendar: a customer with a third of all orders still has at most one row
per day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import at_least, days_between
from tidemark.params import Params

_CHUNK = 100_000


def customer_days(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_unique_id", "order_date").agg(F.count("*").alias("orders"))


def day_gaps(days: DataFrame) -> DataFrame:
    """Each customer-day with the previous purchase day and the gap to it."""
    history = Window.partitionBy("customer_unique_id").orderBy("order_date")
    previous = F.lag("order_date").over(history)
    return days.withColumn("prev_order_date", previous).withColumn(
        "gap", days_between(F.col("prev_order_date"), F.col("order_date"))
    )


def purchase_gaps(days: DataFrame) -> DataFrame:
    """One row per repeat order: date, previous order's date, gap in days.

    The n orders of a day give one row to the previous day (if there is one) and
    n - 1 rows of gap 0. The latter are expanded chunk by chunk: each chunk is a
    row that the shuffle sends to some task, so a day with a third of all orders
    is not expanded in one place. The number of tasks is given, because adaptive
    execution would merge them by the size of the rows before the expansion.
    """
    tasks = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    between_days = (
        day_gaps(days)
        .filter(F.col("prev_order_date").isNotNull())
        .select("customer_unique_id", "order_date", "prev_order_date", "gap")
    )
    repeats = F.col("orders") - 1
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((repeats - 1) / _CHUNK))
    chunk_size = F.least(F.lit(_CHUNK).cast("bigint"), repeats - F.col("chunk") * _CHUNK)
    same_day = (
        days.filter(F.col("orders") > 1)
        .withColumn("chunk", F.explode(chunks))
        .repartition(tasks, "customer_unique_id", "order_date", "chunk")
        .withColumn("k", F.explode(F.sequence(F.lit(1).cast("bigint"), chunk_size)))
        .select(
            "customer_unique_id",
            "order_date",
            F.col("order_date").alias("prev_order_date"),
            F.lit(0).cast("bigint").alias("gap"),
        )
    )
    return between_days.unionByName(same_day)


def gap_summary(days: DataFrame) -> DataFrame:
    """One row: counts, median and mean of the positive gaps, last order date.

    Gaps are first counted per value (at most one value per calendar day), so the
    exact median is taken from a short histogram, not from the gaps themselves.
    """
    histogram = (
        day_gaps(days)
        .groupBy("gap")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("orders") - 1).alias("same_day"),
            F.max("order_date").alias("last_date"),
        )
    )
    positive = F.col("gap").isNotNull()
    n_positive = F.coalesce(F.sum(F.when(positive, F.col("n"))), F.lit(0).cast("bigint"))
    return histogram.agg(
        (n_positive + F.coalesce(F.sum("same_day"), F.lit(0).cast("bigint"))).alias("n_gaps"),
        n_positive.alias("n_positive"),
        F.expr("percentile(gap, 0.5D, n) FILTER (WHERE gap IS NOT NULL)").alias("median_gap"),
        (F.sum(F.col("gap") * F.col("n")) / F.sum(F.when(positive, F.col("n")))).alias("mean_gap"),
        F.max("last_date").alias("last_date"),
    )


def run_scalars(summary: DataFrame, params: Params, as_of: date | None = None) -> DataFrame:
    """One row: churn threshold, snapshot date, median gap used for imputation.

    The snapshot is the day after the last completed order, or after as_of.
    """
    last = F.lit(as_of) if as_of is not None else F.col("last_date")
    median = F.coalesce("median_gap", F.lit(params.fallback_median_gap))
    threshold = (median * params.gap_multiple).cast("int")
    return summary.select(
        at_least(threshold, params.min_churn_threshold).alias("churn_threshold"),
        F.date_add(last, 1).alias("snapshot_date"),
        median.alias("median_gap"),
    )


def as_scalar(one_row: DataFrame):
    """The one row as a struct column: an uncorrelated scalar subquery."""
    return one_row.select(F.struct(*one_row.columns)).scalar()
