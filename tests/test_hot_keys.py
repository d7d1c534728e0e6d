"""A third of all rows behind one customer, one day or one order."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shop_fixture import shop
from tidemark.operators import cohorts, facts, gaps
from tidemark.params import Params
from tidemark.plans.retention import RetentionPlan
from tidemark.sources import ShopTables


@pytest.fixture(scope="module")
def hot_orders(spark):
    """9,000 orders of 2,001 customers; customer 0 has 3,000 of them on 300 days."""
    n = F.col("id")
    customer = F.when(n < 3000, F.lit(0)).otherwise(n % 2000 + 1)
    day = F.when(n < 3000, n % 300).otherwise(F.abs(F.xxhash64("id")) % 700)
    return spark.range(9000).select(
        n.alias("order_id"),
        customer.cast("bigint").alias("customer_unique_id"),
        F.date_add(F.lit(date(2020, 1, 1)), day.cast("int")).alias("order_date"),
    ).cache()


def brute_gaps(orders):
    data = orders.toPandas().sort_values(["customer_unique_id", "order_date"])
    data["prev"] = data.groupby("customer_unique_id").order_date.shift(1)
    data = data.dropna()
    data["gap"] = [(a - b).days for a, b in zip(data.order_date, data.prev)]
    return data


def test_gaps_match_brute_force(hot_orders):
    expected = brute_gaps(hot_orders)
    got = gaps.purchase_gaps(gaps.customer_days(hot_orders)).toPandas()
    columns = ["customer_unique_id", "order_date", "gap"]
    assert sorted(map(tuple, got[columns].values)) == sorted(map(tuple, expected[columns].values))
    stats = gaps.gap_summary(gaps.customer_days(hot_orders)).first()
    positive = expected[expected.gap > 0].gap
    assert stats.n_gaps == len(expected) == 9000 - 2001
    assert stats.n_positive == len(positive)
    assert stats.median_gap == positive.median()
    assert stats.mean_gap == pytest.approx(positive.mean())


@pytest.mark.parametrize("chunk", [1, 2, 3, 10, 1000])
def test_crowded_days_expand_in_chunks(hot_orders, monkeypatch, chunk):
    monkeypatch.setattr(gaps, "_CHUNK", chunk)
    expected = brute_gaps(hot_orders)
    got = gaps.purchase_gaps(gaps.customer_days(hot_orders)).toPandas()
    assert len(got) == len(expected)
    assert sorted(got.gap) == sorted(expected.gap)


def test_one_crowded_day_is_expanded_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(gaps, "_CHUNK", 50)
    one_day = spark.range(10_000).select(
        F.lit(1).alias("customer_unique_id"), F.lit(date(2020, 1, 1)).alias("order_date")
    )
    got = gaps.purchase_gaps(gaps.customer_days(one_day))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 9_999
    assert len(sizes) == 8 and max(sizes) < 3_000


def test_hot_customer_is_reduced_before_the_window(hot_orders):
    days = gaps.customer_days(hot_orders)
    assert days.filter("customer_unique_id = 0").count() == 300
    months = cohorts.cohort_activity(hot_orders).filter("customer_unique_id = 0")
    assert months.count() == 10


def test_hot_order_basket(spark):
    items = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        (F.col("id") + 1).cast("int").alias("order_item_id"),
        F.concat(F.lit("p"), F.col("id")).alias("product_id"),
        F.lit(0.1).alias("price"),
    )
    hot = facts.order_baskets(items).filter("order_id = 'hot'").first()
    assert (hot.order_cents, hot.product_id) == (100_000, "p0")


def test_hot_category_and_customer_rollup(spark, workspace):
    """Everybody's orders under one customer give the totals of the whole shop."""
    tables = shop(spark)
    merged = tables.customers.withColumn("customer_unique_id", F.lit("everyone"))
    plan = RetentionPlan(ShopTables(**{**tables.__dict__, "customers": merged}), Params(), workspace)
    row = plan.customer_features.first()
    assert (row.frequency, row.monetary, row.recency) == (6, 84.5, 1)
    assert plan.window_metrics.first().cat_prior == 3
    assert plan.purchase_gaps.count() == 5


SPLIT_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def small_skew_limits(spark):
    before = {key: spark.conf.get(key, None) for key in SPLIT_SETTINGS}
    for key, value in SPLIT_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def final_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def hot_placed(spark):
    return spark.range(0, 300_000, 1, 8).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1).alias("customer_id"),
        F.lit("2020-01-01 10:00:00").cast("timestamp_ntz").alias("order_purchase_timestamp"),
    )


def hot_people(spark):
    ids = spark.range(0, 5001, 1, 4)
    return ids.select(F.col("id").alias("customer_id"), F.col("id").alias("customer_unique_id"))


def test_hot_customer_join_is_split(spark, small_skew_limits):
    """A customer with a third of the orders does not stay in one join task."""
    days = gaps.customer_days(facts.with_customer(hot_placed(spark), hot_people(spark)))
    hot = days.orderBy(F.desc("orders")).first()
    assert (hot.customer_unique_id, hot.orders) == (0, 100_000)
    assert days.agg(F.sum("orders")).first()[0] == 300_000
    assert "SortMergeJoin(skew=true)" in final_plan(days)


def test_hot_and_missing_products_are_split(spark, small_skew_limits):
    """A third of the orders have one product, another third have no items at all."""
    n = F.col("id")
    tables = ShopTables(
        orders=None,
        customers=hot_people(spark),
        items=spark.range(0, 300_000, 1, 8).filter(n % 3 != 1).select(
            n.alias("order_id"),
            F.lit(1).alias("order_item_id"),
            F.when(n % 3 == 0, 7).otherwise(n % 4000).cast("bigint").alias("product_id"),
            F.lit(2.0).alias("price"),
        ),
        products=spark.range(4000).select(
            n.alias("product_id"), F.concat(F.lit("c"), n % 50).alias("product_category_name")
        ),
        translation=spark.range(0).select(
            F.lit("").alias("product_category_name"), F.lit("").alias("product_category_name_english")
        ),
        payments=None,
    )
    fact = facts.customer_order_fact(hot_placed(spark), tables, Params())
    totals = fact.groupBy("category").agg(F.count("*").alias("n"), F.sum("order_cents").alias("cents"))
    got = {r.category: (r.n, r.cents) for r in totals.collect()}
    assert got["unknown"] == (100_000, 0)
    assert sum(n for n, _ in got.values()) == 300_000
    assert sum(cents for _, cents in got.values()) == 200_000 * 200
    assert "SortMergeJoin(skew=true) [product_id" in final_plan(fact.select("category", "order_cents"))
