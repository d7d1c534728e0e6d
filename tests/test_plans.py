"""What the plans must and must not contain, with look-ups too big to broadcast."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark.operators import customers, facts
from tidemark.plans import catalog
from tidemark.plans.catalog import plan_for
from tidemark.plans.retention import RetentionPlan
from tidemark.sources.star import star_params

LAZY = [
    "order_fact", "cohort_retention", "purchase_gaps", "churn_label", "gap_stats", "run_scalars", "avg_gap",
    "window_metrics", "voucher_dependency", "customer_features", "maturity_split", "clv",
    "confusion_matrix", "live_metrics",
]


@pytest.fixture()
def big_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def text_of(frame) -> str:
    return frame._jdf.queryExecution().toString()


def executed(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python_no_forced_broadcast(spark, big_tables, name):
    plan = text_of(catalog.registered()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "PythonUDF", "ArrowEval"):
        assert operator not in plan, operator


def scan(plan: str, table: str) -> str:
    lines = [line for line in plan.splitlines() if "FileScan" in line and f"/{table}.parquet" in line]
    assert lines, table
    return lines[0]


def test_status_filter_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        fact = catalog.plan_for(spark, SMALL).fact_with(value=True)
        plan = executed(customers.rfm_totals(fact))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    orders = scan(plan, "orders")
    assert "EqualTo(o_orderstatus,F)" in orders
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders
    lines = re.search(r"ReadSchema: struct<(.*?)>", scan(plan, "lineitem")).group(1)
    assert lines == "l_orderkey:bigint,l_extendedprice:double"
    assert "/part.parquet" not in plan


def test_as_of_reaches_the_scan_as_a_literal(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = catalog.plan_for(spark, SMALL).plan_at(date(1998, 1, 1))
        orders = scan(executed(plan.orders), "orders")
        between = catalog.plan_for(spark, SMALL).orders_between(date(1998, 1, 1), date(1998, 6, 1))
        window = scan(executed(between), "orders")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThan(o_orderdate,1998-01-02T00:00)" in orders
    assert "GreaterThanOrEqual(o_orderdate,1998-01-02T00:00)" in window
    assert "LessThan(o_orderdate,1998-06-02T00:00)" in window


def test_tables_ask_only_for_their_parts(spark):
    assert "lineitem" not in executed(catalog.registered()["cohort_retention"](spark, SMALL))
    vouchers = executed(catalog.registered()["voucher_dependency"](spark, SMALL))
    assert "l_extendedprice" not in vouchers and "part.parquet" not in vouchers


def test_windows_run_on_reduced_rows(spark, big_tables):
    """Below every customer window there is an aggregate by customer and calendar unit."""
    for name in ("cohort_retention", "purchase_gaps", "gap_stats"):
        plan = executed(catalog.registered()[name](spark, SMALL))
        below = plan[plan.rindex("Window [") :]
        keys = r"HashAggregate\(keys=\[customer_unique_id#\d+L?, (order_date|activity_month)"
        readers = 2 if name == "purchase_gaps" else 1
        assert len(re.findall(keys, below)) == 2 * readers, "partial and final aggregate"


def test_median_orders_only_the_middle_ranges(spark):
    plan = catalog.plan_for(spark, SMALL)
    frame = plan.segments
    frame.collect()
    text = executed(frame)
    assert "Subquery" in text
    assert "median(" not in text and "percentile(" not in text
    assert "SortMergeJoin" not in text
    plan.workspace.close()


def test_scalars_share_the_join_exchanges(spark, big_tables):
    """Main query and scalar subquery shuffle orders and customers only once."""
    frame = catalog.registered()["churn_label"](spark, SMALL)
    frame.collect()
    final = executed(frame).split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_first_product_hashes_and_equals_the_pair(spark):
    """Integer ids: no sort aggregate, and the product of the least (item number, product), missing values first."""
    big = 2**63 - 1
    rows = [
        ("a", 2, 5), ("a", 1, 9), ("a", 1, 7), ("b", -2**31, -big - 1), ("b", -2**31, big), ("c", 2**31 - 1, big),
        ("d", None, 3), ("d", 0, 1), ("e", 1, None), ("e", 1, 0), ("f", 1, -1), ("f", 1, 1),
        ("g", 1, 5), ("g", 2**20, 1), ("g", 2**30, 0), ("h", 3, 2**50), ("h", 3, 4), ("i", 3, 2**50), ("i", 4, 4), ("j", 7, 8),
        ("k", -1, 9), ("k", 0, 1),
    ]
    items = spark.createDataFrame([(*r, 1.0) for r in rows], "order_id string, order_item_id int, product_id long, price double")
    got = {r.order_id: r.product_id for r in facts.order_baskets(items).collect()}
    pairs = items.groupBy("order_id").agg(F.min(F.struct("order_item_id", "product_id")).getField("product_id").alias("p"))
    assert got == {r.order_id: r.p for r in pairs.collect()}
    ones = {r.order_id: r.product_id for r in facts.order_baskets(items, "equals_one").collect()}
    assert ones == {"a": 7, "b": None, "c": None, "d": None, "e": None, "f": -1, "g": 5, "h": None, "i": None, "j": None, "k": None}
    plan = facts.order_baskets(items)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("name", ["rfm", "window_metrics"])
def test_building_starts_no_job(spark, name):
    context = spark.sparkContext
    context.setJobGroup(f"build-{name}", "plan only")
    plan = plan_for(spark, SMALL)
    frame = getattr(plan, name)
    plan.register_views()
    assert not context.statusTracker().getJobIdsForGroup(f"build-{name}")
    assert frame.count() > 0
    context.setJobGroup("", "")


def test_last_order_falls_back_to_the_whole_join(spark):
    """The newest orders belong to nobody: the day of the last known customer's order decides."""
    tables = plan_for(spark, SMALL).tables
    stranger = tables.orders.limit(1).select(
        F.lit(-1).cast("bigint").alias("order_id"), F.lit(-5).cast("bigint").alias("customer_id"), F.lit("F").alias("order_status"),
        F.lit("2030-01-01 10:00:00").cast("timestamp_ntz").alias("order_purchase_timestamp"))
    orders = tables.orders.unionByName(stranger)
    plan = RetentionPlan(replace(tables, orders=orders), star_params(), None)
    assert plan.last_order_date() == plan_for(spark, SMALL).last_order_date()
