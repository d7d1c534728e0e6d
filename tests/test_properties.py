from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark.operators import experiment, segments
from tidemark.plans.catalog import plan_for


@pytest.fixture(scope="module")
def plan(spark):
    made = plan_for(spark, SMALL)
    yield made
    made.workspace.close()


def test_first_period_is_complete(plan):
    first = plan.cohort_retention.filter("period_diff = 0")
    assert {(r.retention_rate, r.active_customers == r.cohort_size) for r in first.collect()} == {(1.0, True)}
    sizes = plan.cohort_sizes.orderBy("cohort_month").collect()
    assert sizes == plan.acquisition_by_month().collect()
    assert sum(r.cohort_size for r in sizes) == 145


def test_gaps_are_orders_minus_customers(plan):
    assert plan.purchase_gaps.count() == plan.orders.count() - plan.rfm.count()
    assert plan.gap_stats.first().n_gaps == plan.purchase_gaps.count()


def test_quadrants_partition_the_customers(plan):
    summary = segments.quadrant_summary(plan.segments)
    total = summary.agg(F.sum("customer_count"), F.sum("share_pct")).first()
    assert total[0] == 145 and total[1] == pytest.approx(100.0)
    assert plan.segments.groupBy("value_tier").count().count() == 2


def test_sample_is_exact_and_stable(plan):
    a = segments.segment_sample(plan.segments.repartition(3), 40, 42)
    b = segments.segment_sample(plan.segments.repartition(11), 40, 42)
    ids = [r.customer_unique_id for r in a.collect()]
    assert len(set(ids)) == 40
    assert ids == [r.customer_unique_id for r in b.collect()]
    assert ids != [r.customer_unique_id for r in segments.segment_sample(plan.segments, 40, 43).collect()]
    assert segments.segment_sample(plan.segments, 5000, 42).count() == 145


def test_sweep_is_monotone(plan):
    rows = plan.threshold_sweep.collect()
    assert len(rows) == 81
    for low, high in zip(rows, rows[1:]):
        assert low.recall >= high.recall
        assert low.win_back >= high.win_back and low.clv_at_risk >= high.clv_at_risk
    assert {r.win_back + r.reward + r.monitor + r.no_action for r in rows} == {145}


def test_staged_fact_gives_the_same_experiment(plan):
    day = plan.as_of_pool_date()
    staged = plan.on_staged_fact()
    assert staged.as_of_pool_date() == day
    assert tuple(plan.readout(day).first()) == pytest.approx(tuple(staged.readout(day).first()))
    arms = {r.arm: r["count"] for r in plan.outcomes(day).groupBy("arm").count().collect()}
    assert arms == {experiment.TREATMENT: 22, experiment.CONTROL: 16}


def test_supplied_assignment_replaces_the_hash(spark, plan):
    day = plan.as_of_pool_date()
    assigned = plan.rfm.select(
        "customer_unique_id",
        F.lit(10.0).alias("clv"),
        F.when(F.col("customer_unique_id") % 2 == 0, "treatment").otherwise("control").alias("arm"),
    )
    result = plan.readout(day, assigned).first()
    assert result.n_treatment + result.n_control == 145
    assert result.avg_clv == 10.0
