"""Figures computed independently for the test tables.

The median CLV at sf0.01 is 57,804.4186 by direct SQL over the raw tables (the
middle of 1,429 customers: monetary 809,894.90, 4 orders, tenure 2,047 days);
FIXTURES.md prints 57,804.4086 there.
"""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from tidemark.operators import evaluation, segments
from tidemark.plans.catalog import plan_for

ANCHORS = {
    SMALL: {
        "orders": 493, "customers": 145, "value": 105_529_153.40, "unknown": 9, "vouchers": 85,
        "snapshot": date(2001, 8, 2), "cohorts": (366, 57, 78, 484), "gaps": (348, 0, 367.5, 478.7356),
        "threshold": 735, "churn_rate": 0.344828, "split": {"train": 112, "holdout": 22, "immature": 11},
        "windows": (24, 17), "median_clv": 56_826.0917, "quadrants": [30, 43, 41, 31], "auc": 0.943368,
        "raw_threshold": 0.649299, "pool_date": date(2001, 2, 3), "arms": (22, 16, 8, 4),
    },
    MEDIUM: {
        "orders": 4933, "customers": 1429, "value": 1_053_352_502.57, "unknown": 74, "vouchers": 837,
        "snapshot": date(2001, 8, 1), "cohorts": (1930, 79, 78, 4842), "gaps": (3504, 1, 341.0, 464.6486),
        "threshold": 682, "churn_rate": 0.348495, "split": {"train": 1147, "holdout": 193, "immature": 89},
        "windows": (192, 202), "median_clv": 57_804.4186, "quadrants": [314, 401, 372, 342], "auc": 0.937993,
        "raw_threshold": 0.641361, "pool_date": date(2001, 2, 2), "arms": (175, 137, 44, 26),
    },
}


@pytest.fixture(scope="module", params=[SMALL, MEDIUM], ids=["sf0.001", "sf0.01"])
def case(spark, request):
    plan = plan_for(spark, request.param)
    yield plan.on_staged_fact(), ANCHORS[request.param]
    plan.workspace.close()


def test_facts(case):
    plan, anchor = case
    row = plan.full_fact.agg(
        F.count("*"),
        F.count_distinct("customer_unique_id"),
        F.sum("order_cents") / 100,
        F.count_if(F.col("category") == "unknown"),
        F.sum("used_voucher"),
    ).first()
    names = ("orders", "customers", "value", "unknown", "vouchers")
    assert tuple(row) == pytest.approx(tuple(anchor[n] for n in names))


def test_cohorts_and_gaps(case):
    plan, anchor = case
    row = plan.cohort_retention.agg(
        F.count("*"), F.count_distinct("cohort_month"), F.max("period_diff"), F.sum("active_customers")
    ).first()
    assert tuple(row) == anchor["cohorts"]
    stats = plan.gap_stats.first()
    n_gaps, same_day, median, mean = anchor["gaps"]
    assert (stats.n_gaps, stats.n_gaps - stats.n_positive, stats.median_gap) == (n_gaps, same_day, median)
    assert stats.mean_gap == pytest.approx(mean, abs=1e-4)
    scalars = plan.run_scalars.first()
    assert (scalars.churn_threshold, scalars.snapshot_date) == (anchor["threshold"], anchor["snapshot"])


def test_customers(case):
    plan, anchor = case
    summary = {r["split"]: r for r in segments.split_summary(plan.split).collect()}
    assert {s: summary[s].customers for s in anchor["split"]} == anchor["split"]
    assert summary["all"].churn_rate == pytest.approx(anchor["churn_rate"], abs=1e-6)
    windows = plan.window_metrics.agg(F.sum("freq_recent"), F.sum("freq_prior")).first()
    assert tuple(windows) == anchor["windows"]


def test_segments_and_scores(case):
    plan, anchor = case
    summary = segments.quadrant_summary(plan.segments).collect()
    assert [r.customer_count for r in summary] == anchor["quadrants"]
    median = plan.workspace.spark.range(1).select(plan.median_clv).first()[0]
    assert median == pytest.approx(anchor["median_clv"], abs=1e-4)
    assert evaluation.roc_auc(plan.score_totals).first().auc == pytest.approx(anchor["auc"], abs=1e-6)
    chosen = evaluation.operating_threshold(evaluation.pr_curve(plan.score_totals), plan.params).first()
    assert chosen.raw_threshold == pytest.approx(anchor["raw_threshold"], abs=1e-6)


def test_experiment(case):
    plan, anchor = case
    assert plan.as_of_pool_date() == anchor["pool_date"]
    result = plan.readout(anchor["pool_date"]).first()
    got = (result.n_treatment, result.n_control, result.retained_treatment, result.retained_control)
    assert got == anchor["arms"]
