"""The retention analysis as a graph of lazy tables over one set of inputs.

Every attribute is a DataFrame. Those that later steps read more than once and
that are costly to compute again are staged (see Workspace); all others stay
lazy, so a caller pays only for what the requested table needs.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import (
    cohorts,
    customers,
    evaluation,
    experiment,
    facts,
    gaps,
    model,
    ranking,
    segments,
)
from tidemark.params import Params
from tidemark.sources.shop import ShopTables
from tidemark.workspace import Workspace


_ORDER_COLUMNS = ["order_id", "customer_unique_id", "order_purchase_timestamp", "order_date"]


class RetentionPlan:
    """as_of limits every statistic to orders up to and including that day.

    built_fact is an order fact (with voucher flag) that already exists, such as
    a written table; without it each table is computed from the inputs.
    """

    def __init__(
        self,
        tables: ShopTables,
        params: Params,
        workspace: Workspace,
        as_of: date | None = None,
        built_fact: DataFrame | None = None,
    ):
        self.tables = tables
        self.params = params
        self.workspace = workspace
        self.as_of = as_of
        self.built_fact = built_fact

    def on_staged_fact(self) -> "RetentionPlan":
        """The same plan over a fact written once: for runs that need many tables."""
        staged = self.workspace.stage(self.full_fact, "order-fact")
        plan = RetentionPlan(self.tables, self.params, self.workspace, self.as_of, staged)
        plan.run_scalars = self.workspace.stage(plan.run_scalars, "run-scalars")
        return plan

    # Orders

    @cached_property
    def placed(self) -> DataFrame:
        return facts.placed_orders(self.tables.orders, self.params.completed_status, self.as_of)

    @cached_property
    def orders(self) -> DataFrame:
        """Completed orders with customer and date only: no basket, no category."""
        if self.built_fact is not None:
            return self.built_fact.select(*_ORDER_COLUMNS)
        return facts.with_customer(self.placed, self.tables.customers)

    def fact_with(self, value=False, category=False, voucher=False) -> DataFrame:
        """The order fact with just the parts a table needs."""
        if self.built_fact is not None:
            return self.built_fact
        return facts.customer_order_fact(
            self.placed, self.tables, self.params, value, category, voucher
        )

    @property
    def full_fact(self) -> DataFrame:
        return self.fact_with(value=True, category=True, voucher=True)

    @property
    def order_fact(self) -> DataFrame:
        return facts.present_fact(self.fact_with(value=True, category=True))

    @property
    def order_value(self) -> DataFrame:
        return facts.order_value(self.tables.items)

    @property
    def order_category(self) -> DataFrame:
        return facts.order_category(
            self.tables.items,
            self.tables.products,
            self.tables.translation,
            self.params.unknown_category,
            self.params.category_pick,
        )

    # Cohorts

    @property
    def first_purchase(self) -> DataFrame:
        return cohorts.first_purchase(self.orders)

    @property
    def cohort_activity(self) -> DataFrame:
        return cohorts.cohort_activity(self.orders)

    @property
    def cohort_sizes(self) -> DataFrame:
        return cohorts.cohort_sizes(self.orders)

    @property
    def cohort_retention(self) -> DataFrame:
        return cohorts.cohort_retention(self.orders)

    def cohort_pivot(self, first: date | None = None, last: date | None = None) -> DataFrame:
        return cohorts.cohort_pivot(
            self.cohort_retention, self.workspace, self.params.pivot_periods, first, last
        )

    def acquisition_by_month(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """From the sizes alone: the same months as in the retention table."""
        return cohorts.acquisition_by_month(cohorts.cohort_range(self.cohort_sizes, first, last))

    # Gaps and run scalars

    @cached_property
    def customer_days(self) -> DataFrame:
        return gaps.customer_days(self.orders)

    @property
    def purchase_gaps(self) -> DataFrame:
        return gaps.purchase_gaps(self.customer_days)

    @property
    def gap_stats(self) -> DataFrame:
        return gaps.gap_summary(self.customer_days)

    @cached_property
    def run_scalars(self) -> DataFrame:
        return gaps.run_scalars(self.gap_stats, self.params, self.as_of)

    @cached_property
    def scalars(self) -> Column:
        return gaps.as_scalar(self.run_scalars)

    @cached_property
    def snapshot(self) -> Column:
        """Snapshot date alone, for the tables that need no gaps. Starts no job."""
        if self.as_of is not None:
            return F.lit(self.as_of + timedelta(days=1))
        return self.last_order.select(F.date_add("last_date", 1)).scalar()

    @cached_property
    def last_order(self) -> DataFrame:
        """One row: the day of the last order of a known customer, lazily.

        Joining all orders with the customers for a maximum would shuffle them all. The
        newest order by the scan alone is an upper bound; it is the answer if an order of that
        day has a known customer, and only otherwise rows reach the whole join.
        """
        last = F.max("order_date").alias("last_date")
        if self.built_fact is not None:
            return self.orders.agg(last)
        newest = self.placed.agg(F.to_date(F.max("order_purchase_timestamp"))).scalar()
        of_that_day = self.placed.filter(F.to_date("order_purchase_timestamp") == newest)
        near = facts.with_customer(of_that_day, self.tables.customers).agg(F.max("order_date")).scalar()
        unknown = near.isNull()
        exact = facts.with_customer(self.placed.filter(unknown), self.tables.customers.filter(unknown)).agg(last)
        return exact.select(F.coalesce("last_date", near).alias("last_date"))

    # Customers

    @property
    def rfm(self) -> DataFrame:
        return customers.rfm(customers.rfm_totals(self.fact_with(value=True)), self.snapshot)

    @property
    def window_metrics(self) -> DataFrame:
        fact = self.fact_with(value=True, category=True)
        return customers.window_metrics(customers.customer_rollup(fact, self.snapshot, self.params))

    @property
    def voucher_dependency(self) -> DataFrame:
        return customers.voucher_dependency(self.fact_with(voucher=True))

    @property
    def avg_gap(self) -> DataFrame:
        return customers.avg_gap(self.customer_days, self.scalars.getField("median_gap"))

    @property
    def churn_label(self) -> DataFrame:
        return customers.churn_label(self.customer_days, self.scalars)

    @cached_property
    def features(self) -> DataFrame:
        rollup = customers.customer_rollup(
            self.full_fact, self.scalars.getField("snapshot_date"), self.params
        )
        return customers.customer_features(rollup, self.scalars)

    @property
    def customer_features(self) -> DataFrame:
        return self.features.drop("first_purchase_date")

    @property
    def feature_profile(self) -> DataFrame:
        return customers.feature_profile(self.features)

    @cached_property
    def split(self) -> DataFrame:
        return segments.maturity_split(self.features, self.params.split_date, self.scalars)

    @cached_property
    def profile(self) -> DataFrame:
        """Features, split, CLV and model-free risk of every customer, lazily."""
        valued = segments.clv(self.split, self.scalars.getField("snapshot_date"), self.params)
        return segments.recency_risk(valued)

    @cached_property
    def staged_profile(self) -> DataFrame:
        return self.workspace.stage(self.profile, "profile")

    # Segments

    @cached_property
    def median_clv(self) -> Column:
        return ranking.exact_median(self.staged_profile, "clv").scalar()

    @cached_property
    def segments(self) -> DataFrame:
        return segments.resegment(
            self.staged_profile, self.params.risk_threshold, self.median_clv
        )

    def segments_of(self, scores: DataFrame, threshold: Column | float) -> DataFrame:
        """Segments by supplied scores (customer_unique_id, churn_probability); without a score the risk is low."""
        scored = self.staged_profile.drop("churn_probability").join(
            scores.select("customer_unique_id", "churn_probability"), "customer_unique_id", "left"
        )
        return segments.resegment(scored, threshold, self.median_clv)

    # Evaluation of the model-free score

    @property
    def holdout(self) -> DataFrame:
        return self.profile.filter(F.col("split") == "holdout")

    @cached_property
    def score_totals(self) -> DataFrame:
        return evaluation.score_totals(self.profile, self.workspace)

    @property
    def confusion_matrix(self) -> DataFrame:
        predicted = evaluation.predict(self.holdout, self.params.risk_threshold)
        return evaluation.confusion_matrix(predicted)

    @property
    def threshold_sweep(self) -> DataFrame:
        return evaluation.threshold_sweep(self.staged_profile, self.median_clv, self.params)

    # Models

    @cached_property
    def models(self) -> model.ChurnModels:
        return model.churn_models(self.staged_profile, self.params, self.workspace)

    def model_evaluation(self, scores: DataFrame) -> DataFrame:
        """Running totals of a model's scores on the holdout."""
        return evaluation.score_totals(
            scores.filter(F.col("split") == "holdout"), self.workspace
        )

    def register_views(self) -> None:
        """The SQL names under which analysts know the tables of the first step."""
        views = {
            "customer_order_fact": self.order_fact,
            "cohort_retention": self.cohort_retention,
            "rfm_table": self.rfm,
            "customer_purchase_gaps": self.purchase_gaps,
        }
        for name, frame in views.items():
            frame.createOrReplaceTempView(name)

    # Experiment

    def last_order_date(self) -> date | None:
        """One value on the driver: later plans use it as a literal the scan can see."""
        return self.last_order.first()[0]

    def as_of_pool_date(self) -> date:
        snapshot = self.last_order_date() + timedelta(days=1)
        return snapshot - timedelta(days=self.params.outcome_days)

    def plan_at(self, day: date, **changes) -> "RetentionPlan":
        fact = self.built_fact
        if fact is not None:
            fact = fact.filter(F.col("order_date") <= F.lit(day))
        params = replace(self.params, **changes)
        return RetentionPlan(self.tables, params, self.workspace, day, fact)

    def orders_between(self, after: date, until: date) -> DataFrame:
        """Orders with after < date <= until."""
        if self.built_fact is not None:
            day = F.col("order_date")
            return self.orders.filter((day > F.lit(after)) & (day <= F.lit(until)))
        placed = facts.placed_orders(
            self.tables.orders, self.params.completed_status, as_of=until, after=after
        )
        return facts.with_customer(placed, self.tables.customers)

    def assignment(self, pool_date: date, segmented: DataFrame | None = None) -> DataFrame:
        """Win-back customers as of the pool date with their arm.

        segmented holds the segments of that day by any score; without it the model-free
        score decides.
        """
        of_day = segmented if segmented is not None else self.plan_at(pool_date).segments
        pool = segments.in_segment(of_day, segments.WIN_BACK)
        return experiment.assign_arms(pool, self.params.arm_salt, self.params.treatment_pct).select(
            "customer_unique_id", "clv", "arm"
        )

    def outcomes(self, pool_date: date, assigned: DataFrame | None = None) -> DataFrame:
        """Observed outcomes in the horizon after the pool date.

        assigned (customer_unique_id, clv, arm) may come from a real campaign.
        """
        until = pool_date + timedelta(days=self.params.outcome_days)
        arms = assigned if assigned is not None else self.assignment(pool_date)
        return experiment.observed_outcomes(arms, self.orders_between(pool_date, until))

    def readout(self, pool_date: date, assigned: DataFrame | None = None) -> DataFrame:
        counts = experiment.arm_counts(self.outcomes(pool_date, assigned))
        return experiment.readout(counts, self.params)
