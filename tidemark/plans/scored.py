"""One set of scores and everything that hangs on it, as of its plan's day."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import evaluation, segments
from tidemark.plans.retention import RetentionPlan


class ScoredRun:
    """Threshold, segments, sweep, live metrics and arms by one score.

    Without supplied scores the plan's forest is fitted on the features of the plan's day and
    scores the profile in place: with `plan.plan_at(day)` features, labels, fit, threshold and
    segments all know nothing after that day. Supplied scores (customer_unique_id,
    churn_probability) are joined to the plan's customers; one without a score is low risk and
    in no curve. Without a threshold the operating threshold of the holdout decides.
    """

    def __init__(self, plan: RetentionPlan, scores: DataFrame | None = None, threshold: Column | float | None = None):
        self.plan, self.supplied, self._threshold = plan, scores, threshold

    @cached_property
    def scored(self) -> DataFrame:
        """The staged profile with this run's churn_probability."""
        if self.supplied is None:
            return self.plan.workspace.stage(self.plan.models.scored(self.plan.models.forest), "scored")
        scores = self.supplied.select("customer_unique_id", "churn_probability")
        profile = self.plan.staged_profile.drop("churn_probability")
        return self.plan.workspace.stage(profile.join(scores, "customer_unique_id", "left"), "scored")

    @cached_property
    def totals(self) -> DataFrame:
        judged = self.scored.filter((F.col("split") == "holdout") & F.col("churn_probability").isNotNull())
        return evaluation.score_totals(judged, self.plan.workspace)

    @cached_property
    def chosen(self) -> DataFrame:
        """The staged row of the operating threshold."""
        curve = evaluation.pr_curve(self.totals)
        return self.plan.workspace.stage(
            evaluation.operating_threshold(curve, self.plan.params), "operating-threshold")

    @cached_property
    def threshold(self) -> Column | float:
        return self.chosen.select("threshold").scalar() if self._threshold is None else self._threshold

    @cached_property
    def segments(self) -> DataFrame:
        return segments.resegment(self.scored, self.threshold, self.plan.median_clv)

    @property
    def threshold_sweep(self) -> DataFrame:
        return evaluation.threshold_sweep(self.scored, self.plan.median_clv, self.plan.params)

    @property
    def live_metrics(self) -> DataFrame:
        return evaluation.live_metrics(self.scored, self.threshold)

    def assignment(self) -> DataFrame:
        """Arms over this run's win-back segment."""
        return self.plan.assignment(self.plan.as_of, self.segments)
