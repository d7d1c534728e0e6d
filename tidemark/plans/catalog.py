"""Every registered query: a name and a function (spark, folder) -> DataFrame.

Each call builds its own plan over the whole tables of the folder. Dates leave
as ISO text; floating sums and means, whose last digits depend on the order of
addition, are rounded. Everything computed row by row leaves as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import iso_date, iso_seconds
from tidemark.operators import certificates, cohorts, evaluation, experiment, model, segments
from tidemark.plans.retention import RetentionPlan
from tidemark.plans.scored import ScoredRun
from tidemark.session import tune
from tidemark.sinks import write_document
from tidemark.sources.csv_folder import ROLES, load_csv_folder
from tidemark.sources.documents import read_document
from tidemark.sources.shop import ShopTables
from tidemark.sources.star import star_params, star_tables
from tidemark.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

REPORT_FIRST_MONTH = date(1995, 6, 1)
REPORT_LAST_MONTH = date(1998, 12, 1)


def plan_for(spark: SparkSession, folder: str) -> RetentionPlan:
    tune(spark)
    return RetentionPlan(star_tables(spark, folder), star_params(), Workspace(spark))


def _rounded(frame: DataFrame, digits: int, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


def _dated(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: iso_date(F.col(c)) for c in columns})


def _timed(frame: DataFrame, column: str) -> DataFrame:
    return frame.withColumn(column, iso_seconds(F.col(column)))


def order_value(plan: RetentionPlan) -> DataFrame:
    return plan.order_value


def order_category(plan: RetentionPlan) -> DataFrame:
    return plan.order_category


def order_fact(plan: RetentionPlan) -> DataFrame:
    return _dated(_timed(plan.order_fact, "order_purchase_timestamp"), "order_date")


def _reloaded(plan: RetentionPlan) -> ShopTables:
    """All six tables written whole as CSV and loaded back as a folder."""
    path = f"{plan.workspace.path}/csv"
    files = {}
    for role in ROLES:
        files[role] = f"{role}.csv"
        getattr(plan.tables, role).write.option("header", True).csv(f"{path}/{role}.csv")
    return load_csv_folder(plan.workspace.spark, path, files=files)


def csv_reload(plan: RetentionPlan) -> DataFrame:
    """Every order, whatever its status, after a round trip through CSV."""
    orders = _reloaded(plan).orders
    return _timed(
        orders.withColumns({c: F.col(c).cast("bigint") for c in ("order_id", "customer_id")}),
        "order_purchase_timestamp",
    )


def csv_reload_rows(plan: RetentionPlan) -> DataFrame:
    """Rows of each of the six tables after the round trip, and a checksum of their keys."""
    reloaded = _reloaded(plan)
    keys = {
        "orders": "order_id", "customers": "customer_id", "items": "order_id", "products": "product_id",
        "translation": None, "payments": "order_id",
    }
    counts = [
        getattr(reloaded, role).agg(
            F.count("*").alias("n_rows"), (F.sum(F.col(key).cast("bigint")) if key else F.lit(0)).cast("bigint").alias("key_sum")
        ).select(F.lit(role).alias("role"), "n_rows", "key_sum")
        for role, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def metadata_reload(plan: RetentionPlan) -> DataFrame:
    """The run metadata written as a JSON document and read back."""
    path = f"{plan.workspace.path}/metadata.json"
    write_document(_dated(plan.run_scalars.drop("median_gap"), "snapshot_date"), path)
    return read_document(plan.workspace.spark, path, schemas.RUN_METADATA)


def sales_by_category(plan: RetentionPlan) -> DataFrame:
    """SQL over the registered fact view."""
    plan.register_views()
    totals = plan.workspace.spark.sql(
        """SELECT category, count(*) AS orders, round(sum(order_value), 2) AS total_value
           FROM customer_order_fact GROUP BY category"""
    )
    return totals


def output_rows(plan: RetentionPlan) -> DataFrame:
    """Row count of each output table of the relational step."""
    staged = plan.on_staged_fact()
    tables = {
        "cohort_retention": staged.cohort_retention,
        "customer_order_fact": staged.order_fact,
        "customer_purchase_gaps": staged.purchase_gaps,
        "rfm_table": staged.rfm,
    }
    counts = [
        frame.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def first_purchase(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.first_purchase, "first_purchase_date", "cohort_month")


def cohort_activity(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.cohort_activity, "cohort_month", "activity_month")


def cohort_sizes(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.cohort_sizes, "cohort_month")


def cohort_retention(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.cohort_retention, "cohort_month")


def cohort_pivot(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.cohort_pivot(REPORT_FIRST_MONTH, REPORT_LAST_MONTH), "cohort_month")


def acquisition_by_month(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.acquisition_by_month(REPORT_FIRST_MONTH, REPORT_LAST_MONTH), "cohort_month")


def rfm(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.rfm, "last_order_date")


def purchase_gaps(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.purchase_gaps, "order_date", "prev_order_date")


def gap_stats(plan: RetentionPlan) -> DataFrame:
    return _rounded(plan.gap_stats.drop("last_date"), 6, "mean_gap")


def run_scalars(plan: RetentionPlan) -> DataFrame:
    return _dated(plan.run_scalars.drop("median_gap"), "snapshot_date")


def avg_gap(plan: RetentionPlan) -> DataFrame:
    return plan.avg_gap


def window_metrics(plan: RetentionPlan) -> DataFrame:
    return plan.window_metrics


def voucher_dependency(plan: RetentionPlan) -> DataFrame:
    return plan.voucher_dependency


def churn_label(plan: RetentionPlan) -> DataFrame:
    return plan.churn_label


def customer_features(plan: RetentionPlan) -> DataFrame:
    return plan.customer_features


def feature_profile(plan: RetentionPlan) -> DataFrame:
    return _rounded(plan.feature_profile, 4, "mean", "std", "min", "max")


def maturity_split(plan: RetentionPlan) -> DataFrame:
    return _rounded(segments.split_summary(plan.split), 6, "churn_rate")


def class_weights(plan: RetentionPlan) -> DataFrame:
    weights = model.class_weights(plan.split.filter(F.col("split") == "train"))
    return _rounded(weights, 6, "weight")


def scaled_profile(plan: RetentionPlan) -> DataFrame:
    profile = model.scaled_profile(plan.staged_profile)
    return _rounded(profile, 6, "mean", "std", "min", "max").withColumn("mean", F.col("mean") + 0.0)


def clv(plan: RetentionPlan) -> DataFrame:
    return plan.profile.select("customer_unique_id", "aov", "tenure_days", "annual_frequency", "clv")


def quadrants(plan: RetentionPlan) -> DataFrame:
    return plan.segments.select(
        "customer_unique_id",
        "churn_probability",
        "clv",
        "quadrant",
        "risk_tier",
        "value_tier",
    )


def quadrant_summary(plan: RetentionPlan) -> DataFrame:
    summary = segments.quadrant_summary(plan.segments)
    return _rounded(
        _rounded(summary, 2, "total_clv", "avg_clv"), 4, "avg_churn_probability", "share_pct"
    )


def quadrant_sizes(plan: RetentionPlan) -> DataFrame:
    return _rounded(segments.quadrant_sizes(plan.segments), 2, "total_clv")


def quadrant_display(plan: RetentionPlan) -> DataFrame:
    return segments.quadrant_display(segments.quadrant_summary(plan.segments))


def action_table(plan: RetentionPlan) -> DataFrame:
    return segments.action_table(plan.segments)


def risk_kpis(plan: RetentionPlan) -> DataFrame:
    kpis = segments.risk_kpis(plan.segments).withColumn("median_clv", plan.median_clv)
    return _rounded(kpis, 2, "clv_at_risk", "avg_clv", "median_clv")


def crm_export(plan: RetentionPlan) -> DataFrame:
    return segments.crm_export(plan.segments, segments.WIN_BACK)


def segment_sample(plan: RetentionPlan) -> DataFrame:
    sample = segments.segment_sample(
        plan.segments, plan.params.sample_size, plan.params.sample_seed
    )
    return sample.select(
        "customer_unique_id",
        "churn_probability",
        "clv",
        "quadrant",
        "recency",
        "frequency",
        "monetary",
    )


def confusion_matrix(plan: RetentionPlan) -> DataFrame:
    return plan.confusion_matrix


def classification_report(plan: RetentionPlan) -> DataFrame:
    report = evaluation.classification_report(plan.confusion_matrix)
    return _rounded(report, 6, "precision", "recall", "f1")


def roc_auc(plan: RetentionPlan) -> DataFrame:
    return _rounded(evaluation.roc_auc(plan.score_totals), 6, "auc")


def pr_curve(plan: RetentionPlan) -> DataFrame:
    return evaluation.pr_curve(plan.score_totals)


def operating_threshold(plan: RetentionPlan) -> DataFrame:
    chosen = evaluation.operating_threshold(evaluation.pr_curve(plan.score_totals), plan.params)
    return chosen


def threshold_sweep(plan: RetentionPlan) -> DataFrame:
    return _rounded(plan.threshold_sweep, 2, "clv_at_risk")


def live_metrics(plan: RetentionPlan) -> DataFrame:
    return evaluation.live_metrics(plan.profile, plan.params.risk_threshold)


def ab_assign(plan: RetentionPlan) -> DataFrame:
    return plan.assignment(plan.as_of_pool_date()).select("customer_unique_id", "arm")


def ab_outcome(plan: RetentionPlan) -> DataFrame:
    outcomes = plan.outcomes(plan.as_of_pool_date())
    return outcomes.select("customer_unique_id", "arm", "retained")


_READOUT_RATIOS = (
    "rate_treatment", "rate_control", "lift", "z_stat", "ci_lower", "ci_upper",
    "err_treatment", "err_control",
)


def experiment_readout(plan: RetentionPlan) -> DataFrame:
    result = experiment.with_p_value(plan.readout(plan.as_of_pool_date()))
    return _rounded(result.drop("avg_clv"), 6, *_READOUT_RATIOS, "p_value")


def campaign_roi(plan: RetentionPlan) -> DataFrame:
    roi = experiment.campaign_roi(plan.readout(plan.as_of_pool_date()), plan.params)
    money = ("avg_clv", "total_cost", "incremental_saved", "clv_protected", "net_profit", "roi")
    return _rounded(roi.select("cost_per_cust", *money), 4, *money)


def model_reports(plan: RetentionPlan) -> DataFrame:
    """Classification report of both models on the holdout, at their thresholds."""
    models = plan.models
    forest = models.forest_scores()
    curve = evaluation.pr_curve(plan.model_evaluation(forest))
    threshold = evaluation.operating_threshold(curve, plan.params).select("threshold").scalar()
    scored = {
        "logistic": evaluation.predict(models.logistic_scores(), plan.params.lr_threshold),
        "forest": evaluation.predict(forest, threshold),
    }
    reports = []
    for name, predicted in scored.items():
        matrix = evaluation.confusion_matrix(predicted.filter(F.col("split") == "holdout"))
        report = evaluation.classification_report(matrix)
        reports.append(report.select(F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, reports)


def model_coefficients(plan: RetentionPlan) -> DataFrame:
    return plan.models.coefficients()


def model_importances(plan: RetentionPlan) -> DataFrame:
    return plan.models.importances()


def churn_scores(plan: RetentionPlan) -> DataFrame:
    models = plan.models
    forest = models.forest_scores()
    totals = plan.model_evaluation(forest)
    chosen = evaluation.operating_threshold(evaluation.pr_curve(totals), plan.params)
    return evaluation.predict(forest, chosen.select("threshold").scalar())


def model_quality(plan: RetentionPlan) -> DataFrame:
    """Holdout AUC of both models, and the forest's operating point."""
    models = plan.models
    logistic = evaluation.roc_auc(plan.model_evaluation(models.logistic_scores()))
    forest_totals = plan.model_evaluation(models.forest_scores())
    forest = evaluation.roc_auc(forest_totals)
    chosen = evaluation.operating_threshold(evaluation.pr_curve(forest_totals), plan.params)
    return chosen.select(
        logistic.select("auc").scalar().alias("lr_auc"),
        forest.select("auc").scalar().alias("rf_auc"),
        F.col("threshold").alias("selected_rf_threshold"),
        "precision",
        "recall",
    )


def active_customers_estimate(plan: RetentionPlan) -> DataFrame:
    """Customers active per month from merged sketches beside the exact count, and whether they agree to 2 %."""
    activity = plan.workspace.stage(plan.cohort_activity, "activity")
    sketches = plan.workspace.stage(cohorts.activity_sketches(activity), "sketches")
    exact = activity.groupBy("activity_month").agg(F.count_distinct("customer_unique_id").alias("active_customers"))
    off = F.abs(F.col("customers") - F.col("active_customers"))
    both = exact.join(cohorts.estimated_customers(sketches, "activity_month"), "activity_month")
    return _dated(both, "activity_month").select(
        "activity_month", "active_customers", (off <= 0.02 * F.col("active_customers")).cast("int").alias("within_2_pct"))


def _supplied_scores(plan: RetentionPlan) -> DataFrame:
    """Stand-in input: scores as another system would deliver them, none for every tenth customer."""
    key = F.col("customer_unique_id")
    return plan.tables.customers.filter(key % 10 != 0).select(
        "customer_unique_id", ((key * 7919) % 1000 / F.lit(1000.0)).alias("churn_probability"))


def _supplied(plan: RetentionPlan) -> ScoredRun:
    return ScoredRun(plan, _supplied_scores(plan), plan.params.risk_threshold)


def supplied_sweep(plan: RetentionPlan) -> DataFrame:
    """The threshold sweep on supplied scores."""
    return _rounded(_supplied(plan).threshold_sweep, 2, "clv_at_risk")


def supplied_live_metrics(plan: RetentionPlan) -> DataFrame:
    return _supplied(plan).live_metrics


def supplied_ab_assign(plan: RetentionPlan) -> DataFrame:
    """Arms over the win-back segment by supplied scores, as of the pool date."""
    return _supplied(plan.plan_at(plan.as_of_pool_date())).assignment().select("customer_unique_id", "arm")


def scored_customers(plan: RetentionPlan) -> DataFrame:
    """Per split the customers that both models score, and whether every score lies in [0, 1]."""
    models = plan.models
    scores = models.forest_scores().select("split", F.col("churn_probability").alias("forest")).unionByName(
        models.logistic_scores().select("split", F.col("churn_probability").alias("forest")))
    fits = F.coalesce(F.col("forest").between(0.0, 1.0), F.lit(False))
    return scores.groupBy("split").agg(
        (F.count("*") / 2).cast("bigint").alias("customers"), F.min(fits.cast("int")).alias("in_range"))


def logistic_optimality(plan: RetentionPlan) -> DataFrame:
    """Gradient of the penalised loss at the fit, over the training rows, and whether coefficients come by size."""
    models = plan.models
    listed = models.coefficients().collect()  # one row per feature
    sizes = [abs(row.coefficient) for row in listed]
    sorted_here = {row.feature: int(k == 0 or sizes[k - 1] >= sizes[k]) for k, row in enumerate(listed)}
    order = F.create_map(*[F.lit(x) for pair in sorted_here.items() for x in pair])
    gradient = certificates.logistic_gradient(models)
    return gradient.select(
        "term", "n", (F.round("gradient", 6) + 0.0).alias("gradient"), F.coalesce(order[F.col("term")], F.lit(1)).alias("by_size"))


def _differences(found: DataFrame) -> DataFrame:
    return found.select("measure", (F.round("difference", 6) + 0.0).alias("difference"))


def forest_recount(plan: RetentionPlan) -> DataFrame:
    """A forest whose trees see all training rows, against a count of these rows."""
    whole = replace(plan.params, tree_bootstrap=False)
    return _differences(certificates.forest_recount(model.churn_models(plan.staged_profile, whole, plan.workspace)))


def score_recount(plan: RetentionPlan) -> DataFrame:
    """The production forest's scores and importances against walks through its node table."""
    return _differences(certificates.score_recount(plan.models))


PLAN_QUERIES = [
    order_value, order_category, order_fact, csv_reload, csv_reload_rows, metadata_reload, sales_by_category,
    output_rows, first_purchase, cohort_activity, cohort_sizes,
    cohort_retention, cohort_pivot, acquisition_by_month, rfm, purchase_gaps, gap_stats,
    run_scalars, avg_gap, window_metrics, voucher_dependency, churn_label, customer_features,
    feature_profile, maturity_split, class_weights, scaled_profile, clv, quadrants,
    quadrant_summary, quadrant_sizes, quadrant_display, action_table, risk_kpis, crm_export,
    segment_sample, confusion_matrix, classification_report, roc_auc, pr_curve,
    operating_threshold, threshold_sweep, live_metrics, ab_assign, ab_outcome,
    experiment_readout, campaign_roi, model_coefficients, model_importances, churn_scores,
    model_quality, model_reports, supplied_sweep, supplied_live_metrics, supplied_ab_assign, scored_customers,
    logistic_optimality, forest_recount, score_recount, active_customers_estimate,
]


def _query(build) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(plan_for(spark, folder))

    run.__name__ = build.__name__
    return run


def registered() -> dict[str, Query]:
    return {build.__name__: _query(build) for build in PLAN_QUERIES}
