"""The whole analysis in one run: every table and document written to a folder.

    python -m tidemark.plans.batch --input <csv folder> --output <folder>

The order fact is written once and everything else reads it.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import iso_date
from tidemark.operators import evaluation, experiment, segments
from tidemark.operators.customers import FEATURE_COLUMNS
from tidemark.params import Params
from tidemark.plans.retention import RetentionPlan
from tidemark.plans.scored import ScoredRun
from tidemark.session import tune
from tidemark.sinks import write_csv, write_document, write_table
from tidemark.sources import ShopTables, load_csv_folder
from tidemark.workspace import Workspace

SCORE_COLUMNS = ["first_purchase_date", "churn_probability", "churn_prediction"]
SEGMENT_COLUMNS = ["clv", "quadrant", "risk_tier", "value_tier"]


def _model_metrics(run: ScoredRun) -> DataFrame:
    """One row in the shape of schemas.MODEL_METRICS."""
    plan, models, params = run.plan, run.plan.models, run.plan.params
    logistic = models.logistic_scores()
    holdout = F.col("split") == "holdout"
    lr_pairs = evaluation.predict(logistic.filter(holdout), params.lr_threshold)
    rf_pairs = evaluation.predict(run.scored.filter(holdout), run.threshold)

    def auc(totals: DataFrame):
        return evaluation.roc_auc(totals).select("auc").scalar()

    def matrix(pairs: DataFrame):
        return evaluation.matrix_array(evaluation.confusion_matrix(pairs)).scalar()

    def listed(frame: DataFrame, value: str):
        ordered = F.sort_array(F.collect_list(F.struct(F.abs(value).alias("size"), "feature", value)), False)
        pairs = F.transform(ordered, lambda item: item.dropFields("size"))
        return frame.agg(pairs).scalar()

    return plan.workspace.spark.range(1).select(
        auc(plan.model_evaluation(logistic)).alias("lr_auc"),
        auc(run.totals).alias("rf_auc"),
        run.threshold.alias("selected_rf_threshold"),
        listed(models.coefficients(), "coefficient").alias("lr_coefs"),
        listed(models.importances(), "importance").alias("rf_importances"),
        matrix(lr_pairs).alias("lr_confusion_matrix"),
        matrix(rf_pairs).alias("rf_confusion_matrix"),
        models.scaled.filter(holdout).agg(F.count("*")).scalar().alias("test_size"),
        F.lit(models.train_size).cast("bigint").alias("train_size"),
    )


def experiment_results(outcomes: DataFrame, params: Params) -> DataFrame:
    """One row in the shape of schemas.EXPERIMENT_RESULTS, from the pool with arms and outcomes."""
    counts = experiment.arm_counts(outcomes)
    result = experiment.campaign_roi(experiment.with_p_value(experiment.readout(counts, params)), params)
    return result.select(*[field.name for field in schemas.EXPERIMENT_RESULTS.fields])


def run_batch(
    spark: SparkSession,
    tables: ShopTables,
    output: str,
    params: Params,
    pool_date: date | None = None,
    assignment: DataFrame | None = None,
) -> dict[str, int]:
    """Write all outputs below the folder; returns the row count of each table.

    pool_date and assignment (customer_unique_id, clv, arm) describe a campaign
    that took place; without an assignment the arms are hashed over the win-back segment of
    the model as of the pool date (by default one outcome horizon before the snapshot):
    features, labels, fit and threshold of that day, written with the pool.
    """
    tune(spark)
    rows: dict[str, int] = {}
    with Workspace(spark) as workspace:
        plan = RetentionPlan(tables, params, workspace).on_staged_fact()

        # Relational step
        rows["customer_order_fact"] = write_table(plan.order_fact, f"{output}/customer_order_fact")
        rows["cohort_retention"] = write_csv(
            plan.cohort_retention, f"{output}/cohort_retention.csv", single_file=True
        )
        rows["rfm_table"] = write_csv(plan.rfm, f"{output}/rfm_table.csv")
        rows["customer_purchase_gaps"] = write_table(
            plan.purchase_gaps, f"{output}/customer_purchase_gaps"
        )

        # Features and run scalars
        metadata = plan.run_scalars.select(
            F.col("churn_threshold").cast("bigint"), iso_date(F.col("snapshot_date")).alias("snapshot_date")
        )
        write_document(metadata, f"{output}/metadata.json")
        features = plan.staged_profile.select("customer_unique_id", *FEATURE_COLUMNS, "churn")
        rows["customer_features"] = write_csv(features, f"{output}/customer_features.csv", staged=True)

        # Models and scores
        run = ScoredRun(plan)
        write_document(_model_metrics(run), f"{output}/model_metrics.json")
        predicted = evaluation.predict(run.segments, run.threshold)
        segmented = workspace.stage(
            predicted.select(*features.columns, *SCORE_COLUMNS, *SEGMENT_COLUMNS), "segments"
        )
        rows["customer_features_with_predictions"] = write_csv(
            segmented.drop(*SEGMENT_COLUMNS), f"{output}/customer_features_with_predictions.csv", staged=True
        )
        rows["threshold_sweep"] = write_csv(run.threshold_sweep, f"{output}/threshold_sweep.csv", single_file=True)
        rows["live_metrics"] = write_csv(run.live_metrics, f"{output}/live_metrics.csv", single_file=True)

        # Segments and experiment
        rows["customer_segments"] = write_csv(segmented, f"{output}/customer_segments.csv", staged=True)
        rows["crm_export"] = write_csv(
            segments.crm_export(segmented, segments.WIN_BACK), f"{output}/crm_export.csv", staged=True
        )
        day = pool_date or plan.as_of_pool_date()
        arms = assignment
        if arms is None:
            then = ScoredRun(plan.plan_at(day))
            of_day = workspace.stage(
                then.segments.select("customer_unique_id", "churn_probability", *SEGMENT_COLUMNS), "segments-of-day")
            rows["pool_segments"] = write_csv(of_day, f"{output}/pool_segments.csv", staged=True)
            arms = plan.assignment(day, of_day)
        outcomes = workspace.stage(plan.outcomes(day, arms), "outcomes")
        rows["experiment_pool"] = write_csv(outcomes, f"{output}/experiment_pool.csv", staged=True)
        write_document(experiment_results(outcomes, params), f"{output}/ab_test_results.json")
    return rows


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder with the six CSV files")
    parser.add_argument("--output", required=True, help="folder all executors can write to")
    parser.add_argument("--prefix", default="", help="prefix of the CSV file names")
    parser.add_argument(
        "--split-date",
        type=date.fromisoformat,
        default=Params().split_date,
        help="first purchases before this day train the models",
    )
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tidemark-batch").getOrCreate()
    tables = load_csv_folder(spark, args.input, args.prefix)
    for name, count in run_batch(
        spark, tables, args.output, Params(split_date=args.split_date)
    ).items():
        print(f"{name}: {count} rows")


if __name__ == "__main__":
    main()
