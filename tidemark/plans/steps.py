"""Steps of a batch run started again from what the run wrote: tables as CSV, run scalars and threshold as documents.

Each gives what the whole run gives for it, without the orders and without a fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import evaluation, ranking, segments
from tidemark.operators.customers import FEATURE_COLUMNS
from tidemark.params import Params
from tidemark.plans.batch import SCORE_COLUMNS, SEGMENT_COLUMNS, experiment_results
from tidemark.sources.documents import read_document

_COUNTS = ("recency", "frequency")
SCORED_CUSTOMERS = T.StructType(
    [T.StructField("customer_unique_id", T.StringType())]
    + [T.StructField(c, T.LongType() if c in _COUNTS else T.DoubleType()) for c in FEATURE_COLUMNS]
    + [
        T.StructField("churn", T.IntegerType()),
        T.StructField("first_purchase_date", T.DateType()),
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("churn_prediction", T.IntegerType()),
    ]
)
POOL = T.StructType([
    T.StructField("customer_unique_id", T.StringType()), T.StructField("clv", T.DoubleType()),
    T.StructField("arm", T.StringType()), T.StructField("retained", T.IntegerType()),
])


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written table by header names; the columns of the schema in its order."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def segments_from_documents(spark: SparkSession, output: str, params: Params) -> DataFrame:
    """customer_segments again, from the scored customers, the stored snapshot and the stored threshold.

    Without metrics the threshold is params.risk_threshold; the snapshot has no default.
    """
    scored = _csv(spark, f"{output}/customer_features_with_predictions.csv", SCORED_CUSTOMERS)
    metadata = read_document(spark, f"{output}/metadata.json", schemas.RUN_METADATA)
    if metadata is None:
        raise FileNotFoundError(f"{output}/metadata.json")
    metrics = read_document(
        spark, f"{output}/model_metrics.json", schemas.MODEL_METRICS, {"selected_rf_threshold": params.risk_threshold})
    snapshot = metadata.select(F.col("snapshot_date").cast("date")).scalar()
    threshold = metrics.select("selected_rf_threshold").scalar()
    valued = segments.clv(scored, snapshot, params)
    segmented = segments.resegment(valued, threshold, ranking.exact_median(valued, "clv").scalar())
    predicted = evaluation.predict(segmented, threshold)
    return predicted.select("customer_unique_id", *FEATURE_COLUMNS, "churn", *SCORE_COLUMNS, *SEGMENT_COLUMNS)


def readout_from_documents(spark: SparkSession, output: str, params: Params) -> DataFrame:
    """The experiment's results again, from the written pool with arms and outcomes."""
    return experiment_results(_csv(spark, f"{output}/experiment_pool.csv", POOL), params)
