"""Declared schemas of the six input tables and of the small JSON documents.

Only the columns the operators read are declared; a CSV or Parquet source may
carry more, they are pruned at the scan.
"""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(18, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


ORDERS = _struct(
    order_id=T.StringType(),
    customer_id=T.StringType(),
    order_status=T.StringType(),
    order_purchase_timestamp=T.TimestampNTZType(),
)
CUSTOMERS = _struct(customer_id=T.StringType(), customer_unique_id=T.StringType())
ITEMS = _struct(
    order_id=T.StringType(),
    order_item_id=T.IntegerType(),
    product_id=T.StringType(),
    price=_MONEY,
)
PRODUCTS = _struct(product_id=T.StringType(), product_category_name=T.StringType())
TRANSLATION = _struct(
    product_category_name=T.StringType(),
    product_category_name_english=T.StringType(),
)
PAYMENTS = _struct(order_id=T.StringType(), payment_type=T.StringType())

COHORT_RETENTION = _struct(
    cohort_month=T.DateType(),
    cohort_size=T.LongType(),
    period_diff=T.LongType(),
    active_customers=T.LongType(),
    retention_rate=T.DoubleType(),
)
RUN_METADATA = _struct(churn_threshold=T.LongType(), snapshot_date=T.StringType())
MODEL_METRICS = _struct(
    lr_auc=T.DoubleType(),
    rf_auc=T.DoubleType(),
    selected_rf_threshold=T.DoubleType(),
    lr_coefs=T.ArrayType(_struct(feature=T.StringType(), coefficient=T.DoubleType())),
    rf_importances=T.ArrayType(_struct(feature=T.StringType(), importance=T.DoubleType())),
    lr_confusion_matrix=T.ArrayType(T.ArrayType(T.LongType())),
    rf_confusion_matrix=T.ArrayType(T.ArrayType(T.LongType())),
    test_size=T.LongType(),
    train_size=T.LongType(),
)
EXPERIMENT_RESULTS = _struct(
    n_treatment=T.LongType(),
    n_control=T.LongType(),
    retained_treatment=T.LongType(),
    retained_control=T.LongType(),
    rate_treatment=T.DoubleType(),
    rate_control=T.DoubleType(),
    lift=T.DoubleType(),
    z_stat=T.DoubleType(),
    p_value=T.DoubleType(),
    ci_lower=T.DoubleType(),
    ci_upper=T.DoubleType(),
    cost_per_cust=T.DoubleType(),
    total_cost=T.DoubleType(),
    avg_clv=T.DoubleType(),
    incremental_saved=T.DoubleType(),
    clv_protected=T.DoubleType(),
    net_profit=T.DoubleType(),
    roi=T.DoubleType(),
)
