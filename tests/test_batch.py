from __future__ import annotations

import glob
import json
import os
from dataclasses import replace

import duckdb
import pytest

from conftest import SMALL
from tidemark import schemas
from tidemark.operators import segments
from tidemark.params import Params
from tidemark.plans import steps
from tidemark.plans.batch import run_batch
from tidemark.sources import load_csv_folder
from tidemark.sources.star import star_params

QUERIES = {
    "orders": """SELECT 'o' || o_orderkey AS order_id, 'c' || o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' ELSE 'shipped' END AS order_status,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp, 'x' AS extra FROM orders""",
    "customers": "SELECT 'c' || c_custkey AS customer_id, 'u' || c_custkey AS customer_unique_id FROM customer",
    "order_items": """SELECT 'o' || l_orderkey AS order_id, 'p' || l_partkey AS product_id,
        l_linenumber AS order_item_id, l_extendedprice AS price FROM lineitem""",
    "products": "SELECT 'p' || p_partkey AS product_id, p_type AS product_category_name FROM part",
    "order_payments": """SELECT 'o' || l_orderkey AS order_id,
        CASE WHEN l_discount >= 0.1 THEN 'voucher' ELSE 'card' END AS payment_type FROM lineitem""",
}


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("out")
    con = duckdb.connect()
    for name in ("orders", "customer", "lineitem", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    for name, query in QUERIES.items():
        con.execute(f"COPY ({query}) TO '{raw}/{name}_dataset.csv' (HEADER)")
    tables = load_csv_folder(spark, str(raw))
    params = replace(Params(), split_date=star_params().split_date)
    return str(out), run_batch(spark, tables, str(out), params)


def document(folder, name):
    [part] = glob.glob(f"{folder}/{name}/part-*")
    with open(part) as handle:
        return json.load(handle)


def test_row_counts_match_the_anchors(outputs):
    _, rows = outputs
    customers = 145
    assert rows["customer_order_fact"] == 493
    assert rows["cohort_retention"] == 366
    assert rows["customer_purchase_gaps"] == 348
    for name in ("rfm_table", "customer_features", "customer_features_with_predictions", "customer_segments"):
        assert rows[name] == customers
    assert 0 < rows["crm_export"] < customers


def test_documents(outputs):
    folder, _ = outputs
    assert document(folder, "metadata.json") == {"churn_threshold": 735, "snapshot_date": "2001-08-02"}
    metrics = document(folder, "model_metrics.json")
    assert set(metrics) == set(schemas.MODEL_METRICS.fieldNames())
    assert (metrics["train_size"], metrics["test_size"]) == (112, 22)
    assert len(metrics["lr_coefs"]) == len(metrics["rf_importances"]) == 6
    sizes = [abs(c["coefficient"]) for c in metrics["lr_coefs"]]
    assert sizes == sorted(sizes, reverse=True)
    for name in ("lr_confusion_matrix", "rf_confusion_matrix"):
        assert sum(map(sum, metrics[name])) == 22
    assert 0.3 <= metrics["selected_rf_threshold"] <= 0.7
    results = document(folder, "ab_test_results.json")
    assert set(results) == set(schemas.EXPERIMENT_RESULTS.fieldNames())
    assert (results["n_treatment"], results["n_control"]) != (0, 0)


def test_csv_columns(spark, outputs):
    folder, _ = outputs
    features = spark.read.option("header", True).csv(f"{folder}/customer_features.csv")
    base = [
        "customer_unique_id", "recency", "frequency", "monetary", "purchase_freq_trend", "recency_ratio",
        "discount_dependency", "category_diversity_trend", "aov_trend", "churn",
    ]
    assert features.columns == base
    scored = spark.read.option("header", True).csv(f"{folder}/customer_features_with_predictions.csv")
    assert set(scored.columns) == {*base, "first_purchase_date", "churn_probability", "churn_prediction"}
    segmented = spark.read.option("header", True).csv(f"{folder}/customer_segments.csv")
    assert set(segmented.columns) == {*scored.columns, "clv", "quadrant", "risk_tier", "value_tier"}
    assert {r.quadrant for r in segmented.select("quadrant").distinct().collect()} <= set(segments.QUADRANTS)
    export = spark.read.option("header", True).csv(f"{folder}/crm_export.csv")
    assert export.columns == ["customer_unique_id", "clv", "churn_probability", "quadrant"]


def test_pool_is_the_models_win_back_segment_of_that_day(spark, outputs):
    """Segments of the pool date, arms and readout describe the same customers."""
    folder, rows = outputs
    read = lambda name: spark.read.option("header", True).csv(f"{folder}/{name}.csv").collect()
    of_day, pool = read("pool_segments"), read("experiment_pool")
    win_back = {r.customer_unique_id for r in of_day if r.quadrant == segments.WIN_BACK}
    assert win_back and {r.customer_unique_id for r in pool} == win_back
    assert len(of_day) == rows["pool_segments"] and rows["experiment_pool"] == len(pool)
    results = document(folder, "ab_test_results.json")
    for arm in ("treatment", "control"):
        mine = [r for r in pool if r.arm == arm]
        assert results[f"n_{arm}"] == len(mine)
        assert results[f"retained_{arm}"] == sum(r.retained == "1" for r in mine)


def test_sweep_and_live_metrics_are_on_the_models_score(spark, outputs):
    folder, _ = outputs
    typed = spark.read.option("header", True).option("inferSchema", True)
    segmented = typed.csv(f"{folder}/customer_segments.csv").toPandas()
    sweep = {r.threshold: r for r in typed.csv(f"{folder}/threshold_sweep.csv").collect()}
    assert len(sweep) == 81
    high = segmented.clv >= segmented.clv.median()
    for t in (0.1, 0.42, 0.9):
        assert sweep[t].win_back == (high & (segmented.churn_probability >= t)).sum()
    live = {r.split: r for r in typed.csv(f"{folder}/live_metrics.csv").collect()}
    assert {"mature", "train", "holdout"} <= set(live)
    assert all(0 <= r.precision <= 1 and 0 <= r.recall <= 1 for r in live.values())


def test_steps_alone_reproduce_the_whole_run(spark, outputs):
    folder, _ = outputs
    params = replace(Params(), split_date=star_params().split_date)
    again = steps.segments_from_documents(spark, folder, params)
    whole = spark.read.schema(again.schema).option("header", True).csv(f"{folder}/customer_segments.csv")
    assert whole.columns == again.columns
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, whole.collect()))
    results = steps.readout_from_documents(spark, folder, params).first().asDict()
    assert results == document(folder, "ab_test_results.json")


def test_segments_need_the_snapshot(spark, tmp_path, outputs):
    folder, _ = outputs
    os.symlink(f"{folder}/customer_features_with_predictions.csv", tmp_path / "customer_features_with_predictions.csv")
    with pytest.raises(FileNotFoundError):
        steps.segments_from_documents(spark, str(tmp_path), Params())
    os.symlink(f"{folder}/metadata.json", tmp_path / "metadata.json")
    segmented = steps.segments_from_documents(spark, str(tmp_path), Params(risk_threshold=0.0)).collect()
    assert {r.risk_tier for r in segmented} == {"High"}
