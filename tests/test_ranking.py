from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import evaluation, ranking
from tidemark.params import Params


def median_of(spark, workspace, values, accuracy=10_000):
    frame = spark.createDataFrame([(float(v),) if v is not None else (None,) for v in values], "x double")
    return ranking.exact_median(frame, "x", accuracy).first().median


@pytest.mark.parametrize(
    "values",
    [[3.0], [1.0, 2.0], [5.0] * 9, [1.0, None, 9.0], list(range(100)), [7.0] * 50 + list(range(101))],
)
def test_median_cases(spark, workspace, values):
    known = [v for v in values if v is not None]
    assert median_of(spark, workspace, values) == np.median(known)


def test_median_of_nothing(spark, workspace):
    assert median_of(spark, workspace, [None]) is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9), min_size=1, max_size=60), st.integers(3, 40))
def test_median_property(spark, workspace, values, accuracy):
    assert median_of(spark, workspace, values, accuracy) == pytest.approx(np.median(values), rel=1e-15)


def test_running_totals_match_cumsum(spark, workspace):
    keys = spark.range(5000).select(
        (F.xxhash64("id") % 100_000).cast("double").alias("k"), (F.col("id") % 7).alias("w")
    ).groupBy("k").agg(F.sum("w").alias("w"))
    got = ranking.running_totals(keys, "k", ["w"], workspace, 6).orderBy("k").toPandas()
    assert (got.before_w == got.w.cumsum() - got.w).all()
    assert (got.total_w == got.w.sum()).all()


def test_merged_ranges_stay_in_order(spark, workspace):
    """Without a given number adaptive execution merges small ranges."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        keys = spark.range(200_000).select((F.xxhash64("id") / 7).alias("k"), F.lit(1).alias("w"))
        got = ranking.running_totals(keys.groupBy("k").agg(F.sum("w").alias("w")), "k", ["w"], workspace)
        late = got.withColumn("rank", F.row_number().over(Window.orderBy("k")) - 1)
        assert late.filter("rank <> before_w").count() == 0
        assert got.count() == 200_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture()
def scored(spark):
    """A third of all rows share one score."""
    u = (F.abs(F.xxhash64("id")) % 997) / 997.0
    score = F.when(F.col("id") % 3 == 0, 0.5).otherwise(u)
    label = (((F.abs(F.xxhash64("id", F.lit(1))) % 1000) / 1000.0) < score).cast("int")
    return spark.range(6000).select(
        F.col("id").alias("customer_unique_id"), score.alias("churn_probability"), label.alias("churn")
    ).cache()


def test_auc_agrees_with_evaluator_and_mirrors(scored, workspace):
    auc = evaluation.roc_auc(evaluation.score_totals(scored, workspace)).first().auc
    reference = BinaryClassificationEvaluator(
        rawPredictionCol="churn_probability", labelCol="churn", numBins=0
    ).evaluate(scored)
    assert auc == pytest.approx(reference, abs=1e-9)
    mirrored = scored.withColumn("churn_probability", -F.col("churn_probability"))
    assert evaluation.roc_auc(evaluation.score_totals(mirrored, workspace)).first().auc == pytest.approx(1 - auc)


def test_auc_needs_both_classes(spark, workspace):
    one = spark.createDataFrame([(0.2, 1), (0.7, 1)], "churn_probability double, churn int")
    assert evaluation.roc_auc(evaluation.score_totals(one, workspace)).first().auc is None


def test_pr_curve_and_threshold(scored, workspace):
    curve = evaluation.pr_curve(evaluation.score_totals(scored, workspace)).orderBy("threshold").toPandas()
    data = scored.toPandas()
    for t in (curve.threshold.iloc[0], 0.5, curve.threshold.iloc[-1]):
        row = curve[curve.threshold == t].iloc[0]
        flagged = data[data.churn_probability >= t]
        assert row.true_positives == flagged.churn.sum()
        assert row.precision == pytest.approx(flagged.churn.mean())
        assert row.recall == pytest.approx(flagged.churn.sum() / data.churn.sum())
    assert (curve.recall.diff().dropna() <= 0).all()

    spark_curve = evaluation.pr_curve(evaluation.score_totals(scored, workspace))
    chosen = evaluation.operating_threshold(spark_curve, Params()).first()
    assert chosen.raw_threshold == curve[curve.recall >= 0.8].threshold.max()
    assert chosen.threshold == min(max(chosen.raw_threshold, 0.3), 0.7)
    clamped = data[data.churn_probability >= chosen.threshold]
    assert chosen.recall == pytest.approx(clamped.churn.sum() / data.churn.sum())

    high = evaluation.operating_threshold(spark_curve, Params(threshold_floor=0.69)).first()
    assert high.threshold == 0.69 and high.recall < 0.8
    none = evaluation.operating_threshold(spark_curve, Params(threshold_floor=2.0, threshold_ceiling=3.0)).first()
    assert (none.threshold, none.precision, none.recall) == (2.0, 0.0, 0.0)


def test_no_threshold_without_data(spark, workspace):
    empty = spark.createDataFrame([], "churn_probability double, churn int")
    curve = evaluation.pr_curve(evaluation.score_totals(empty, workspace))
    chosen = evaluation.operating_threshold(curve, Params()).first()
    assert chosen.raw_threshold is None and chosen.threshold is None


def test_recall_is_one_without_positives(spark, workspace):
    none = spark.createDataFrame([(0.2, 0), (0.9, 0)], "churn_probability double, churn int")
    curve = evaluation.pr_curve(evaluation.score_totals(none, workspace))
    assert [r.recall for r in curve.collect()] == [1.0, 1.0]
    assert evaluation.operating_threshold(curve, Params()).first().raw_threshold == 0.9


def test_confusion_and_report(spark):
    pairs = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 3
    frame = spark.createDataFrame(pairs, "churn int, churn_prediction int")
    matrix = evaluation.confusion_matrix(frame)
    assert {(r.actual, r.predicted): r.n for r in matrix.collect()} == {(0, 0): 3, (0, 1): 1, (1, 0): 2, (1, 1): 6}
    assert evaluation.matrix_array(matrix).first().matrix == [[3, 1], [2, 6]]
    report = {r["class"]: r for r in evaluation.classification_report(matrix).collect()}
    assert report["1"].precision == pytest.approx(6 / 7)
    assert report["0"].recall == pytest.approx(3 / 4)
    assert report["accuracy"].precision == pytest.approx(9 / 12)
    assert report["macro avg"].recall == pytest.approx((3 / 4 + 6 / 8) / 2)
    assert report["weighted avg"].precision == pytest.approx((4 * 3 / 5 + 8 * 6 / 7) / 12)
    empty = evaluation.classification_report(evaluation.confusion_matrix(frame.filter("churn = 5")))
    assert {r.f1 for r in empty.collect()} == {0.0}


def test_sweep_matches_one_threshold_at_a_time(spark, scored):
    table = scored.withColumns(
        {
            "clv": F.col("customer_unique_id") * 1.0,
            "mature": F.col("customer_unique_id") % 2 == 0,
            "split": F.when(F.col("customer_unique_id") % 4 == 0, "train").otherwise("holdout"),
        }
    )
    sweep = evaluation.threshold_sweep(table, F.lit(3000.0), Params()).toPandas().set_index("threshold")
    data = table.toPandas()
    assert len(sweep) == 81
    for t in sweep.index:
        risky = data.churn_probability >= t
        assert sweep.win_back[t] == (risky & (data.clv >= 3000)).sum()
        assert sweep.no_action[t] == (~risky & (data.clv < 3000)).sum()
        assert sweep.clv_at_risk[t] == pytest.approx(data.clv[risky].sum())
        mature = data[data.mature]
        hits = ((mature.churn_probability >= t) & (mature.churn == 1)).sum()
        assert sweep.recall[t] == pytest.approx(hits / (mature.churn == 1).sum())
    by_split = {r["split"]: r for r in evaluation.live_metrics(table, 0.5).collect()}
    assert set(by_split) == {"mature", "train", "holdout"}
    live = by_split["mature"]
    assert live.recall == pytest.approx(sweep.recall[0.5])
    assert live.precision == pytest.approx(sweep.precision[0.5])


def test_sweep_boundaries_are_exact(spark):
    """Scores equal to a threshold belong to it, for every slider position."""
    scores = spark.range(10, 91).select(
        (F.col("id") / 100.0).alias("churn_probability"),
        F.lit(1.0).alias("clv"),
        F.lit(1).alias("churn"),
        F.lit(True).alias("mature"),
    )
    sweep = evaluation.threshold_sweep(scores, F.lit(0.0), Params()).collect()
    assert [r.win_back for r in sweep] == list(range(81, 0, -1))


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_median_moves_only_the_bracket(spark):
    """Of 100,000 values only those between the sketch's two marks are counted and shuffled; nothing is staged."""
    frame = spark.range(100_000).select((F.xxhash64("id") / 3.0).alias("x"))
    median = ranking.exact_median(frame, "x", 1000)
    assert "rangepartitioning" not in executed(median)
    assert median.first().median == np.median(frame.toPandas().x)
    low, high = [frame.toPandas().x.quantile(q) for q in (0.5 - 0.004, 0.5 + 0.004)]
    assert frame.filter(F.col("x").between(low, high)).count() < 1000


@pytest.mark.parametrize("heavy", [0.0, 7.5, 1e9])
def test_median_with_a_crowded_value(spark, heavy):
    values = [heavy] * 700 + [float(v) for v in range(1301)]
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    assert ranking.exact_median(frame, "x", 50).first().median == np.median(values)


def test_running_totals_keep_the_written_ranges(spark, workspace):
    """After the ranges are written no row moves: the only exchange is that of the offsets, a row per range."""
    keys = spark.range(64_000).select((F.xxhash64("id") / 7).alias("k"), F.lit(1).alias("w"))
    totals = ranking.running_totals(keys, "k", ["w"], workspace, 64)
    plan = executed(totals).split("Initial Plan")[0]
    scans = [line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line]
    assert len(scans) == 2 and "MapInArrow" not in plan
    rows_side = plan[: plan.index("BroadcastExchange")]
    assert "Window" not in rows_side and "hashpartitioning" not in rows_side and "Sort " not in rows_side
    ranges = ranking._ranges(keys, "k", ["w"], workspace, 64).groupBy("part").count().toPandas()["count"]
    assert len(ranges) == 64 and ranges.max() <= 2 * 1000 and ranges.min() >= 500
