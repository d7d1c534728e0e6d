from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tidemark.operators import evaluation, model
from tidemark.params import Params
from tidemark.plans.catalog import plan_for


@pytest.fixture(scope="module")
def plan(spark):
    made = plan_for(spark, SMALL)
    yield made
    made.workspace.close()


def test_weights_are_balanced(plan):
    weights = model.class_weights(plan.split.filter("split = 'train'")).collect()
    n = sum(r.n_class for r in weights)
    assert sum(r.n_class * r.weight for r in weights) == pytest.approx(n)
    assert len({round(r.n_class * r.weight, 9) for r in weights}) == 1


def test_scaling_uses_train_statistics(plan):
    profile = {r.feature: r for r in model.scaled_profile(plan.split).collect()}
    assert set(profile) == set(model.MODEL_FEATURES)
    for row in profile.values():
        assert row.mean == pytest.approx(0.0, abs=1e-9)
        assert row.std == pytest.approx(1.0)
    everyone = model.scaled_by_train(plan.split).agg(F.avg("monetary")).first()[0]
    assert abs(everyone) > 1e-6


def test_constant_and_unusable_features(spark):
    rows = [(1.0, float("nan")), (1.0, float("inf")), (1.0, None), (1.0, 6.0)]
    frame = spark.createDataFrame(rows, "frequency double, monetary double").select(
        "*", *[F.lit(0.0).alias(c) for c in model.MODEL_FEATURES[2:]], F.lit("train").alias("split")
    )
    got = model.scaled_by_train(frame).toPandas()
    assert (got.frequency == 0).all()
    assert got.monetary.tolist() == pytest.approx([-1 / 3**0.5] * 3 + [3**0.5])


def test_logistic_is_the_penalised_optimum(plan):
    """Gradient of |w|²/2 + sum of balanced log losses vanishes at the fit."""
    train = plan.models.scaled.filter("split = 'train'").toPandas()
    x, y = train[model.MODEL_FEATURES].to_numpy(), train.churn.to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    w = plan.models.logistic.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + plan.models.logistic.intercept)))
    assert w + x.T @ (weight * (p - y)) == pytest.approx(np.zeros(len(w)), abs=1e-2)
    assert (weight * (p - y)).sum() == pytest.approx(0, abs=1e-2)


def test_coefficients_and_importances_are_sorted(plan):
    coefficients = [abs(r.coefficient) for r in plan.models.coefficients().collect()]
    importances = [r.importance for r in plan.models.importances().collect()]
    assert coefficients == sorted(coefficients, reverse=True) and len(coefficients) == 6
    assert importances == sorted(importances, reverse=True)
    assert sum(importances) == pytest.approx(1.0)


def test_everyone_is_scored(plan):
    scores = plan.models.forest_scores()
    assert scores.count() == plan.split.count()
    low, high = scores.agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0 <= low <= high <= 1
    assert {r.split for r in scores.select("split").distinct().collect()} == {"train", "holdout", "immature"}


def test_separable_data_is_learned(spark, workspace):
    n = F.col("id")
    frame = spark.range(400).select(
        n.alias("customer_unique_id"),
        F.when(n % 4 == 0, "holdout").otherwise("train").alias("split"),
        (n % 10 < 3).cast("int").alias("churn"),
        (F.when(n % 10 < 3, 5.0).otherwise(-5.0) + (n % 7) / 10).alias("frequency"),
        *[((n * k) % 13).cast("double").alias(c) for k, c in enumerate(model.MODEL_FEATURES[1:], 2)],
    )
    models = model.churn_models(frame, Params(), workspace)
    assert models.train_size == 300
    for scores in (models.forest_scores(), models.logistic_scores()):
        totals = evaluation.score_totals(scores.filter("split = 'holdout'"), workspace)
        assert evaluation.roc_auc(totals).first().auc == 1.0
    assert models.coefficients().first().feature == "frequency"
    assert models.importances().first().feature == "frequency"
