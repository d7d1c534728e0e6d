"""Churn models on MLlib: split, scale on train, balance, fit, score everyone."""

from __future__ import annotations

from functools import cached_property

from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import finite_or_zero
from tidemark.operators.customers import column_statistics
from tidemark.params import Params
from tidemark.workspace import Workspace

# Recency and recency_ratio are left out: the label is a function of recency.
MODEL_FEATURES = [
    "frequency",
    "monetary",
    "purchase_freq_trend",
    "discount_dependency",
    "category_diversity_trend",
    "aov_trend",
]
SCALED_FEATURES = [f"scaled_{c}" for c in MODEL_FEATURES]
_VECTOR = "model_features"


def class_weights(train: DataFrame, label: str = "churn") -> DataFrame:
    """Balanced weights: n / (number of classes × class size)."""
    sizes = train.groupBy(label).agg(F.count("*").alias("n_class"))
    classes = Window.partitionBy()  # the two rows of sizes
    weight = F.sum("n_class").over(classes) / (F.count("*").over(classes) * F.col("n_class"))
    return sizes.withColumn("weight", weight)


def scaler_statistics(train: DataFrame) -> DataFrame:
    """One row: mean and population deviation of each model feature on train."""
    return train.agg(
        *[F.avg(finite_or_zero(F.col(c))).alias(f"mean_{c}") for c in MODEL_FEATURES],
        *[F.stddev_pop(finite_or_zero(F.col(c))).alias(f"std_{c}") for c in MODEL_FEATURES],
    )


def _standardised(name: str) -> Column:
    deviation = F.col(f"fitted.std_{name}")
    centred = finite_or_zero(F.col(name)) - F.col(f"fitted.mean_{name}")
    return centred / F.when(deviation == 0, 1.0).otherwise(deviation)


def scale(frame: DataFrame, statistics: Column) -> DataFrame:
    """Standardise by the train statistics; a constant feature is only centred."""
    fitted = frame.withColumn("fitted", statistics)
    return fitted.withColumns({c: _standardised(c) for c in MODEL_FEATURES}).drop("fitted")


def with_scaled(frame: DataFrame, statistics: Column) -> DataFrame:
    """The standardised features beside the raw ones, as scaled_<feature>."""
    fitted = frame.withColumn("fitted", statistics)
    return fitted.withColumns({f"scaled_{c}": _standardised(c) for c in MODEL_FEATURES}).drop("fitted")


def scaled_by_train(split: DataFrame) -> DataFrame:
    statistics = scaler_statistics(split.filter(F.col("split") == "train"))
    return scale(split, statistics.select(F.struct("*")).scalar())


def scaled_profile(split: DataFrame) -> DataFrame:
    """Mean, population deviation, minimum and maximum of the scaled train features."""
    train = scaled_by_train(split).filter(F.col("split") == "train")
    return column_statistics(train, MODEL_FEATURES, F.stddev_pop)


class ChurnModels:
    """Both models over the customers' profile with scaled features beside the raw ones; each is fitted on first use.

    MLlib keeps its own compact copy of the training rows during a fit. Scores are a column added to the
    profile where it is read: nothing is joined back.
    """

    def __init__(self, profile: DataFrame, params: Params, workspace: Workspace):
        self.profile = profile
        self.params = params
        self.workspace = workspace

    @property
    def scaled(self) -> DataFrame:
        """The standardised features under the plain names."""
        named = [F.col(s).alias(c) for s, c in zip(SCALED_FEATURES, MODEL_FEATURES)]
        return self.profile.select("customer_unique_id", "split", "churn", *named)

    @cached_property
    def class_sizes(self) -> dict[int, tuple[int, float]]:
        """Size and weight of each class: two rows."""
        train = self.profile.filter(F.col("split") == "train")
        return {row.churn: (row.n_class, row.weight) for row in class_weights(train).collect()}

    @property
    def train_size(self) -> int:
        return sum(size for size, _ in self.class_sizes.values())

    @cached_property
    def training(self) -> DataFrame:
        """label, balanced weight and scaled features of the train split."""
        weights = {label: weight for label, (_, weight) in self.class_sizes.items()}
        balanced = F.when(F.col("churn") == 1, weights.get(1, 1.0)).otherwise(weights.get(0, 1.0))
        train = self.profile.filter(F.col("split") == "train")
        return train.select(F.col("churn").cast("double").alias("label"), balanced.alias("weight"), *SCALED_FEATURES)

    @property
    def _training_rows(self) -> DataFrame:
        return _assembled(self.training).select("label", "weight", _VECTOR)

    @cached_property
    def logistic(self) -> LogisticRegressionModel:
        """The penalty 1/n reproduces an L2 weight of 1 against a sum of losses.

        MLlib averages the losses over the weights, and balanced weights add up
        to n.
        """
        return LogisticRegression(
            featuresCol=_VECTOR,
            labelCol="label",
            weightCol="weight",
            maxIter=self.params.max_iter,
            regParam=1.0 / max(self.train_size, 1),
            elasticNetParam=0.0,
            standardization=False,
            tol=self.params.lr_tolerance,
        ).fit(self._training_rows)

    @cached_property
    def forest(self) -> RandomForestClassificationModel:
        return RandomForestClassifier(
            featuresCol=_VECTOR,
            labelCol="label",
            weightCol="weight",
            numTrees=self.params.n_trees,
            maxDepth=self.params.tree_depth,
            maxBins=self.params.tree_bins,
            featureSubsetStrategy="2",
            bootstrap=self.params.tree_bootstrap,
            seed=self.params.model_seed,
        ).fit(self._training_rows)

    def scored(self, fitted) -> DataFrame:
        """The profile with a fitted model's churn_probability in place of any other."""
        columns = [c for c in self.profile.columns if c not in (*SCALED_FEATURES, "churn_probability")]
        probability = vector_to_array("probability").getItem(1).alias("churn_probability")
        return fitted.transform(_assembled(self.profile.drop("churn_probability"))).select(*columns, probability)

    def _score(self, fitted) -> DataFrame:
        return self.scored(fitted).select("customer_unique_id", "split", "churn", "churn_probability")

    def forest_scores(self) -> DataFrame:
        return self._score(self.forest)

    def logistic_scores(self) -> DataFrame:
        return self._score(self.logistic)

    def coefficients(self) -> DataFrame:
        values = [float(v) for v in self.logistic.coefficients]
        return _per_feature(self.profile, values, "coefficient")

    def importances(self) -> DataFrame:
        values = [float(v) for v in self.forest.featureImportances.toArray()]
        return _per_feature(self.profile, values, "importance")


def _per_feature(frame: DataFrame, values: list[float], name: str) -> DataFrame:
    """One row per feature, the largest absolute value first."""
    pairs = [
        F.struct(F.lit(feature).alias("feature"), F.lit(value).alias(name))
        for feature, value in zip(MODEL_FEATURES, values)
    ]
    rows = frame.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    return rows.orderBy(F.abs(name).desc(), "feature")


def _assembled(frame: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=SCALED_FEATURES, outputCol=_VECTOR).transform(frame)


def churn_models(profile: DataFrame, params: Params, workspace: Workspace) -> ChurnModels:
    """profile: a staged table with split, churn and the features. Only the one row of statistics is staged, so that
    every pass of a fit and every scoring scales alike."""
    train = profile.filter(F.col("split") == "train")
    statistics = workspace.stage(scaler_statistics(train), "scaler")
    return ChurnModels(with_scaled(profile, statistics.select(F.struct("*")).scalar()), params, workspace)
