"""Experiment on a customer segment: arms, observed outcomes, readout, ROI."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ratio_or
from tidemark.params import Params

TREATMENT = "treatment"
CONTROL = "control"


def assign_arms(pool: DataFrame, salt: str, treatment_pct: int = 50) -> DataFrame:
    """Arm by a salted hash of the id: the same under any order or partitioning."""
    digest = F.md5(F.concat(F.col("customer_unique_id").cast("string"), F.lit(salt)))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    arm = F.when(bucket < treatment_pct, TREATMENT).otherwise(CONTROL)
    return pool.withColumn("arm", arm)


def observed_outcomes(assigned: DataFrame, later_orders: DataFrame) -> DataFrame:
    """retained = 1 for customers with at least one of the later orders."""
    returned = (
        later_orders.select("customer_unique_id").distinct().withColumn("retained", F.lit(1))
    )
    return assigned.join(returned, "customer_unique_id", "left").withColumn(
        "retained", F.coalesce("retained", F.lit(0))
    )


def arm_counts(outcomes: DataFrame) -> DataFrame:
    """One row: arm sizes, retained per arm, mean CLV of the whole pool."""
    treated = F.col("arm") == TREATMENT
    control = F.col("arm") == CONTROL
    retained = F.col("retained") == 1
    return outcomes.agg(
        F.count_if(treated).alias("n_treatment"),
        F.count_if(control).alias("n_control"),
        F.count_if(treated & retained).alias("retained_treatment"),
        F.count_if(control & retained).alias("retained_control"),
        F.avg("clv").alias("avg_clv"),
    )


def _binomial_variance(rate: Column, n: Column) -> Column:
    return ratio_or(rate * (1 - rate), n, default=None)


def readout(counts: DataFrame, params: Params) -> DataFrame:
    """Rates, lift, pooled two-proportion z, unpooled 95 % interval, error bars.

    The rate of an empty arm is 0; its z and intervals are null, not an error.
    """
    rates = counts.withColumns(
        {
            "rate_treatment": ratio_or(F.col("retained_treatment"), F.col("n_treatment")),
            "rate_control": ratio_or(F.col("retained_control"), F.col("n_control")),
            "pooled": ratio_or(
                F.col("retained_treatment") + F.col("retained_control"),
                F.col("n_treatment") + F.col("n_control"),
                default=None,
            ),
        }
    )
    one = F.lit(1.0)
    inverse_sizes = F.try_divide(one, F.col("n_treatment").cast("double")) + F.try_divide(
        one, F.col("n_control").cast("double")
    )
    of_treatment = _binomial_variance(F.col("rate_treatment"), F.col("n_treatment"))
    of_control = _binomial_variance(F.col("rate_control"), F.col("n_control"))
    spread = rates.withColumns(
        {
            "lift": F.col("rate_treatment") - F.col("rate_control"),
            "pooled_se": F.sqrt(F.col("pooled") * (1 - F.col("pooled")) * inverse_sizes),
            "margin": params.z_95 * F.sqrt(of_treatment + of_control),
            "err_treatment": params.z_95 * F.sqrt(of_treatment),
            "err_control": params.z_95 * F.sqrt(of_control),
        }
    )
    return spread.select(
        "n_treatment",
        "n_control",
        "retained_treatment",
        "retained_control",
        "rate_treatment",
        "rate_control",
        "lift",
        F.try_divide("lift", "pooled_se").alias("z_stat"),
        (F.col("lift") - F.col("margin")).alias("ci_lower"),
        (F.col("lift") + F.col("margin")).alias("ci_upper"),
        "err_treatment",
        "err_control",
        "avg_clv",
    )


def with_p_value(result: DataFrame) -> DataFrame:
    """Two-sided normal p-value. Spark SQL has no erfc; the readout is one row.

    The function is local so that workers get its code, not an import.
    """

    def two_sided(z: pd.Series) -> pd.Series:
        return z.map(lambda value: math.erfc(abs(value) / math.sqrt(2.0)), na_action="ignore")

    return result.withColumn("p_value", F.pandas_udf(two_sided, T.DoubleType())("z_stat"))


def campaign_roi(result: DataFrame, params: Params) -> DataFrame:
    """Cost, incremental customers saved, CLV protected, net profit and ROI %."""
    return (
        result.withColumn("cost_per_cust", F.lit(params.cost_per_customer))
        .withColumn("total_cost", F.col("n_treatment") * F.col("cost_per_cust"))
        .withColumn(
            "incremental_saved",
            F.col("retained_treatment") - F.col("n_treatment") * F.col("rate_control"),
        )
        .withColumn("clv_protected", F.col("incremental_saved") * F.col("avg_clv"))
        .withColumn("net_profit", F.col("clv_protected") - F.col("total_cost"))
        .withColumn("roi", ratio_or(F.col("net_profit"), F.col("total_cost")) * 100)
    )
