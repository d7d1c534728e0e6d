from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import experiment
from tidemark.params import Params

COUNTS = "n_treatment long, n_control long, retained_treatment long, retained_control long, avg_clv double"


def result_of(spark, *counts):
    frame = spark.createDataFrame([counts], COUNTS)
    read = experiment.with_p_value(experiment.readout(frame, Params()))
    return experiment.campaign_roi(read, Params()).first()


def test_recorded_campaign(spark):
    # A recorded readout; the p-value is held to 1e-6.
    got = result_of(spark, 13819, 13695, 4141, 2711, 169.7248103077147)
    expected = {
        "rate_treatment": 0.29965988855923004,
        "rate_control": 0.19795545819642205,
        "lift": 0.10170443036280799,
        "z_stat": 19.504786871104976,
        "ci_lower": 0.09156158060571543,
        "ci_upper": 0.11184728011990056,
        "total_cost": 69095.0,
        "incremental_saved": 1405.453523183644,
        "clv_protected": 238540.33261865328,
        "net_profit": 169445.33261865328,
        "roi": 245.2353030156354,
    }
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, rel=1e-9), name
    assert got.p_value == pytest.approx(9.997296310930239e-85, rel=1e-6)
    assert got.err_treatment == pytest.approx(1.96 * math.sqrt(got.rate_treatment * (1 - got.rate_treatment) / 13819))


@pytest.mark.parametrize("counts", [(0, 10, 0, 3, 5.0), (10, 0, 3, 0, 5.0), (0, 0, 0, 0, None)])
def test_empty_arm_is_null_not_error(spark, counts):
    got = result_of(spark, *counts)
    assert got.z_stat is None and got.p_value is None and got.ci_lower is None
    assert got.rate_treatment == (0.3 if counts[0] else 0.0)


def test_zero_cost_roi(spark):
    assert result_of(spark, 0, 10, 0, 3, 5.0).roi == 0.0


def test_arms_do_not_depend_on_partitioning(spark):
    people = spark.range(20_000).select(F.col("id").alias("customer_unique_id"))
    arms = [
        experiment.assign_arms(people.repartition(n), ":s1").orderBy("customer_unique_id").collect()
        for n in (1, 7, 32)
    ]
    assert arms[0] == arms[1] == arms[2]
    treated = sum(r.arm == experiment.TREATMENT for r in arms[0])
    assert abs(treated - 10_000) < 300
    other = experiment.assign_arms(people, ":s2").orderBy("customer_unique_id").collect()
    assert other != arms[0]


def test_outcomes_count_a_person_once(spark):
    assigned = spark.createDataFrame([(1, "treatment"), (2, "control")], "customer_unique_id long, arm string")
    later = spark.createDataFrame([(1,), (1,), (9,)], "customer_unique_id long")
    got = experiment.observed_outcomes(assigned, later).orderBy("customer_unique_id").collect()
    assert [(r.customer_unique_id, r.retained) for r in got] == [(1, 1), (2, 0)]
