from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shop_fixture import ITEMS, shop
from tidemark.operators import customers, segments
from tidemark.params import Params
from tidemark.plans.retention import RetentionPlan


@pytest.fixture()
def plan(spark, workspace):
    return RetentionPlan(shop(spark), Params(), workspace)


def rows(frame, *keys):
    return [tuple(r) for r in frame.orderBy(*keys).collect()]


def test_order_fact(plan):
    got = rows(
        plan.order_fact.select("order_id", "customer_unique_id", "order_date", "order_value", "category"),
        "order_id",
    )
    assert got == [
        ("o1", "U1", date(2018, 1, 10), 15.5, "health_beauty"),
        ("o2", "U1", date(2018, 3, 11), 20.0, "pc_gamer"),
        ("o3", "U2", date(2018, 1, 31), 7.0, "unknown"),
        ("o4", "U3", date(2018, 2, 1), 30.0, "health_beauty"),
        ("o5", "U3", date(2018, 2, 1), 12.0, "unknown"),
        ("o6", "U3", date(2018, 6, 30), 0.0, "unknown"),
    ]


def test_order_category_drops_items_without_product(plan):
    assert rows(plan.order_category, "order_id") == [
        ("o1", "health_beauty"), ("o2", "pc_gamer"), ("o3", "unknown"), ("o4", "health_beauty"),
        ("o7", "health_beauty"),
    ]


def test_category_pick_modes(spark, workspace):
    items = [("o1", 2, "p2", "5.5"), ("o1", 3, "p1", "10.0")] + [i for i in ITEMS if i[0] != "o1"]
    tables = shop(spark, items)

    def category_of_o1(pick):
        plan = RetentionPlan(tables, Params(category_pick=pick), workspace)
        return plan.order_fact.filter("order_id = 'o1'").first().category

    assert category_of_o1("lowest") == "pc_gamer"
    assert category_of_o1("equals_one") == "unknown"
    with pytest.raises(ValueError):
        category_of_o1("first")


def test_cohort_retention(plan):
    assert rows(plan.cohort_retention, "cohort_month", "period_diff") == [
        (date(2018, 1, 1), 2, 0, 2, 1.0),
        (date(2018, 1, 1), 2, 2, 1, 0.5),
        (date(2018, 2, 1), 1, 0, 1, 1.0),
        (date(2018, 2, 1), 1, 4, 1, 1.0),
    ]


def test_pivot_keeps_existing_periods_only(plan):
    pivot = plan.cohort_pivot()
    assert pivot.columns == ["cohort_month", "period_0", "period_2", "period_4"]
    assert rows(pivot, "cohort_month") == [
        (date(2018, 1, 1), 1.0, 0.5, None), (date(2018, 2, 1), 1.0, None, 1.0),
    ]
    only_february = plan.cohort_pivot(first=date(2018, 2, 1), last=date(2018, 2, 1))
    assert only_february.columns == ["cohort_month", "period_0", "period_4"]


def test_gaps_and_scalars(plan):
    assert rows(plan.purchase_gaps, "customer_unique_id", "order_date", "gap") == [
        ("U1", date(2018, 3, 11), date(2018, 1, 10), 60),
        ("U3", date(2018, 2, 1), date(2018, 2, 1), 0),
        ("U3", date(2018, 6, 30), date(2018, 2, 1), 149),
    ]
    stats = plan.gap_stats.first()
    assert (stats.n_gaps, stats.n_positive, stats.median_gap, stats.mean_gap) == (3, 2, 104.5, 104.5)
    assert tuple(plan.run_scalars.first()) == (209, date(2018, 7, 1), 104.5)


def test_snapshot_ignores_orders_of_unknown_customers(spark, workspace):
    tables = shop(spark)
    stray = spark.createDataFrame([("o9", "c99", "delivered", "2019-01-01 00:00:00")], "a string, b string, c string, d string")
    orders = tables.orders.union(stray.withColumn("d", F.col("d").cast("timestamp_ntz")))
    plan = RetentionPlan(type(tables)(**{**tables.__dict__, "orders": orders}), Params(), workspace)
    assert plan.last_order_date() == date(2018, 6, 30)
    assert plan.run_scalars.first().snapshot_date == date(2018, 7, 1)
    assert plan.rfm.agg(F.min("recency")).first()[0] == 1
    assert plan.on_staged_fact().last_order_date() == date(2018, 6, 30)


def test_shop_without_completed_orders(spark, workspace):
    tables = shop(spark)
    none = tables.orders.filter("order_status = 'canceled'")
    plan = RetentionPlan(type(tables)(**{**tables.__dict__, "orders": none}), Params(), workspace)
    assert plan.last_order_date() is None
    for frame in (plan.rfm, plan.cohort_retention, plan.purchase_gaps, plan.customer_features, plan.segments):
        assert frame.count() == 0
    assert tuple(plan.run_scalars.first()) == (90, None, 45.0)


def test_no_repeat_purchase_uses_fallback_median(spark, workspace):
    tables = shop(spark)
    single = tables.orders.filter(F.col("order_id").isin("o1", "o3"))
    plan = RetentionPlan(
        type(tables)(**{**tables.__dict__, "orders": single}), Params(), workspace
    )
    assert tuple(plan.run_scalars.first()) == (90, date(2018, 2, 1), 45.0)
    stats = plan.gap_stats.first()
    assert (stats.n_gaps, stats.n_positive, stats.median_gap) == (0, 0, None)


def test_features(plan):
    got = {
        r.customer_unique_id: r.asDict() for r in plan.customer_features.collect()
    }
    expected = {
        "U1": (112, 2, 35.5, 1 / 3, 112 / 60, 0.5, 1 / 3, 1 / 21 * 1.12, 0),
        "U2": (151, 1, 7.0, 0.5, 151 / 104.5, 0.0, 0.5, 1 / 8, 0),
        "U3": (1, 3, 42.0, 2 / 3, 1 / 74.5, 1 / 3, 2 / 3, 1 / 22, 0),
    }
    expected["U1"] = expected["U1"][:7] + (1 / 18.75,) + (0,)
    names = [
        "recency", "frequency", "monetary", "purchase_freq_trend", "recency_ratio",
        "discount_dependency", "category_diversity_trend", "aov_trend", "churn",
    ]
    assert set(got) == set(expected)
    for who, values in expected.items():
        assert [got[who][n] for n in names] == pytest.approx(list(values), abs=1e-9)


def test_window_orders(plan):
    counts = rows(plan.window_metrics.select("customer_unique_id", "freq_recent", "freq_prior"), "customer_unique_id")
    assert counts == [("U1", 0, 2), ("U2", 0, 1), ("U3", 1, 2)]


def test_clv(plan):
    got = dict(rows(plan.profile.select("customer_unique_id", "clv"), "customer_unique_id"))
    assert got == pytest.approx({"U1": 30.15436, "U2": 6.772848, "U3": 40.908}, abs=1e-5)


def test_label_is_strict(spark, plan):
    labelled = plan.features.withColumn("churn", customers.churn_flag(F.col("recency"), 112))
    got = dict(rows(labelled.select("customer_unique_id", "churn"), "customer_unique_id"))
    assert got == {"U1": 0, "U2": 1, "U3": 0}


def test_segments_and_empty_quadrants(plan):
    summary = {r.quadrant: r for r in segments.quadrant_summary(plan.segments).collect()}
    assert list(summary) == segments.QUADRANTS
    assert {q: r.customer_count for q, r in summary.items()} == {
        segments.WIN_BACK: 1, segments.REWARD: 1, segments.MONITOR: 1, segments.NO_ACTION: 0,
    }
    empty = summary[segments.NO_ACTION]
    assert (empty.total_clv, empty.avg_clv, empty.share_pct) == (0.0, 0.0, 0.0)
    shown = {r.quadrant: r for r in segments.quadrant_display(segments.quadrant_summary(plan.segments)).collect()}
    assert shown[segments.WIN_BACK].total_clv == "$30.15"
    assert shown[segments.WIN_BACK].share_pct == "33.33%"
    assert shown[segments.NO_ACTION].avg_churn_probability == "0.0%"
    with pytest.raises(ValueError):
        segments.crm_export(plan.segments, "nobody")
    assert segments.crm_export(plan.segments).count() == 3


def test_as_of_cuts_history(spark, workspace):
    plan = RetentionPlan(shop(spark), Params(), workspace, as_of=date(2018, 3, 11))
    assert plan.orders.count() == 5
    assert plan.run_scalars.first().snapshot_date == date(2018, 3, 12)
    assert plan.rfm.filter("customer_unique_id = 'U3'").first().frequency == 2
    staged = RetentionPlan(shop(spark), Params(), workspace).on_staged_fact().plan_at(date(2018, 3, 11))
    assert sorted(map(tuple, staged.customer_features.collect())) == sorted(
        map(tuple, plan.customer_features.collect())
    )


def test_views_answer_sql(spark, plan):
    plan.register_views()
    got = spark.sql("SELECT sum(order_value) AS total, count(*) AS n FROM customer_order_fact").first()
    assert (got.total, got.n) == (84.5, 6)
    assert spark.sql("SELECT max(gap) AS g FROM customer_purchase_gaps").first().g == 149
    assert spark.sql("SELECT count(*) AS n FROM rfm_table").first().n == 3


def test_display_rounds_the_binary_value_to_even(spark):
    from tidemark.functions import count_text, money_text, percent_text

    values = [0.125, 2.675, 1234567.885, 0.0, 1.005, 99.995]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    got = frame.select(
        money_text(F.col("x")), money_text(F.col("x"), grouped=False), percent_text(F.col("x") / 100)
    ).collect()
    assert [r[0] for r in got] == ["${:,.2f}".format(v) for v in values]
    assert [r[1] for r in got] == ["${:.2f}".format(v) for v in values]
    assert [r[2] for r in got] == ["{:.1%}".format(v / 100) for v in values]
    assert spark.range(1).select(count_text(F.lit(1234567))).first()[0] == "1,234,567"


def test_dates_do_not_pass_through_the_session_zone(spark):
    """Midnight of 2018-11-04 does not exist in Sao Paulo; text must not move."""
    from tidemark.functions import iso_date, iso_seconds

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        moment = F.lit("2018-11-04 00:10:00").cast("timestamp_ntz")
        got = spark.range(1).select(iso_seconds(moment), iso_date(F.to_date(moment))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(got) == ("2018-11-04 00:10:00", "2018-11-04")
