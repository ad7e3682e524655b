from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.operators import logistics

ORDER_SCHEMA = (
    "order_id int, customer_id int, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(7)
    start = datetime(2018, 1, 1)
    orders = []
    for i in range(300):
        bought = start + timedelta(hours=int(rng.integers(0, 24 * 60)))
        handed = bought + timedelta(hours=int(rng.integers(-20, 900)))
        delivered = handed + timedelta(hours=int(rng.integers(-20, 1700)))
        orders.append(
            (
                i,
                i % 40,
                bought,
                bought,
                handed,
                None if i % 7 == 0 else delivered,
                bought + timedelta(days=25),
            )
        )
    # One order holds a third of all lines.
    items = [(0 if rng.random() < 0.34 else int(rng.integers(0, 310)),) for _ in range(1500)]
    customers = [
        (i, None if i == 3 else f"city{i % 25:02d}", None if i == 5 else f"s{i % 4}")
        for i in range(40)
    ]
    return {
        "orders": spark.createDataFrame(orders, ORDER_SCHEMA),
        "order_items": spark.createDataFrame(items, "order_id int"),
        "customers": spark.createDataFrame(
            customers, "customer_id int, customer_city string, customer_state string"
        ),
    }


@pytest.fixture(scope="module")
def lines(tables):
    joined = tables["order_items"].join(tables["orders"], "order_id")
    joined = joined.join(tables["customers"], "customer_id", "left")
    return logistics.add_stage_days(joined)


@pytest.fixture(scope="module")
def weighted(tables):
    return logistics.weighted_orders(tables)


def same(a, b):
    left, right = a.collect(), b.collect()
    assert len(left) == len(right) > 0
    for x, y in zip(left, right):
        assert x.asDict().keys() == y.asDict().keys()
        for name in x.asDict():
            assert x[name] == pytest.approx(y[name], abs=1e-9), name


@pytest.mark.parametrize(
    "operator",
    [
        logistics.median_delay_by_state,
        logistics.late_rate_by_state,
        logistics.late_rate_national,
        logistics.top_cities,
        logistics.city_delivery_time,
        logistics.state_delivery_time,
    ],
)
def test_weighted_orders_agree_with_lines(lines, weighted, operator):
    same(operator(lines), operator(weighted, weight="order_lines"))


def test_weighted_breakdowns_agree_with_lines(lines, weighted):
    for rule, operator in (
        (logistics.valid_logistics, logistics.state_logistics_breakdown),
        (logistics.valid_logistics_by_total, logistics.delivery_composition),
    ):
        same(operator(rule(lines)), operator(rule(weighted), weight="order_lines"))


def test_undelivered_and_on_time_lines_are_not_late(spark):
    df = spark.createDataFrame([(None,), (0,), (1,)], "delay_days int")
    late = df.select(logistics.is_late().alias("late")).collect()
    assert [row.late for row in late] == [False, False, True]


def test_filters_are_exclusive_above_and_drop_nulls(spark):
    rows = [(0, 0, 99), (29, 59, 99), (30, 0, 0), (0, 60, 0), (-1, 0, 0), (0, None, None)]
    df = spark.createDataFrame(rows, "time_to_ship int, carrier_time int, total_delivery_time int")
    assert logistics.valid_logistics(df).count() == 2
    assert logistics.valid_logistics_by_total(df).count() == 4
    delays = spark.createDataFrame([(-20,), (-19,), (19,), (20,), (None,)], "delay_days int")
    assert logistics.within_delay_view(delays).count() == 2


def test_median_matches_numpy(lines):
    rows = logistics.within_delay_view(lines).select("customer_state", "delay_days").collect()
    for row in logistics.median_delay_by_state(lines).collect():
        days = [r.delay_days for r in rows if r.customer_state == row.customer_state]
        assert row.median_delay_days == np.median(days)


def test_top_cities_break_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "customer_city string")
    found = [row.customer_city for row in logistics.top_cities(df, k=2).collect()]
    assert found == ["c", "a"]


def test_hot_order_is_counted_before_the_join(weighted):
    plan = weighted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Aggregate [order_id")


def test_national_rate_is_unweighted(spark):
    df = spark.createDataFrame(
        [("x", 5)] * 1 + [("y", 0)] * 3, "customer_state string, delay_days int"
    )
    row = logistics.late_rate_national(df).first()
    assert (row.mean_of_states_pct, row.weighted_pct) == (50.0, 25.0)
    assert df.select(F.count("*")).first()[0] == 4
