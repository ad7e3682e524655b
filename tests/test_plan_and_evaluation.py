from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockloom.operators import evaluation, inventory, vendors

# Published plan rows as demand, deviation, safety stock, reorder point.
PLAN_ROWS = [
    (103.0, 56.93856338194697, 133.0, 339.0),
    (99.0, 65.90586721478853, 154.0, 352.0),
    (83.0, 31.447045436203826, 74.0, 240.0),
    (82.0, 43.47413023856832, 102.0, 266.0),
]

SCORED = (
    "product_category string, prediction double, price_lag_1 double, sales_roll_std_4 double"
)


def test_published_plan_rows(spark):
    rows = [(f"c{i}", d, 1.0, s) for i, (d, s, _, _) in enumerate(PLAN_ROWS)]
    plan = inventory.reorder_plan(spark.createDataFrame(rows, SCORED)).collect()
    assert [(r.predicted_weekly_demand, r.demand_std_dev, r.safety_stock, r.reorder_point)
            for r in plan] == PLAN_ROWS
    assert plan[0].order_recommendation == "Maintain ~339 units"


def test_demand_is_rounded_up_and_missing_deviation_is_the_demand(spark):
    rows = [("a", 2.1, 5.0, None), ("b", 3.0, 5.0, 0.0)]
    plan = inventory.reorder_plan(spark.createDataFrame(rows, SCORED)).collect()
    assert [r.product_category for r in plan] == ["a", "b"]
    assert (plan[0].predicted_weekly_demand, plan[0].demand_std_dev) == (3.0, 3.0)
    assert plan[0].safety_stock == 7.0
    assert plan[1].order_recommendation == "Maintain ~6 units"


@pytest.mark.parametrize("level, z", [(0.95, 1.645), (0.9, 1.28), (0.99, 1.28)])
def test_service_levels(level, z):
    assert inventory.z_score(level) == z


def results(spark):
    start = datetime(2018, 6, 4)
    rows = [
        (start + timedelta(days=7 * week), name, sold, guess)
        for week in range(3)
        for name, sold, guess in (("a", 10, 8.0), ("b", 4, 5.0), ("c", 0, 1.0), ("d", 4, 4.0))
    ]
    return spark.createDataFrame(
        rows, "date timestamp_ntz, category string, actual int, predicted double"
    )


def test_metrics(spark):
    row = evaluation.forecast_metrics(results(spark)).first()
    assert row["rows"] == 12
    assert row.mae == pytest.approx(1.0)
    assert row.rmse == pytest.approx(1.5**0.5)
    assert row.wmape == pytest.approx(4 / 18)
    groups = {
        r.category: r for r in evaluation.forecast_metrics(results(spark), ("category",)).collect()
    }
    assert groups["c"].wmape is None and groups["d"].mae == 0.0


def test_top_categories_and_their_weeks(spark):
    best = [r.category for r in evaluation.top_categories(results(spark), k=2).collect()]
    assert best == ["a", "b"]
    weeks = evaluation.top_category_forecasts(results(spark), k=2)
    assert weeks.count() == 6
    total = evaluation.global_forecast_by_week(results(spark)).first()
    assert (total.actual, total.predicted) == (18, 18.0)


def test_folds_only_test_the_future(spark):
    start = datetime(2018, 1, 1)
    features = spark.createDataFrame(
        [(start + timedelta(days=7 * i), i) for i in range(30)],
        "order_purchase_timestamp timestamp_ntz, quantity_sold int",
    )
    roles = evaluation.fold_roles(features, folds=3, horizon_weeks=4)
    rows = evaluation.fold_summary(roles).collect()
    assert [(r.train_rows, r.test_rows) for r in rows] == [(18, 4), (22, 4), (26, 4)]
    week = F.col("order_purchase_timestamp")
    wrong = roles.where((F.col("role") == "test") & (week <= F.col("train_end")))
    assert wrong.count() == 0


def test_routes_keep_every_row(spark):
    routed = evaluation.routed_forecasts({"x": results(spark), "y": results(spark)})
    assert routed.groupBy("route").count().count() == 2 and routed.count() == 24


def test_vendor_flags_need_volume_and_slowness(spark):
    rows = [(s, ship, 5.0) for s, ship, n in ((1, 9, 8), (2, 1, 9), (3, 8, 1), (4, 2, 2))
            for _ in range(n)]
    df = spark.createDataFrame(rows, "seller_id int, time_to_ship int, review_score double")
    flagged = vendors.vendor_risk(vendors.seller_summary(df)).where("at_risk").collect()
    assert [r.seller_id for r in flagged] == [1]


def test_reviews_do_not_multiply_lines(spark):
    lines = spark.createDataFrame([(1, 3), (1, 4), (2, 5)], "order_id int, time_to_ship int")
    reviews = spark.createDataFrame([(1, 5), (1, 1)], "order_id int, review_score int")
    joined = vendors.reviewed_lines(lines, reviews)
    assert sorted((r.order_id, r.review_score) for r in joined.where("order_id = 1").collect()) == [
        (1, 3.0), (1, 3.0)
    ]
    assert joined.count() == 3
