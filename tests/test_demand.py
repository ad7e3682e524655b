from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockloom.functions import calendar, numeric
from stockloom.operators import demand

LINE_SCHEMA = (
    "order_id string, product_category string, order_purchase_timestamp timestamp_ntz, "
    "price double, freight_value double, seller_id string"
)


def lines_of(spark, rows):
    return spark.createDataFrame(rows, LINE_SCHEMA)


def day(text):
    return datetime.fromisoformat(text)


def by_key(df):
    return {
        (row["product_category"], row["order_purchase_timestamp"]): row for row in df.collect()
    }


def test_weekly_row_semantics(spark):
    rows = [
        ("1", "a", day("2018-01-02"), 10.0, 1.0, "s1"),
        ("1", "a", day("2018-01-03"), None, 2.0, "s1"),
        ("2", "a", day("2018-01-08T09:00"), 20.0, None, None),
        ("3", "b", day("2018-01-04"), None, 3.0, "s2"),
        ("4", "b", None, 5.0, 3.0, "s2"),
    ]
    weekly = by_key(demand.weekly_demand(lines_of(spark, rows)))
    assert len(weekly) == 2
    a = weekly["a", day("2018-01-08")]
    assert (a.quantity_sold, a.revenue, a.curr_avg_price) == (3, 30.0, 15.0)
    assert (a.curr_avg_freight, a.curr_active_sellers) == (1.5, 1)
    b = weekly["b", day("2018-01-08")]
    assert (b.quantity_sold, b.revenue, b.curr_avg_price) == (1, 0.0, None)


def test_grid_zero_fills_only_absent_cells(spark):
    rows = [
        ("1", "a", day("2018-01-02"), None, 1.0, "s"),
        ("2", "b", day("2018-01-02"), 4.0, 1.0, "s"),
        ("3", "a", day("2018-01-23"), 6.0, 1.0, "s"),
    ]
    weekly = demand.weekly_demand(lines_of(spark, rows))
    full = by_key(demand.demand_grid(weekly, trim=False))
    # Weeks two and three had no sale anywhere and do not exist.
    assert len(full) == 4
    assert full["a", day("2018-01-08")].curr_avg_price is None
    silent = full["b", day("2018-01-29")]
    assert (silent.quantity_sold, silent.curr_avg_price, silent.revenue) == (0, 0.0, 0.0)
    lagged = by_key(demand.add_lagged_drivers(demand.demand_grid(weekly)))
    assert lagged["b", day("2018-01-29")].price_lag_1 == 4.0


def test_calendar_weeks_fill_the_gaps(spark):
    rows = [("1", "a", day("2018-01-02"), 2.0, 1.0, "s"), ("2", "a", day("2018-01-23"), 6.0, 1.0, "s")]
    weekly = demand.weekly_demand(lines_of(spark, rows))
    grid = demand.demand_grid(weekly, all_weeks=demand.calendar_weeks(weekly))
    found = by_key(demand.add_sales_lags(grid, (1, 3)))
    assert len(found) == 4
    last = found["a", day("2018-01-29")]
    assert (last.sales_lag_1, last.sales_lag_3) == (0.0, 1.0)


def test_first_sale_late_on_a_monday_trims_its_own_week(spark):
    rows = [
        ("1", "a", day("2018-01-01T10:00"), 1.0, 1.0, "s"),
        ("2", "a", day("2018-01-02"), 1.0, 1.0, "s"),
        ("3", "b", day("2018-01-01T00:00"), 1.0, 1.0, "s"),
    ]
    weekly = demand.weekly_demand(lines_of(spark, rows))
    kept = set(by_key(demand.demand_grid(weekly)))
    assert kept == {
        ("a", day("2018-01-08")),
        ("b", day("2018-01-01")),
        ("b", day("2018-01-08")),
    }
    counts = demand.grid_row_counts(weekly).first()
    assert (counts.grid_rows, counts.kept_rows, counts.dropped_rows) == (4, 3, 1)


def test_short_series_leave_no_features(spark):
    start = day("2018-01-02")
    rows = [
        (str(i), name, start + timedelta(days=7 * i), 1.0, 1.0, "s")
        for name, weeks in (("short", 8), ("long", 9))
        for i in range(9 - weeks, 9)
    ]
    features = demand.features_from_grid(
        demand.demand_grid(demand.weekly_demand(lines_of(spark, rows)))
    )
    assert [row.product_category for row in features.collect()] == ["long"]


def test_undefined_ratios(spark):
    base = spark.createDataFrame(
        [("a", day("2018-01-01"), 0.0, 0.0), ("a", day("2018-01-08"), 0.0, 3.0)],
        "product_category string, order_purchase_timestamp timestamp_ntz, "
        "price_lag_1 double, freight_lag_1 double",
    )
    df = demand.add_price_momentum(demand.add_freight_ratio(base), weeks=1)
    found = [(row.freight_ratio, row.price_momentum) for row in df.collect()]
    assert found == [(0.0, 1.0), (0.0, 1.0)]


def random_lines(seed):
    rng = np.random.default_rng(seed)
    start = datetime(2016, 9, 5)
    rows = []
    for i in range(900):
        # One category holds a third of all lines, some weeks are empty for all.
        category = "hot" if rng.random() < 0.34 else f"c{rng.integers(0, 6)}"
        week = int(rng.integers(0, 40))
        if week in (7, 8, 21):
            continue
        at = start + timedelta(days=7 * week, hours=int(rng.integers(0, 168)))
        price = None if rng.random() < 0.2 else float(rng.integers(1, 5000)) / 100
        freight = float(rng.integers(1, 900)) / 100
        seller = None if rng.random() < 0.1 else f"s{rng.integers(0, 9)}"
        rows.append((str(i // 2), category, at, price, freight, seller))
    return rows


def features_by_loops(rows):
    """The definition, written out over plain lists, one category at a time."""

    def label(at):
        days = (7 - at.weekday()) % 7
        return datetime(at.year, at.month, at.day) + timedelta(days=days)

    cells, first = {}, {}
    for row in rows:
        key = (row[1], label(row[2]))
        cells.setdefault(key, []).append(row)
        first[row[1]] = min(first.get(row[1], row[2]), row[2])
    weeks = sorted({week for _, week in cells})
    found = {}
    for category in first:
        series = []
        for week in weeks:
            if week < first[category]:
                continue
            got = cells.get((category, week))
            if got is None:
                series.append((week, 0, 0.0, 0.0, 0))
                continue
            prices = [r[3] for r in got if r[3] is not None]
            sellers = {r[5] for r in got if r[5] is not None}
            price = sum(prices) / len(prices) if prices else None
            series.append((week, len(got), price, sum(r[4] for r in got) / len(got), len(sellers)))
        known_price, price_lags = 0.0, []
        for i, (week, units, price, freight, sellers) in enumerate(series):
            if i > 0 and series[i - 1][2] is not None:
                known_price = series[i - 1][2]
            price_lags.append(known_price)
            if i < 8 or price is None:
                continue
            past = [series[i - k][1] for k in range(1, 5)]
            mean_price = sum(price_lags[-4:]) / 4
            found[category, week] = {
                "quantity_sold": units,
                "price_lag_1": known_price,
                "freight_lag_1": series[i - 1][3],
                "sellers_lag_1": series[i - 1][4],
                "freight_ratio": series[i - 1][3] / known_price if known_price else 0.0,
                "price_roll_mean_4": mean_price,
                "price_momentum": known_price / mean_price if mean_price else 1.0,
                "sales_lag_1": past[0],
                "sales_lag_4": past[3],
                "sales_lag_8": series[i - 8][1],
                "sales_roll_mean_4": np.mean(past),
                "sales_roll_std_4": np.std(past, ddof=1),
            }
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_features_match_plain_loops(spark, seed):
    rows = random_lines(seed)
    weekly = demand.weekly_demand(lines_of(spark, rows))
    found = by_key(demand.features_from_grid(demand.demand_grid(weekly)))
    expected = features_by_loops(rows)
    assert set(found) == set(expected)
    for key, values in expected.items():
        for name, value in values.items():
            assert found[key][name] == pytest.approx(value, abs=1e-9), (key, name)


def test_feature_columns(spark):
    weekly = demand.weekly_demand(lines_of(spark, random_lines(3)))
    features = demand.features_from_grid(demand.demand_grid(weekly))
    others = {"order_purchase_timestamp", "year", "quantity_sold"}
    assert set(features.columns) == set(demand.MODEL_FEATURES) | others
    assert len(features.columns) == 22


def test_grid_size_and_units(spark):
    rows = random_lines(4)
    weekly = demand.weekly_demand(lines_of(spark, rows))
    grid = demand.demand_grid(weekly, trim=False)
    categories = len({row[1] for row in rows})
    assert grid.count() == categories * demand.observed_weeks(weekly).count()
    assert grid.agg(F.sum("quantity_sold")).first()[0] == len(rows)


def test_split_leaves_later_years_out(spark):
    df = spark.createDataFrame(
        [(2017, 12), (2018, 5), (2018, 6), (2018, 12), (2019, 1)], "year int, month int"
    )
    assert demand.train_rows(df).count() == 2
    assert demand.test_rows(df).count() == 2
    parts = [row.part for row in demand.with_part(df).orderBy("year", "month").collect()]
    assert parts == ["train", "train", "test", "test", None]


def test_grid_plan_has_one_shuffle_by_category_and_no_product(spark):
    weekly = demand.weekly_demand(lines_of(spark, random_lines(5))).checkpoint()
    features = demand.features_from_grid(demand.demand_grid(weekly))
    plan = features._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery subquery")[0]
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert main.count("Exchange hashpartitioning(product_category") <= 1
    assert plan.count("Exchange hashpartitioning(product_category") == 1


def exchanged_types(df):
    """Types of all columns that go through a shuffle of the planned query."""
    found = []

    def visit(node):
        if "Exchange" in node.nodeName():
            found.extend(f.dataType().typeName() for f in _seq(node.schema()))
        for child in _seq(node.children()):
            visit(child)

    def _seq(s):
        return [s.apply(i) for i in range(s.size())]

    plan = df._jdf.queryExecution().executedPlan()
    visit(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return found


def test_no_array_goes_through_a_shuffle(spark):
    weekly = demand.weekly_demand(lines_of(spark, random_lines(5))).checkpoint()
    for trim in (True, False):
        features = demand.features_from_grid(demand.demand_grid(weekly, trim=trim))
        kinds = exchanged_types(features)
        assert kinds and not {"array", "map"} & set(kinds)


def test_week_numbers_are_dense_and_turn_back(spark):
    weeks = spark.sql(
        "select explode(sequence(timestamp_ntz'1969-12-01', timestamp_ntz'1970-03-02', interval 7 day)) as w"
    )
    rows = weeks.select(
        calendar.week_number(F.col("w")).alias("n"),
        calendar.week_of_number(calendar.week_number(F.col("w"))).alias("back"),
        "w",
    ).collect()
    assert [r.n for r in rows] == list(range(rows[0].n, rows[0].n + len(rows)))
    assert all(r.back == r.w for r in rows)


def test_pandas_frame_of_features_is_finite(spark):
    weekly = demand.weekly_demand(lines_of(spark, random_lines(6)))
    frame = demand.features_from_grid(demand.demand_grid(weekly)).toPandas()
    numbers = frame.select_dtypes("number")
    assert np.isfinite(numbers.to_numpy()).all()
    assert not frame.isna().any().any()
    assert isinstance(frame, pd.DataFrame)


def test_money_is_summed_unrounded_and_nan_is_skipped(spark):
    rows = [0.00004, 0.00004, 1.23454, float("nan"), None]
    prices = spark.createDataFrame([(p,) for p in rows], "price double")
    found = prices.agg(
        numeric.exact_sum(F.col("price")).alias("total"),
        F.count(numeric.money(F.col("price"))).alias("n"),
    ).first()
    assert found.total == 1.23462 and found.n == 3
