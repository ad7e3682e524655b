from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.operators import profile
from stockloom.operators.logistics import value_counts


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_months_without_rows_are_zero(spark):
    rows = [
        (datetime(2018, 1, 5), 2.5),
        (datetime(2018, 1, 31, 23), None),
        (datetime(2018, 4, 1), 4.0),
        (None, 9.0),
    ]
    df = spark.createDataFrame(rows, "order_purchase_timestamp timestamp_ntz, price double")
    found = [(r.month_end, r.revenue) for r in profile.monthly_revenue(df).collect()]
    assert found == [
        (datetime(2018, 1, 31), 2.5),
        (datetime(2018, 2, 28), 0.0),
        (datetime(2018, 3, 31), 0.0),
        (datetime(2018, 4, 30), 4.0),
    ]


@pytest.mark.parametrize("bins", [1, 7, 20, 40])
def test_histogram_matches_numpy(spark, bins):
    rng = np.random.default_rng(bins)
    for values, kind in (
        ([int(v) for v in rng.integers(0, 30, 400)], "int"),
        ([float(v) for v in rng.normal(0, 3, 400)], "double"),
        ([4, 4, 4], "int"),
    ):
        counts = value_counts(column(spark, [*values, None], kind), "x")
        rows = profile.histogram(counts, "x", bins).collect()
        expected, edges = np.histogram(values, bins=bins)
        assert [r.lines for r in rows] == list(expected)
        assert [r.bin_start for r in rows] == pytest.approx(list(edges[:-1]))
        assert rows[-1].bin_end == pytest.approx(edges[-1])


def test_density_matches_the_direct_sum(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(0, 20, 300).astype(float)
    counts = value_counts(column(spark, [float(v) for v in values]), "x")
    rows = profile.kernel_density(counts, "x", points=50).collect()
    width = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 50)
    z = (grid[:, None] - values[None, :]) / width
    expected = np.exp(-0.5 * z**2).sum(axis=1) / (len(values) * width * np.sqrt(2 * np.pi))
    assert [r.x for r in rows] == pytest.approx(list(grid))
    assert [r.density for r in rows] == pytest.approx(list(expected))


def test_binned_density_is_within_its_bound_of_the_direct_sum(spark):
    values = np.random.default_rng(6).gamma(2.0, 3.0, 3000)
    rows = [(float(v),) for v in values] + [(None,), (float("nan"),)]
    found = profile.binned_kernel_density(spark.createDataFrame(rows, "x double"), "x").collect()
    width = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 200)
    z = (grid[:, None] - values[None, :]) / width
    direct = np.exp(-0.5 * z**2).sum(axis=1) / (len(values) * width * np.sqrt(2 * np.pi))
    step = (values.max() - values.min()) / (199 * 32)
    bound = step**2 / (8 * width**3 * np.sqrt(2 * np.pi))
    assert [r.x for r in found] == pytest.approx(list(grid))
    assert np.abs(np.array([r.density for r in found]) - direct).max() <= bound
    for same in ([], [3.0], [3.0, 3.0]):
        few = spark.createDataFrame([(v,) for v in same], "x double")
        assert profile.binned_kernel_density(few, "x").collect() == []


def test_boxplot_matches_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [("a", int(v)) for v in rng.integers(-5, 6, 200)] + [("a", 19), ("a", -19)]
    rows += [("b", 3), (None, 1), ("b", None)]
    df = spark.createDataFrame(rows, "customer_state string, delay_days int")
    found = {r.customer_state: r for r in profile.delay_boxplot(df).collect()}
    values = np.array([v for s, v in rows if s == "a"])
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
    a = found["a"]
    assert (a.q1, a.median, a.q3) == (q1, median, q3)
    assert (a.whisker_low, a.whisker_high) == (inside.min(), inside.max())
    assert (a.outliers, a.lines) == (len(values) - len(inside), len(values))
    assert (found["b"].median, found["b"].outliers) == (3.0, 0)


def test_weekday_pivot_order_and_empty_cells(spark):
    stamps = [datetime(2018, 1, 7, 5), datetime(2018, 1, 1, 0), datetime(2018, 1, 1, 0, 59)]
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    rows = profile.weekday_hour_pivot(df, "ts").collect()
    assert [r.day_of_week for r in rows][:2] == ["Monday", "Tuesday"]
    assert (rows[0].h00, rows[0].h01, rows[6].h05) == (2, None, 1)
    assert len(rows) == 7 and len(rows[0]) == 26


def test_payment_share_skips_nulls_and_sums_to_one(spark):
    kinds = ["card"] * 5 + ["boleto"] * 2 + ["voucher"] + [None] * 4
    df = spark.createDataFrame([(k,) for k in kinds], "payment_type string")
    rows = profile.payment_share(df).collect()
    assert [(r.payment_type, r.payments, r.share_pct) for r in rows] == [
        ("card", 5, 62.5),
        ("boleto", 2, 25.0),
        ("voucher", 1, 12.5),
    ]


def test_bootstrap_interval_is_close_to_the_normal_one_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [("a", int(v)) for v in rng.poisson(9, 800)] + [("b", int(v)) for v in rng.poisson(3, 50)]
    df = spark.createDataFrame(rows, "city string, days int")
    drawn = profile.bootstrap_mean_interval(df, "days", "city").collect()
    again = profile.bootstrap_mean_interval(df.repartition(3), "days", "city").collect()
    normal = profile.normal_mean_interval(df, "days", "city").collect()
    assert drawn == again
    for x, y in zip(drawn, normal):
        assert (x.city, x.lines) == (y.city, y.lines)
        assert x["mean"] == pytest.approx(y["mean"])
        assert x.ci_low == pytest.approx(y.ci_low, abs=0.12)
        assert x.ci_high == pytest.approx(y.ci_high, abs=0.12)


def test_bootstrap_of_continuous_values_and_heavy_ones(spark):
    rng = np.random.default_rng(9)
    values = rng.gamma(3.0, 2.0, 400)
    rows = [("a", float(v), 1) for v in values] + [("b", 2.0, 5000), ("b", 4.0, 7), (None, 1.0, 1), ("a", None, 3)]
    df = spark.createDataFrame(rows, "city string, days double, w int")
    found = {r.city: r for r in profile.bootstrap_mean_interval(df, "days", "city", weight="w").collect()}
    half = 1.96 * values.std(ddof=1) / np.sqrt(len(values))
    assert found["a"].ci_low == pytest.approx(values.mean() - half, abs=0.2 * half)
    assert found["a"].ci_high == pytest.approx(values.mean() + half, abs=0.2 * half)
    assert found["b"].lines == 5007 and 2.0 <= found["b"].ci_low <= found["b"].ci_high < 2.01
    assert set(found) == {"a", "b"}


def test_poisson_numbers_have_mean_and_variance_one(spark):
    draws = spark.range(40_000).select(profile._poisson_one(profile._uniform("id")).alias("k"))
    row = draws.agg(F.avg("k").alias("m"), F.var_samp("k").alias("v"), F.avg((F.col("k") == 0).cast("int")).alias("z")).first()
    assert row.m == pytest.approx(1.0, abs=0.02) and row.v == pytest.approx(1.0, abs=0.04)
    assert row.z == pytest.approx(np.exp(-1.0), abs=0.01)


def test_histogram_counts_sum_to_weights(spark):
    df = spark.range(500).select((F.col("id") % 37).alias("x"), F.lit(3).alias("w"))
    counts = value_counts(df, "x", weight="w")
    assert profile.histogram(counts, "x", 9).agg(F.sum("lines")).first()[0] == 1500


def test_density_of_values_without_spread_is_empty(spark):
    for values in ([], [3], [3, 3, 3]):
        rows = spark.createDataFrame([(v,) for v in values], "v int")
        counts = value_counts(rows, "v")
        assert profile.kernel_density(counts, "v").collect() == []
