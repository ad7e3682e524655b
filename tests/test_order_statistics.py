import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.operators import order_statistics, vendors

ODD = [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, math.inf, -math.inf, 1.5, 1.5, 1.5]


def doubles(seed, count):
    choice = random.Random(seed)
    return [choice.choice((1, -1)) * math.exp(choice.gauss(0, 8)) for _ in range(count)] + ODD


def spread(values, at):
    low, high = math.floor(at), math.ceil(at)
    return values[low] if low == high else (high - at) * values[low] + (at - low) * values[high]


def test_quantiles_of_groups_equal_sorting(spark):
    groups = {"a": doubles(1, 4000), "b": doubles(2, 3), "c": [7.25], "d": [-1.0, -2.0, -3.5]}
    rows = [(g, v) for g, values in groups.items() for v in values]
    rows += [("a", None), ("a", math.nan), (None, 4.0), ("e", None)]
    table = spark.createDataFrame(rows, "g string, v double").repartition(7).checkpoint()
    wanted = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = order_statistics.exact_quantiles(table, "v", wanted, ("g",)).collect()
    assert {r.g for r in found} == set(groups)
    for row in found:
        values = sorted(groups[row.g])
        for k, q in enumerate(wanted):
            expected = spread(values, q * (len(values) - 1))
            assert row[f"q{k}"] == expected or (math.isnan(expected) and math.isnan(row[f"q{k}"]))
    same = table.where("g = 'a' and not isnan(v)").agg(F.percentile("v", 0.9)).first()[0]
    assert same == next(r.q3 for r in found if r.g == "a")


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_whole_values_weights_and_far_ends(spark, kind):
    edge = 2**63 - 1 if kind == "bigint" else 2**31 - 1
    values = [-edge - 1, -edge, -3, 0, 0, 2, 5, edge]
    table = spark.createDataFrame([(v, i % 3 + 1) for i, v in enumerate(values)], f"v {kind}, w int")
    table = table.checkpoint()
    every = sorted(v for i, v in enumerate(values) for _ in range(i % 3 + 1))
    ranks = spark.range(-1, len(every) + 2).withColumnRenamed("id", "rank")
    found = order_statistics.select_ranks(table, "v", ranks, weight="w").collect()
    assert {r["rank"]: r.v for r in found} == dict(enumerate(every))


def test_no_values(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert order_statistics.exact_quantiles(empty, "v", (0.5,), ("g",)).collect() == []
    assert [tuple(r) for r in order_statistics.exact_quantiles(empty, "v", (0.5,)).collect()] == [(None,)]


def test_no_single_task_sees_the_rows(spark):
    sellers = spark.range(50_000).select(
        F.col("id").cast("string").alias("seller_id"),
        F.pmod(F.hash("id"), F.lit(977)).cast("bigint").alias("lines"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(99991)) / 7).alias("mean_time_to_ship"),
        F.lit(4.0).alias("mean_review"),
    ).checkpoint()
    ranks = spark.range(1).select(F.lit(100).cast("bigint").alias("rank"))
    plan = order_statistics.select_ranks(sellers, "mean_time_to_ship", ranks)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
    frame = vendors.vendor_risk(sellers).toPandas()
    raw = sellers.toPandas()
    limits = [np.sort(raw[c])[math.ceil(0.75 * len(raw)) - 1] for c in ("lines", "mean_time_to_ship")]
    risky = (raw.lines >= limits[0]) & (raw.mean_time_to_ship >= limits[1])
    assert frame.at_risk.sum() == risky.sum() > 0
