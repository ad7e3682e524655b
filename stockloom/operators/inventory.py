"""From a weekly forecast to safety stock and reorder points."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.operators.demand import CATEGORY

# Normal quantile at the 95 % service level, and for every other level.
Z_AT_95 = 1.645
Z_OTHERWISE = 1.28

PLAN_COLUMNS = (
    "product_category",
    "predicted_weekly_demand",
    "current_price",
    "demand_std_dev",
    "safety_stock",
    "reorder_point",
    "order_recommendation",
)


def z_score(service_level: float) -> float:
    return Z_AT_95 if service_level == 0.95 else Z_OTHERWISE


def reorder_plan(
    scored: DataFrame,
    prediction: str = "prediction",
    service_level: float = 0.95,
    lead_time_weeks: int = 2,
) -> DataFrame:
    """One plan row per scored row, highest demand first.

    Safety stock covers the deviation of demand over the lead time; a missing
    deviation is taken to be as large as the demand itself.
    """
    cover = z_score(service_level) * math.sqrt(lead_time_weeks)
    demand = F.col("predicted_weekly_demand")
    return (
        scored.select(
            CATEGORY,
            F.ceil(prediction).cast("double").alias("predicted_weekly_demand"),
            F.col("price_lag_1").alias("current_price"),
            F.col("sales_roll_std_4").alias("demand_std_dev"),
        )
        .withColumn("demand_std_dev", F.coalesce("demand_std_dev", demand))
        .withColumn(
            "safety_stock", F.ceil(F.lit(cover) * F.col("demand_std_dev")).cast("double")
        )
        .withColumn("reorder_point", demand * F.lit(float(lead_time_weeks)) + F.col("safety_stock"))
        .withColumn(
            "order_recommendation",
            F.format_string("Maintain ~%d units", F.col("reorder_point").cast("bigint")),
        )
        .select(*PLAN_COLUMNS)
        .orderBy(F.desc("predicted_weekly_demand"), CATEGORY)
    )
