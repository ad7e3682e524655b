"""Seller risk and customer dissatisfaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.operators.order_statistics import lower_quantile


def order_reviews(reviews: DataFrame) -> DataFrame:
    """One mean score per order, so that joining reviews cannot multiply order lines."""
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))


def reviewed_lines(staged: DataFrame, reviews: DataFrame) -> DataFrame:
    """Order lines with the score of their order, null where there is none."""
    return staged.join(order_reviews(reviews), "order_id", "left")


def seller_summary(reviewed: DataFrame) -> DataFrame:
    """Volume, mean seller days and mean score per seller."""
    return (
        reviewed.where(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.avg("time_to_ship").alias("mean_time_to_ship"),
            F.avg("review_score").alias("mean_review"),
        )
    )


def vendor_risk(sellers: DataFrame, quantile: float = 0.75) -> DataFrame:
    """Flags the risky sellers of a ``seller_summary``.

    A seller is at risk when volume and seller days are both at or above their
    ``quantile`` over all sellers, exactly at any number of sellers: ranks are found by
    counting digits, so no task orders the sellers. ``sellers`` is read several times:
    pass a materialized table.
    """
    volume = lower_quantile(sellers, "lines", quantile)
    days = lower_quantile(sellers, "mean_time_to_ship", quantile)
    risky = (F.col("lines") >= F.col("_volume")) & (F.col("mean_time_to_ship") >= F.col("_days"))
    return (
        sellers.withColumns({"_volume": volume, "_days": days})
        .withColumn("at_risk", F.coalesce(risky, F.lit(False)))
        .drop("_volume", "_days")
        .orderBy(F.desc("at_risk"), F.desc("lines"), "seller_id")
    )


def ship_review_corr(reviewed: DataFrame) -> DataFrame:
    """Correlation of seller days, and of total delivery days, with the review score."""
    scored = reviewed.where(F.col("review_score").isNotNull())
    return scored.agg(
        F.count(F.lit(1)).alias("reviewed_lines"),
        F.corr("time_to_ship", "review_score").alias("corr_ship"),
        F.corr("total_delivery_time", "review_score").alias("corr_total"),
    )


def dissatisfaction_rate(
    scored: DataFrame, by: str, score: str = "review_score", low: int = 2
) -> DataFrame:
    """Share of scores of ``low`` or less per group in percent, highest first."""
    poor = F.col(score) <= low
    return (
        scored.where(F.col(score).isNotNull() & F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.count_if(poor).alias("low_reviews"),
            (F.count_if(poor) * 100.0 / F.count(F.lit(1))).alias("dissatisfied_pct"),
        )
        .orderBy(F.desc("dissatisfied_pct"), by)
    )
