"""Delivery stages, lateness and transit times.

Everything here depends on the order alone, so it runs on order lines or, much
cheaper, on orders that carry their number of lines (``weighted_orders``). In
the second case pass that column as ``weight``; the results are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions.calendar import whole_days
from stockloom.operators.star import parse_timestamps


def weighted_orders(tables: dict[str, DataFrame]) -> DataFrame:
    """Orders that have lines, with their stage days, customer columns and ``order_lines``.

    Lines are counted per order before they are joined, so an order with very
    many lines moves as one row per task, and stage days are computed once per
    order instead of once per line. Without a customers table those columns are
    left out.
    """
    counts = tables["order_items"].groupBy("order_id").agg(F.count(F.lit(1)).alias("order_lines"))
    staged = add_stage_days(parse_timestamps(tables["orders"]))
    placed = staged.join(counts, "order_id", "inner")
    if "customers" not in tables:
        return placed
    return placed.join(tables["customers"], "customer_id", "left")


def rows_of(weight: str | None) -> Column:
    """Order lines a row stands for."""
    return F.lit(1) if weight is None else F.col(weight)


def weighted_mean(value: str, weight: str | None) -> Column:
    """Mean over order lines; nulls do not count."""
    if weight is None:
        return F.avg(value)
    counted = F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))
    return F.try_divide(F.sum(F.col(value) * F.col(weight)), counted)


def add_stage_days(lines: DataFrame) -> DataFrame:
    """Whole days of each stage: seller, carrier, in total, and past the estimate."""
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    handed_over = F.col("order_delivered_carrier_date")
    return lines.withColumns(
        {
            "time_to_ship": whole_days(F.col("order_approved_at"), handed_over),
            "carrier_time": whole_days(handed_over, delivered),
            "total_delivery_time": whole_days(purchased, delivered),
            "delay_days": whole_days(F.col("order_estimated_delivery_date"), delivered),
        }
    )


def is_late(delay_days: str = "delay_days") -> Column:
    """At least one whole day late. Lines never delivered are not late."""
    return F.coalesce(F.col(delay_days) > 0, F.lit(False))


def valid_logistics(staged: DataFrame, ship_days: int = 30, carrier_days: int = 60) -> DataFrame:
    """Lines with both stage times present, not negative, and under the given days."""
    ship, carrier = F.col("time_to_ship"), F.col("carrier_time")
    return staged.where((ship >= 0) & (ship < ship_days) & (carrier >= 0) & (carrier < carrier_days))


def valid_logistics_by_total(staged: DataFrame) -> DataFrame:
    """The older rule: stage times not negative, total under 100 days."""
    return staged.where(
        (F.col("time_to_ship") >= 0)
        & (F.col("carrier_time") >= 0)
        & (F.col("total_delivery_time") < 100)
    )


def within_delay_view(staged: DataFrame, days: int = 20) -> DataFrame:
    """Delays strictly between -``days`` and ``days``; undelivered lines are left out."""
    return staged.where(F.abs("delay_days") < days)


def value_counts(
    df: DataFrame, value: str, by: str | None = None, weight: str | None = None
) -> DataFrame:
    """How many lines hold each non-null value, optionally per non-null group."""
    present = F.col(value).isNotNull()
    keys = [value] if by is None else [by, value]
    if by is not None:
        present = present & F.col(by).isNotNull()
    return df.where(present).groupBy(*keys).agg(F.sum(rows_of(weight)).alias("lines"))


def median_delay_by_state(
    staged: DataFrame, state: str = "customer_state", weight: str | None = None
) -> DataFrame:
    """Median delay per state within the view, largest first.

    Lines are first counted per state and day value, so the median works on at
    most 39 weighted values per state however many lines a state has.
    """
    counted = value_counts(within_delay_view(staged), "delay_days", state, weight)
    return (
        counted.groupBy(state)
        .agg(F.percentile("delay_days", 0.5, F.col("lines")).alias("median_delay_days"))
        .orderBy(F.desc("median_delay_days"), state)
    )


def late_rate_by_state(
    staged: DataFrame, state: str = "customer_state", weight: str | None = None
) -> DataFrame:
    """Share of late lines per state in percent, over all lines, highest first."""
    late = F.sum(F.when(is_late(), rows_of(weight)).otherwise(0))
    lines = F.sum(rows_of(weight))
    return (
        staged.where(F.col(state).isNotNull())
        .groupBy(state)
        .agg(
            (late / lines * 100.0).alias("late_pct"),
            late.alias("late_lines"),
            lines.alias("lines"),
        )
        .orderBy(F.desc("late_pct"), state)
    )


def late_rate_national(
    staged: DataFrame, state: str = "customer_state", weight: str | None = None
) -> DataFrame:
    """The unweighted mean of the state rates, and beside it the share over all those lines."""
    return late_rate_by_state(staged, state, weight).agg(
        F.avg("late_pct").alias("mean_of_states_pct"),
        (F.sum("late_lines") * 100.0 / F.sum("lines")).alias("weighted_pct"),
    )


def top_cities(
    lines: DataFrame, k: int = 20, city: str = "customer_city", weight: str | None = None
) -> DataFrame:
    """The ``k`` cities with most order lines; nulls do not count; ties go by name."""
    return (
        lines.where(F.col(city).isNotNull())
        .groupBy(city)
        .agg(F.sum(rows_of(weight)).alias("lines"))
        .orderBy(F.desc("lines"), city)
        .limit(k)
    )


def city_delivery_time(
    staged: DataFrame,
    k: int = 20,
    city: str = "customer_city",
    days: str = "total_delivery_time",
    weight: str | None = None,
) -> DataFrame:
    """Mean delivery days of the ``k`` largest cities, slowest first.

    Size and mean come from one aggregation, so the lines are read once.
    """
    per_city = (
        staged.where(F.col(city).isNotNull())
        .groupBy(city)
        .agg(
            F.sum(rows_of(weight)).alias("lines"),
            weighted_mean(days, weight).alias("mean_delivery_days"),
        )
    )
    largest = per_city.orderBy(F.desc("lines"), city).limit(k)
    return largest.orderBy(F.desc_nulls_last("mean_delivery_days"), city)


def state_delivery_time(
    staged: DataFrame, state: str = "customer_state", weight: str | None = None
) -> DataFrame:
    """Mean delivery days per state, slowest first."""
    delivered = F.when(F.col("total_delivery_time").isNotNull(), rows_of(weight)).otherwise(0)
    return (
        staged.where(F.col(state).isNotNull())
        .groupBy(state)
        .agg(
            weighted_mean("total_delivery_time", weight).alias("mean_delivery_days"),
            F.sum(delivered).alias("delivered_lines"),
        )
        .orderBy(F.desc_nulls_last("mean_delivery_days"), state)
    )


def state_logistics_breakdown(
    valid: DataFrame, state: str = "customer_state", weight: str | None = None
) -> DataFrame:
    """Mean seller and carrier days per state and their total, slowest carrier first."""
    return (
        valid.where(F.col(state).isNotNull())
        .groupBy(state)
        .agg(
            weighted_mean("time_to_ship", weight).alias("mean_time_to_ship"),
            weighted_mean("carrier_time", weight).alias("mean_carrier_time"),
        )
        .withColumn("mean_total", F.col("mean_time_to_ship") + F.col("mean_carrier_time"))
        .orderBy(F.desc("mean_carrier_time"), state)
    )


def delivery_composition(valid: DataFrame, weight: str | None = None) -> DataFrame:
    """Overall mean seller and carrier days and the share of each in their sum."""
    means = valid.agg(
        weighted_mean("time_to_ship", weight).alias("mean_time_to_ship"),
        weighted_mean("carrier_time", weight).alias("mean_carrier_time"),
    )
    total = F.col("mean_time_to_ship") + F.col("mean_carrier_time")
    return means.withColumns(
        {
            "mean_total": total,
            "seller_share": F.try_divide(F.col("mean_time_to_ship"), total),
            "carrier_share": F.try_divide(F.col("mean_carrier_time"), total),
        }
    )
