"""A category as a number: its mean sales over strictly earlier weeks, drawn to the mean of all.

The same tables serve any number of categories; no list of names is on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.operators.demand import CATEGORY, TARGET, WEEK

LEVEL = "category_level"
# Weeks that the mean of all categories counts for.
SMOOTHING = 8.0


def _drawn(total: Column, rows: Column, prior: Column, smoothing: float) -> Column:
    return (total + prior * F.lit(smoothing)) / (rows + F.lit(smoothing))


def add_ordered_levels(train: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """Training rows with the level their category had before their week.

    A row never sees its own week, so its level tells nothing about its target. The mean
    of all categories is also that of earlier weeks, and 0 in the first one. The table of
    weeks has a row per week of the calendar, so it may be ordered at once and broadcast.
    """
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    in_order = before.orderBy(WEEK)
    weeks = train.groupBy(WEEK).agg(F.sum(TARGET).alias("_sum"), F.count(TARGET).alias("_rows"))
    prior = F.coalesce(
        F.try_divide(F.sum("_sum").over(in_order), F.sum("_rows").over(in_order)), F.lit(0.0)
    )
    priors = weeks.select(WEEK, prior.alias("_prior"))
    own = before.partitionBy(CATEGORY).orderBy(WEEK)
    total = F.coalesce(F.sum(TARGET).over(own), F.lit(0)).cast("double")
    level = _drawn(total, F.count(TARGET).over(own), F.col("_prior"), smoothing)
    joined = train.join(F.broadcast(priors), WEEK)
    return joined.withColumn(LEVEL, level).select(*train.columns, LEVEL)


def final_levels(train: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """Each category's level after all training weeks; the null category has that of all."""
    overall = train.agg(F.avg(TARGET)).scalar()
    sums = train.groupBy(CATEGORY).agg(F.sum(TARGET).cast("double").alias("_sum"), F.count(TARGET).alias("_rows"))
    known = sums.where(F.col(CATEGORY).isNotNull()).withColumn("_prior", overall)
    level = _drawn(F.col("_sum"), F.col("_rows"), F.col("_prior"), smoothing)
    rest = train.agg(F.avg(TARGET).alias(LEVEL)).select(F.lit(None).cast("string").alias(CATEGORY), LEVEL)
    return known.select(CATEGORY, level.alias(LEVEL)).unionByName(rest)


def add_levels(rows: DataFrame, levels: DataFrame, unseen: float) -> DataFrame:
    """Rows to be scored with the level of their category, ``unseen`` for unknown ones."""
    joined = rows.join(levels.where(F.col(CATEGORY).isNotNull()), CATEGORY, "left")
    return joined.withColumn(LEVEL, F.coalesce(LEVEL, F.lit(unseen))).select(*rows.columns, LEVEL)
