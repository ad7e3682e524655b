"""Order lines to feature table, with the weekly table as the shared stage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockloom.operators import demand
from stockloom.session import materialize


def weekly_stage(lines: DataFrame) -> DataFrame:
    """The weekly table, computed once: the grid reads it for its rows and for its weeks."""
    return materialize(demand.weekly_demand(lines))


def grid_stage(lines: DataFrame, trim: bool = True) -> DataFrame:
    return demand.demand_grid(weekly_stage(lines), trim=trim)


def feature_table(lines: DataFrame) -> DataFrame:
    """One row per category and observed week with the target and all features."""
    return demand.features_from_grid(grid_stage(lines))
