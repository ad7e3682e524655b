"""Trend and yearly season per category, with a forecast and its interval."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.operators.demand import CATEGORY, TARGET, WEEK

FORECAST_SCHEMA = (
    f"{CATEGORY} string, {WEEK} timestamp_ntz, actual double, trend double, seasonal double, "
    "predicted double, lower double, upper double, is_forecast boolean"
)


def _design(days: np.ndarray, origin: float, span: float, harmonics: int) -> np.ndarray:
    angle = 2.0 * np.pi * days / 365.25
    waves = [f(k * angle) for k in range(1, harmonics + 1) for f in (np.sin, np.cos)]
    return np.column_stack([np.ones_like(days), (days - origin) / span, *waves])


def seasonal_baseline(
    grid: DataFrame, horizon_weeks: int = 13, harmonics: int = 2, z: float = 1.28
) -> DataFrame:
    """Fitted weeks and ``horizon_weeks`` further ones (13 weeks are about 90 days) per category.

    One small least-squares fit per category: a linear trend and yearly waves.
    The interval is ``z`` residual deviations wide on each side. A group holds
    one row per week of one category, so its size is bounded by the calendar.
    """

    def fit(series: pd.DataFrame) -> pd.DataFrame:
        series = series.sort_values(WEEK)
        weeks = series[WEEK].to_numpy(dtype="datetime64[ns]")
        future = weeks[-1] + np.arange(1, horizon_weeks + 1) * np.timedelta64(7, "D")
        every = np.concatenate([weeks, future])
        days = (every - np.datetime64("1970-01-01")) / np.timedelta64(1, "D")
        known = len(weeks)
        span = max(days[known - 1] - days[0], 1.0)
        design = _design(days, days[0], span, harmonics)
        actual = series[TARGET].to_numpy(dtype=float)
        weights = np.linalg.lstsq(design[:known], actual, rcond=None)[0]
        trend = design[:, :2] @ weights[:2]
        seasonal = design[:, 2:] @ weights[2:]
        predicted = trend + seasonal
        free = max(known - design.shape[1], 1)
        spread = z * np.sqrt(np.sum((actual - predicted[:known]) ** 2) / free)
        return pd.DataFrame(
            {
                CATEGORY: series[CATEGORY].iloc[0],
                WEEK: every,
                "actual": np.concatenate([actual, np.full(horizon_weeks, np.nan)]),
                "trend": trend,
                "seasonal": seasonal,
                "predicted": np.maximum(predicted, 0.0),
                "lower": np.maximum(predicted - spread, 0.0),
                "upper": np.maximum(predicted + spread, 0.0),
                "is_forecast": np.arange(len(every)) >= known,
            }
        )

    series = grid.select(CATEGORY, WEEK, F.col(TARGET).cast("double").alias(TARGET))
    return series.groupBy(CATEGORY).applyInPandas(fit, FORECAST_SCHEMA)
