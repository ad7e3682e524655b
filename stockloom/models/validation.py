"""Fit and score a model on strictly future folds."""

from __future__ import annotations

from collections.abc import Callable

from stockloom.models.demand_models import DemandModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.operators.evaluation import fold_roles, forecast_metrics, results_table


def cross_validation_scores(
    features: DataFrame,
    fit: Callable[[DataFrame], DemandModel],
    folds: int = 3,
    horizon_weeks: int = 8,
) -> DataFrame:
    """Error metrics per fold; one fit for each. Pass a materialized feature table."""
    roles = fold_roles(features, folds, horizon_weeks)
    scored = None
    for fold in range(1, folds + 1):
        rows = roles.where(F.col("fold") == fold)
        model = fit(rows.where(F.col("role") == "train"))
        results = results_table(model.transform(rows.where(F.col("role") == "test")))
        results = results.withColumn("fold", F.lit(fold))
        scored = results if scored is None else scored.unionByName(results)
    return forecast_metrics(scored, by=("fold",)).orderBy("fold")
