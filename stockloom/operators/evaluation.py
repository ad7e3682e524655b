"""Forecast results: error metrics and the tables behind the evaluation charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.operators.demand import CATEGORY, TARGET, WEEK


def results_table(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Date, category, actual, predicted and error of scored feature rows."""
    return scored.select(
        F.col(WEEK).alias("date"),
        F.col(CATEGORY).alias("category"),
        F.col(TARGET).alias("actual"),
        F.col(prediction).alias("predicted"),
        (F.col(TARGET) - F.col(prediction)).alias("error"),
    )


def forecast_metrics(results: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """MAE, RMSE, WMAPE and R2, over everything or per group.

    WMAPE is the summed absolute error over summed sales, null without sales.
    """
    error = F.col("actual") - F.col("predicted")
    absolute, squared = F.abs(error), error * error
    actual = F.col("actual").cast("double")
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(absolute).alias("mae"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        F.try_divide(F.sum(absolute), F.sum(actual)).alias("wmape"),
        (1.0 - F.try_divide(F.avg(squared), F.var_pop(actual))).alias("r2"),
    )


def global_forecast_by_week(results: DataFrame) -> DataFrame:
    """Actual and predicted units of all categories per week."""
    return (
        results.groupBy("date")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))
        .orderBy("date")
    )


def top_categories(results: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` categories with most actual sales; ties go by name."""
    return (
        results.groupBy("category")
        .agg(F.sum("actual").alias("actual"))
        .orderBy(F.desc("actual"), "category")
        .limit(k)
    )


def top_category_forecasts(results: DataFrame, k: int = 3) -> DataFrame:
    """Weekly actual and predicted units of the ``k`` best-selling categories.

    The broadcast side has ``k`` rows by construction.
    """
    best = F.broadcast(top_categories(results, k).select("category"))
    return (
        results.join(best, "category", "left_semi")
        .groupBy("category", "date")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))
        .orderBy("category", "date")
    )


def compare_models(scored: DataFrame, predictions: dict[str, str]) -> DataFrame:
    """Error metrics per category and model; ``predictions`` maps a model to its column."""
    tagged = scored.select(
        F.col(CATEGORY).alias("category"),
        F.col(TARGET).alias("actual"),
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(model).alias("model"), F.col(c).alias("predicted"))
                    for model, c in predictions.items()
                )
            )
        ),
    )
    return forecast_metrics(tagged, by=("category", "model"))


def routed_forecasts(routes: dict[str, DataFrame]) -> DataFrame:
    """Results of several models in one table, each under the use it is meant for."""
    tagged = [df.withColumn("route", F.lit(route)) for route, df in routes.items()]
    combined = tagged[0]
    for df in tagged[1:]:
        combined = combined.unionByName(df)
    return combined


def fold_roles(features: DataFrame, folds: int = 3, horizon_weeks: int = 8) -> DataFrame:
    """Time-series folds: each row once per fold in which it is ``train`` or ``test``.

    Fold ``folds`` tests the last ``horizon_weeks`` weeks, each earlier fold the
    block before. Training rows lie strictly before the tested block.
    """
    last_week = features.agg(F.max(WEEK)).scalar()
    marked = features.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))

    def weeks_back(blocks):
        return F.make_dt_interval((blocks * F.lit(7 * horizon_weeks)).cast("int"))

    marked = marked.withColumns(
        {
            "train_end": last_week - weeks_back(F.lit(folds) - F.col("fold") + 1),
            "test_end": last_week - weeks_back(F.lit(folds) - F.col("fold")),
        }
    )
    role = F.when(F.col(WEEK) <= F.col("train_end"), "train").when(
        F.col(WEEK) <= F.col("test_end"), "test"
    )
    return marked.withColumn("role", role).where(F.col("role").isNotNull())


def fold_summary(roles: DataFrame) -> DataFrame:
    """Bounds, row counts and units of each fold."""
    return (
        roles.groupBy("fold", "train_end", "test_end")
        .agg(
            F.count_if(F.col("role") == "train").alias("train_rows"),
            F.count_if(F.col("role") == "test").alias("test_rows"),
            F.sum(F.when(F.col("role") == "train", F.col(TARGET))).alias("train_units"),
            F.sum(F.when(F.col("role") == "test", F.col(TARGET))).alias("test_units"),
        )
        .orderBy("fold")
    )
