"""The whole job: raw tables to line table, features, model, evaluation and plan.

    python -m stockloom.plans.full_run RAW_FOLDER OUT_FOLDER [--format csv|parquet]
        [--files orders=my_orders.csv ...]

Each step reads what the step before wrote, so a failed run can be taken up at
any step, and no step's lineage reaches back to the raw files. A report that fails
is recorded with its error in the table of reports, and the others are written.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from functools import cache, partial

from stockloom.models.demand_models import DemandModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockloom.models import demand_models
from stockloom.models.importance import permutation_importance
from stockloom.operators import demand, evaluation, inventory, logistics, profile, star
from stockloom.session import build_session, materialize
from stockloom.sources import readers, sinks

FITS: dict[str, Callable[[DataFrame], DemandModel]] = {
    "boosted_tweedie": demand_models.fit_boosted_tweedie,
    "boosted_trees": demand_models.fit_boosted_trees,
    "tweedie_regression": demand_models.fit_tweedie_regression,
}


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without a job of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def write_line_table(tables: dict[str, DataFrame], out: str) -> int:
    lines, seen = _counted(star.line_table(tables), "lines")
    sinks.write_parquet(lines, f"{out}/line_table")
    return seen.get["rows"]


def write_features(spark: SparkSession, out: str) -> dict[str, int]:
    """Weekly table, then features. Reports the grid rows dropped as before launch."""
    lines = spark.read.parquet(f"{out}/line_table")
    sinks.write_parquet(demand.weekly_demand(lines), f"{out}/weekly_demand")
    weekly = spark.read.parquet(f"{out}/weekly_demand")
    features, seen = _counted(demand.features_from_grid(demand.demand_grid(weekly)), "features")
    sinks.write_parquet(features, f"{out}/features", partition_by="year")
    dropped = demand.grid_row_counts(weekly).first()["dropped_rows"]
    return {"feature_rows": seen.get["rows"], "rows_before_launch": dropped}


def read_features(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/features")


def train(
    spark: SparkSession, out: str, model: str, year: int, month: int, **options: object
) -> None:
    """Fit on the weeks before the cut-off, store the model, log the run's metrics."""
    features = read_features(spark, out)
    fitted = partial(FITS[model], **options)(demand.train_rows(features, year, month))
    demand_models.save_model(fitted, f"{out}/model")
    scored = fitted.transform(demand.test_rows(features, year, month))
    sinks.write_parquet(evaluation.results_table(scored), f"{out}/results")
    metrics = evaluation.forecast_metrics(spark.read.parquet(f"{out}/results"))
    params = {"model": model, "test_from": f"{year}-{month:02d}", **options}
    sinks.log_run(spark, f"{out}/runs", model, params, metrics)
    test = materialize(demand.test_rows(features, year, month))
    reports = {"permutation_importance": lambda: permutation_importance(test, fitted.transform)}
    if model != "tweedie_regression":
        reports["feature_importance"] = lambda: demand_models.feature_importance(spark, fitted)
    write_reports(spark, reports, out, out)


def write_reports(
    spark: SparkSession, reports: dict[str, Callable[[], DataFrame]], folder: str, out: str
) -> list[str]:
    """Write each report as CSV below ``folder``; returns the names of those that failed.

    One that fails, while it is planned or while it runs, does not keep the others from
    being written. Name, state, error and time of each are rows of ``out``/reports.
    """
    states = []
    for name, report in reports.items():
        error = None
        try:
            sinks.write_csv(report(), f"{folder}/{name}")
        except Exception as failure:  # whatever a report raises ends that report alone
            error = f"{type(failure).__name__}: {failure}"
        states.append((name, "failed" if error else "written", error))
    sinks.log_reports(spark, f"{out}/reports", states)
    return [name for name, _, error in states if error]


def evaluate(spark: SparkSession, out: str) -> list[str]:
    """The tables behind the three evaluation charts, and errors per category."""
    results = spark.read.parquet(f"{out}/results")

    @cache
    def errors() -> DataFrame:
        return materialize(results.select("error", F.lit(1).cast("bigint").alias("lines")))

    reports = {
        "global_forecast": lambda: evaluation.global_forecast_by_week(results),
        "top_category_forecasts": lambda: evaluation.top_category_forecasts(results),
        "error_histogram": lambda: profile.histogram(errors(), "error", 50),
        "error_density": lambda: profile.binned_kernel_density(errors(), "error"),
        "errors_by_category": lambda: evaluation.forecast_metrics(results, by=("category",)),
    }
    return write_reports(spark, reports, f"{out}/evaluation", out)


def plan(spark: SparkSession, out: str, service_level: float = 0.95) -> None:
    model = demand_models.load_model(f"{out}/model")
    scored = model.transform(demand.latest_week(read_features(spark, out)))
    plan_rows = inventory.reorder_plan(scored, service_level=service_level)
    sinks.write_csv(plan_rows, f"{out}/inventory_plan")


def explore(spark: SparkSession, out: str, payments: DataFrame | None = None) -> list[str]:
    """The tables behind the exploratory charts. Payments are optional."""
    lines = logistics.add_stage_days(spark.read.parquet(f"{out}/line_table"))
    valid = logistics.valid_logistics(lines)

    @cache
    def days(value: str) -> DataFrame:
        return materialize(logistics.value_counts(valid, value))

    def city_delivery_time() -> DataFrame:
        top = profile.rows_of_top(lines, logistics.top_cities(lines), "customer_city")
        return profile.bootstrap_mean_interval(top, "total_delivery_time", "customer_city")

    reports = {
        "monthly_revenue": lambda: profile.monthly_revenue(lines),
        "delay_boxplot_by_state": lambda: profile.delay_boxplot(logistics.within_delay_view(lines)),
        "late_rate_by_state": lambda: logistics.late_rate_by_state(lines),
        "late_rate_national": lambda: logistics.late_rate_national(lines),
        "city_delivery_time": city_delivery_time,
        "weekday_hour": lambda: profile.weekday_hour_pivot(lines),
        "seller_time_histogram": lambda: profile.histogram(days("time_to_ship"), "time_to_ship", 20),
        "seller_time_density": lambda: profile.kernel_density(days("time_to_ship"), "time_to_ship"),
        "carrier_time_histogram": lambda: profile.histogram(days("carrier_time"), "carrier_time", 40),
        "carrier_time_density": lambda: profile.kernel_density(days("carrier_time"), "carrier_time"),
        "state_logistics": lambda: logistics.state_logistics_breakdown(valid),
    }
    if payments is not None:
        reports["payment_share"] = lambda: profile.payment_share(payments)
    return write_reports(spark, reports, f"{out}/explore", out)


def run(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    out: str,
    model: str = "boosted_tweedie",
    year: int = 2018,
    month: int = 6,
    service_level: float = 0.95,
    **options: object,
) -> dict[str, int]:
    """All steps; returns the row counts of the stages."""
    counts = {"line_rows": write_line_table(tables, out)} | write_features(spark, out)
    train(spark, out, model, year, month, **options)
    evaluate(spark, out)
    plan(spark, out, service_level)
    explore(spark, out, tables.get("payments"))
    return counts


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw")
    parser.add_argument("out")
    parser.add_argument("--format", default="csv", choices=("csv", "parquet"))
    parser.add_argument(
        "--files", nargs="*", default=[], metavar="TABLE=FILE", help="file names within RAW_FOLDER"
    )
    parser.add_argument("--model", default="boosted_tweedie", choices=tuple(FITS))
    parser.add_argument("--test-year", type=int, default=2018)
    parser.add_argument("--test-month", type=int, default=6)
    parser.add_argument("--service-level", type=float, default=0.95)
    given = parser.parse_args()
    spark = build_session()
    files = dict(name.split("=", 1) for name in given.files)
    tables = readers.read_raw_tables(spark, given.raw, files, given.format)
    counts = run(
        spark,
        tables,
        given.out,
        given.model,
        given.test_year,
        given.test_month,
        given.service_level,
    )
    for name, rows in counts.items():
        print(f"{name}: {rows}")


if __name__ == "__main__":
    main()
