"""Writers for stage tables, reports and the log of model runs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace the Parquet table at ``path``.

    With ``partition_by`` the rows are rebalanced first: each partition value
    gets few large files, and a hot value is split over several tasks.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return
    balanced = df.hint("rebalance", F.col(partition_by))
    balanced.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the folder of CSV parts at ``path``."""
    df.write.mode("overwrite").option("header", True).csv(path)


def log_run(
    spark: SparkSession,
    path: str,
    name: str,
    params: dict[str, object],
    metrics: DataFrame,
) -> None:
    """Append one row to the table of model runs: name, time, parameters and metrics.

    ``metrics`` is the one-row result of ``forecast_metrics``.
    """
    literals = [part for key, value in params.items() for part in (F.lit(key), F.lit(str(value)))]
    stamp = datetime.now(timezone.utc).replace(tzinfo=None)
    row = metrics.select(
        F.lit(name).alias("run_name"),
        F.lit(stamp).cast("timestamp_ntz").alias("logged_at"),
        F.create_map(*literals).alias("params"),
        "*",
    )
    row.write.mode("append").parquet(path)


def log_reports(
    spark: SparkSession, path: str, states: list[tuple[str, str, str | None]]
) -> None:
    """Append a row per report: its name, state, error if any, and the time."""
    stamp = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = spark.createDataFrame(states, "report string, state string, error string")
    stamped = rows.withColumn("logged_at", F.lit(stamp).cast("timestamp_ntz"))
    stamped.coalesce(1).write.mode("append").parquet(path)
