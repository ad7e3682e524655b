"""Readers for raw CSV or Parquet tables and for the tables written between stages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.functions.calendar import TIMESTAMP_LAYOUT, lenient_timestamp
from stockloom.sources.schemas import RAW_COLUMNS, STAR_TABLES


def read_csv_table(
    spark: SparkSession,
    path: str,
    columns: dict[str, str],
    layout: str = TIMESTAMP_LAYOUT,
    multiline: bool = False,
) -> DataFrame:
    """Scan a CSV with a header and give the named columns their types.

    Columns are matched by name, so their order in the file does not matter and
    further columns pass through as strings. Malformed timestamps become null;
    a malformed number is an error. A missing path raises ``AnalysisException``.
    """
    raw = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    return raw.select(
        *(
            _typed(name, columns[name], layout) if name in columns else F.col(f"`{name}`")
            for name in raw.columns
        )
    )


def _typed(name: str, type_name: str, layout: str):
    if type_name == "timestamp_ntz":
        return lenient_timestamp(F.col(name), layout).alias(name)
    return F.col(name).cast(type_name).alias(name)


def read_raw_tables(
    spark: SparkSession,
    folder: str,
    files: dict[str, str] | None = None,
    file_format: str = "csv",
    optional: tuple[str, ...] = ("payments", "reviews"),
) -> dict[str, DataFrame]:
    """The table registry. ``files`` maps a table to its file name in ``folder``.

    Nothing is read before a query uses a table, so unused tables cost nothing.
    """
    names = {table: f"{table}.{file_format}" for table in RAW_COLUMNS} | (files or {})
    tables: dict[str, DataFrame] = {}
    for table in STAR_TABLES + tuple(optional):
        path = f"{folder.rstrip('/')}/{names[table]}"
        try:
            if file_format == "csv":
                # Review texts hold line breaks inside quotes.
                tables[table] = read_csv_table(
                    spark, path, RAW_COLUMNS[table], multiline=table == "reviews"
                )
            else:
                tables[table] = spark.read.format(file_format).load(path)
        except AnalysisException:
            if table not in optional:
                raise
    return tables


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
