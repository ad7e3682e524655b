"""Helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.session import stage_folder

# Columns of the tables the queries read.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there.

    Cuts lineage, survives lost executors, and lets each reader prune columns.
    """
    spark = df.sparkSession
    folder = stage_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def sql_text(value: str) -> str:
    """``value`` as a raw SQL string literal."""
    if '"' in value:
        raise ValueError("no double quotes in a raw literal")
    return f'r"{value}"'


def matches(column: str, pattern: str) -> Column:
    """All leftmost non-overlapping matches, as strings."""
    return F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0))


def sampled(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``key``; all if there are fewer."""
    total = df.count()
    if total <= rows:
        return df
    parts = 1_000_003
    return df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) < parts * rows / total)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is never learned from: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
