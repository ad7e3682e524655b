"""The corpus pipeline: quality rules, deduplication, decontamination, redaction, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockloom.llm import decontaminate, line_frequency, partenum, pii, sentencepiece_bpe
from stockloom.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents and the lines that too many documents of a source share."""
    return line_frequency.quality_filtered(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of similar documents (five words, 0.8)."""
    return partenum.one_per_group(docs, words=5, percent=80)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return pii.redacted(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids of each text, their number, and the digest of what they decode to."""
    return sentencepiece_bpe.encoded(docs, read_back=True)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate_benchmark),
    ("PII", redact),
    ("SentencePiece encoding and decoding", encode),
]

# Extraction by bootstrapped contexts and merge-type encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
