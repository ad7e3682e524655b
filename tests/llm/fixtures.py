"""Small documents with the awkward cases that every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def prose(seed: int, words: int = 80) -> str:
    choice = random.Random(seed)
    return " ".join(
        f"{choice.choice(WORDS)}{choice.randrange(40)}" + ("\n" if choice.random() < 0.1 else "")
        for _ in range(words)
    )


def awkward() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, repeated rows."""
    rows = [
        (1, prose(1), "en", "a", 10),
        (1, prose(1), "en", "a", 10),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \n\t ", "en", "a", 4),
        (None, prose(5), None, None, None),
        (None, None, None, None, None),
        (6, "one", "en", "b", 3),
        (7, "ONE", "en", "b", 3),
        (8, prose(8, 20_000), "en", "b", None),
        (9, "x" * 200_000, "en", "b", None),
        (10, "ünï😀 \x00 ▁ \u2028 text", "en", "b", None),
    ]
    return rows


def documents(spark, rows: list[tuple] | None = None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def clashing(docs):
    """The same rows with extra columns named like those that operators make."""
    for name in ("spans", "kept", "rep", "score", "label", "row", "host", "_words", "removed"):
        docs = docs.withColumn(name, docs.lang)
    return docs
