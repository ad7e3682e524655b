"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text.

Folding removes accents and case, maps homoglyphs and digits or signs that stand for
letters to one letter, and everything else to single spaces. Lexicon entries match at the
beginning of a word. Their weights are log odds of toxic against other labelled documents;
hits inside an exception phrase do not count. The sum is normalised by length and turned
into a probability by a logistic curve.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import sampled
from stockloom.llm.words import slices

# Labelled rows that the lexicon and the curve are fitted on, at most about so many.
SAMPLE_ROWS = 40_000
# An entry is learned if so many toxic documents have it and its log odds reach MIN_WEIGHT.
MIN_DOCUMENTS = 6
MIN_WEIGHT = 3.0
PREFIXES = (4, 5, 6, 7)
# Words that are added to a text's length, so that one hit in a few words is no certainty.
LENGTH_PRIOR = 50
# Common insults, known before any label is seen.
SEED_WORDS = "idiot moron stupid scum trash loser pathetic worthless disgusting".split()
SEED_WEIGHT = 4.0
# Phrases in which such words are harmless.
EXCEPTIONS = ("trash can", "trash bin", "pond scum", "clown fish", "idiot proof", "class clown")
# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(
    zip(
        "авсԁеһіјкӏмпорԛѕтսѵѡхуαβεικνορτυχ",
        "abcdehijklmnopqstuvwxyabeiknoptux",
        strict=True,
    )
)
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
# l, 1 and i stand for each other, so all become i.
_TABLE = str.maketrans({**HOMOGLYPHS, **SUBSTITUTES, "l": "i", "|": " "})
_OTHER = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """The folded text, a space before and after each word."""
    if not text.isascii():
        text = "".join(
            c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)
        )
    return f" {_OTHER.sub(' ', text.lower().translate(_TABLE)).strip()} "


class Lexicon(NamedTuple):
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    offset: float
    slope: float

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(fold(phrase).rstrip(), (len(fold(phrase).rstrip()), None))
        for word, weight in self.weights.items():
            if not found.exists(f" {word}"):
                found.add_word(f" {word}", (len(word) + 1, weight))
        found.make_automaton()
        return found


def strength(automaton: ahocorasick.Automaton, text: str | None) -> float:
    """Sum of the weights of hits outside exception phrases, per hundred words."""
    folded = fold(text or "")
    hits: dict[int, tuple[int, float]] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif start not in hits or hits[start][1] < weight:
            hits[start] = (end, weight)
    if excused:
        hits = _outside(hits, excused)
    words = folded.count(" ") - 1
    return 100 * sum(weight for _, weight in hits.values()) / (words + LENGTH_PRIOR)


def _outside(hits: dict, excused: list[tuple[int, int]]) -> dict:
    """Hits that no excused range covers; both are walked once, in order of their start."""
    excused.sort()
    left, at, reach = {}, 0, -1
    for start in sorted(hits):
        while at < len(excused) and excused[at][0] <= start:
            reach = max(reach, excused[at][1])
            at += 1
        if hits[start][0] > reach:
            left[start] = hits[start]
    return left


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term and label, added up within the task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(
            batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True
        ):
            words = set(fold(text or "").split())
            counts[label].update({w[:n] for w in words for n in PREFIXES if len(w) >= n} | words)
    for label in (0, 1):
        terms = list(counts[label].items())
        for first in range(0, len(terms), 50_000):
            chunk = terms[first : first + 50_000]
            yield pa.record_batch(
                [
                    pa.array([t for t, _ in chunk], pa.string()),
                    pa.array([label] * len(chunk), pa.int32()),
                    pa.array([n for _, n in chunk], pa.int64()),
                ],
                ["term", "label", "n"],
            )


def learn(labelled: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, rows: int = SAMPLE_ROWS) -> Lexicon:
    """Lexicon and curve from rows with text and label; labels other than 0 and 1 are ignored.

    Fitted on at most about ``rows`` rows. The driver receives the entries that pass the
    limits and one strength per sampled row.
    """
    chosen = sampled(
        labelled.filter("label in (0, 1)").select("text", F.col("label").cast("int").alias("label")),
        "text",
        rows,
    )
    sizes = dict(chosen.groupBy("label").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log(
        (F.col("clean") + 0.5) / (clean + 1.0)
    )
    found = (
        chosen.mapInArrow(_terms, "term string, label int, n bigint")
        .groupBy("term")
        .agg(
            F.sum(F.expr("if(label = 1, n, 0)")).alias("toxic"),
            F.sum(F.expr("if(label = 0, n, 0)")).alias("clean"),
        )
        .filter(F.col("toxic") >= MIN_DOCUMENTS)
        .withColumn("weight", weight)
        .filter(F.col("weight") >= MIN_WEIGHT)
        .select("term", "weight")
        .collect()
    )
    weights = {fold(word).strip(): SEED_WEIGHT for word in SEED_WORDS}
    for term, value in sorted(found, key=lambda row: (len(row[0]), row[0])):
        # A beginning that is listed speaks for the longer entries too.
        if not any(term[:n] in weights for n in range(3, len(term))):
            weights[term] = max(value, weights.get(term, 0.0))
    lexicon = Lexicon(weights, tuple(exceptions), 0.0, 0.0)
    pairs = _strengths(chosen, lexicon, "label").collect()
    offset, slope = curve(
        np.array([p[1] for p in pairs], dtype=float), np.array([p[0] for p in pairs], dtype=float)
    )
    return lexicon._replace(offset=offset, slope=slope)


def curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic curve, by Newton steps with a small ridge."""
    if len(x) == 0 or y.min() == y.max():
        return -3.0, 1.0
    rows = np.stack([np.ones_like(x), x], axis=1)
    at = np.array([np.log(y.mean() / (1 - y.mean())), 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30)))
        gradient = rows.T @ (y - p) - 0.01 * at
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def _strengths(docs: DataFrame, lexicon: Lexicon, keep: str) -> DataFrame:
    kind = dict(docs.dtypes)[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            for part in slices(batch, "text"):
                values = [strength(automaton, text) for text in part.column("text").to_pylist()]
                yield pa.record_batch(
                    [part.column(keep), pa.array(values, pa.float64())], [keep, "strength"]
                )

    return docs.select(keep, "text").mapInArrow(run, f"{keep} {kind}, strength double")


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, score) per row of ``docs``: the probability of being toxic.

    Null and empty texts have no hits. Repeated rows and null ids are kept; other columns
    are ignored.
    """
    return _strengths(docs, lexicon, "doc_id").select(
        "doc_id", (1 / (1 + F.exp(-(lexicon.offset + lexicon.slope * F.col("strength"))))).alias("score")
    )
