"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics of the UTF-8 bytes and hashed words of a text are transformed to be closer to
normal. Counts, sums and cross products per class are added up over all labelled rows;
each class covariance is shrunk towards the pooled one and a multiple of the identity, and
its Cholesky factor is kept. A score is the logistic of the difference of the classes' log
densities and priors, which are Mahalanobis distances through the factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.words import Words, slices, text_bytes, words_of

# Labelled rows that the query fits on, at most about so many; ``fit`` itself takes all.
SAMPLE_ROWS = 100_000

STATISTICS = (
    "log_words word_bytes letters uppers digits symbols marks commas bars spaces lines other"
    " new_words top_word new_pairs new_lines line_words short_words"
).split()
WIDTH = len(STATISTICS)


def _class_table() -> np.ndarray:
    """Row per class of bytes, 1 where a byte belongs to it."""
    groups = [
        b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)),
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b"#*$%&<>@^~\\/+=_`",
        b"!?",
        b".,;:'\"()-",
        b"|[]{}",
        b" \t\r\x0b\x0c",
        b"\n",
    ]
    table = np.full(256, len(groups), dtype=np.uint8)
    for i, group in enumerate(groups):
        table[list(group)] = i
    return table


_CLASSES = _class_table()
_N_CLASSES = int(_CLASSES.max()) + 1


def statistics(column: pa.Array) -> np.ndarray:
    """A row of transformed statistics per text; empty texts have the values of no words."""
    data, bounds = text_bytes(column)
    count = len(bounds) - 1
    own = np.repeat(np.arange(count), np.diff(bounds))
    classes = np.bincount(own * _N_CLASSES + _CLASSES[data], minlength=count * _N_CLASSES)
    classes = classes.reshape(count, _N_CLASSES).astype(float)
    size = np.maximum(np.diff(bounds), 1)
    found = words_of(column)
    words = np.diff(found.bounds).astype(float)
    out = np.zeros((count, WIDTH))
    out[:, 0] = np.log1p(words)
    inside = size - classes[:, 7] - classes[:, 8]
    out[:, 1] = np.log1p(inside / np.maximum(words, 1))
    # Shares are taken to the square root, which spreads small ones.
    out[:, 2:12] = np.sqrt(classes / size[:, None])
    broken = _lines(data, bounds)
    for row in range(count):
        first, last = found.bounds[row], found.bounds[row + 1]
        own_words = found.hashes[first:last]
        if len(own_words):
            _, times = np.unique(own_words, return_counts=True)
            out[row, 12] = len(times) / np.sqrt(len(own_words))
            out[row, 13] = np.sqrt(times.max() / len(own_words))
            pairs = own_words[:-1] * np.uint64(3) + own_words[1:]
            out[row, 14] = (len(np.unique(pairs)) + 1) / (len(pairs) + 1)
        lines = broken.hashes[broken.bounds[row] : broken.bounds[row + 1]]
        if len(lines):
            out[row, 15] = len(np.unique(lines)) / len(lines)
            out[row, 16] = np.log1p(len(own_words) / len(lines))
    out[:, 17] = np.sqrt(classes[:, 7] / np.maximum(inside, 1))
    return out


_LINE_ENDS = np.arange(256) == 10


def _lines(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Lines as if they were words."""
    offsets = pa.py_buffer(bounds.astype(np.int64))
    column = pa.LargeStringArray.from_buffers(len(bounds) - 1, offsets, pa.py_buffer(data.copy()))
    return words_of(column, _LINE_ENDS)


class Model(NamedTuple):
    """Means, inverse Cholesky factors, log determinants and log priors of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    scale: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1, tempered by ``scale`` as statistics are not independent."""
        log = []
        for k in (0, 1):
            distance = (((rows - self.means[k]) @ self.factors[k].T) ** 2).sum(axis=1)
            log.append(-0.5 * (distance + self.log_dets[k]) * self.scale + self.log_priors[k])
        return 1 / (1 + np.exp(-np.clip(log[1] - log[0], -500, 500)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and class: number, sums and cross products, as one flat array."""
    total = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH))
    for batch in batches:
        for part in slices(batch, "text"):
            rows = statistics(part.column("text"))
            label = part.column("label").to_numpy()
            for k in (0, 1):
                chosen = rows[label == k]
                total[k, 0] += len(chosen)
                total[k, 1 : 1 + WIDTH] += chosen.sum(axis=0)
                total[k, 1 + WIDTH :] += (chosen.T @ chosen).ravel()
    for k in (0, 1):
        yield pa.record_batch(
            [
                pa.array([k] * total.shape[1], pa.int32()),
                pa.array(np.arange(total.shape[1]), pa.int32()),
                pa.array(total[k]),
            ],
            ["label", "place", "value"],
        )


def fit(labelled: DataFrame, to_pooled: float = 0.1, to_identity: float = 0.02, scale: float = 0.5) -> Model:
    """Model from rows with text and label (0 or 1); other labels and null ones are ignored.

    The driver receives 2 * (1 + 18 + 324) sums, whatever the number of rows. A class
    without rows gets the other's mean and the pooled covariance.
    """
    rows = (
        labelled.filter("label in (0, 1)")
        .select("text", F.col("label").cast("int").alias("label"))
        .mapInArrow(_sums, "label int, place int, value double")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    total = np.zeros((2, 1 + WIDTH + WIDTH * WIDTH))
    for label, place, value in rows:
        total[label, place] = value
    counts = total[:, 0]
    everything = total.sum(axis=0)

    def moments(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = max(sums[0], 1)
        mean = sums[1 : 1 + WIDTH] / n
        cross = sums[1 + WIDTH :].reshape(WIDTH, WIDTH) / n
        return mean, cross - np.outer(mean, mean)

    common_mean, common = moments(everything)
    own = [moments(total[k]) if counts[k] else (common_mean, common) for k in (0, 1)]
    pooled = sum(max(counts[k], 1e-9) * own[k][1] for k in (0, 1)) / max(counts.sum(), 2e-9)
    means, factors, log_dets = [], [], []
    spread = np.diag(common).mean() or 1.0
    for mean, covariance in own:
        shrunk = (1 - to_pooled) * covariance + to_pooled * pooled
        shrunk = (1 - to_identity) * shrunk + to_identity * (
            np.diag(np.maximum(np.diag(common), 1e-3 * spread)) + 1e-6 * np.eye(WIDTH)
        )
        factor = np.linalg.cholesky(shrunk)
        means.append(mean)
        factors.append(np.linalg.inv(factor))
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    priors = np.log((counts + 1) / (counts.sum() + 2))
    return Model(np.array(means), np.array(factors), np.array(log_dets), priors, scale)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs``; the score is the probability of label 1.

    Null and empty texts get the score of a text without words. Repeated rows and null ids
    are kept; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values = model.scores(statistics(part.column("text")))
                yield pa.record_batch([part.column("doc_id"), pa.array(values)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")
