"""Words and word shingles of Arrow string columns as numpy arrays of 64-bit hashes.

Everything works on the UTF-8 bytes of a whole batch; no text becomes a Python string.
Hashes of different words or shingles are taken to differ (64 bits).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes hashed at once, so that temporary arrays stay small whatever the text.
SPAN = 1 << 20
# Bytes of text that one slice of a batch holds, unless a single text is longer.
SLICE = 4 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Everything in ASCII that is neither a letter nor a digit.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """Hashes of all words, and for each text the range of its words."""

    hashes: np.ndarray
    bounds: np.ndarray


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = values + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``limit`` bytes."""
    if batch.num_rows == 0:
        return
    _, bounds = text_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = max(first + 1, last)
        yield batch.slice(first, last - first)
        first = last


def word_ranges(
    data: np.ndarray, bounds: np.ndarray, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and for each text the range of its words."""
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = bounds[:-1][bounds[1:] > bounds[:-1]]
    begins[filled] = inside[filled]
    closing = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    ends[closing] = inside[closing]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


def words_of(column: pa.Array, separators: np.ndarray = SPACE) -> Words:
    """Hashed words of each text, A-Z taken as a-z."""
    data, bounds = text_bytes(column)
    starts, ends, ranges = word_ranges(data, bounds, separators)
    hashes = np.empty(len(starts), dtype=np.uint64)
    table = np.where(separators, np.uint64(0), _BYTE_VALUE[LOWER])
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SPAN, side="right")))
        low, high = starts[first], ends[last - 1]
        begin = starts[first:last] - low
        lengths = ends[first:last] - starts[first:last]
        spans = np.diff(np.append(begin, high - low))
        place = np.arange(high - low) - np.repeat(begin, spans)
        powers = np.full(int(lengths.max()) + 1, _STEP)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        # Separators count as 0, so their place only has to be a valid index.
        values = table[data[low:high]] * powers[np.minimum(place, len(powers) - 1)]
        sums = np.add.reduceat(values, begin)
        hashes[first:last] = mix(sums + lengths.astype(np.uint64))
        first = last
    return Words(hashes, ranges)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words of one text; a shorter text is one run."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    total = np.full(count, np.uint64(size))
    for i in range(size):
        total = mix(total ^ words[i : i + count])
    return total
