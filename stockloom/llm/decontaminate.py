"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by their number of shingles into classes that double in size. For a
class of up to L shingles, a document is a chain of windows of 2L shingles that advance by
L, so every passage of L shingles lies whole inside one window, and the Jaccard similarity
of an item and the window that holds it does not depend on the document's length. Item
and window each keep the smallest hash per bin (one-permutation MinHash). A document and an
item that agree in a bin are candidates; they match if the document holds at least the
required share of the item's shingles, which is counted exactly.

Window minima are computed only where they can equal an item's: at shingles that are some
item's minimum.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import staged
from stockloom.llm.partenum import by_ids
from stockloom.llm.words import PUNCTUATION, mix, shingles, slices, words_of

WORDS = 5
PERCENT = 80
# Bits of the bin number. Items of up to SMALL shingles have a bin per shingle, as the
# minimum of few bins would be missed too often.
BIN_BITS = 7
SMALL = 8
# Characters of items that one block of the benchmark, which every task receives, holds.
BLOCK_CHARS = 16_000_000
FLAG_BITS = 22


class SizeClass(NamedTuple):
    """Items of one class: window step, minima in ascending order and their owners."""

    step: int
    binned: bool
    minima: np.ndarray
    owners: list[list[int]]


class Block(NamedTuple):
    ids: list[int | None]
    sets: list[np.ndarray]
    classes: list[SizeClass]
    flags: np.ndarray


def item_set(text: str | None) -> np.ndarray:
    found = words_of(pa.array([text], pa.string()), PUNCTUATION)
    return np.unique(shingles(found.hashes, WORDS))


def _bins(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - BIN_BITS)


def _ranks(hashes: np.ndarray) -> np.ndarray:
    """The order that minima go by, independent of the bin."""
    return mix(hashes)


def item_minima(elements: np.ndarray, binned: bool) -> np.ndarray:
    if not binned:
        return elements
    order = np.lexsort((_ranks(elements), _bins(elements)))
    bins = _bins(elements)[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = bins[1:] != bins[:-1]
    return elements[order][first]


def build_block(items: list[tuple[int | None, str | None]]) -> Block:
    """What a task needs of some items. Items without words are left out."""
    ids, sets = [], []
    for item_id, text in items:
        elements = item_set(text)
        if len(elements):
            ids.append(item_id)
            sets.append(elements)
    owners: dict[int, dict[int, list[int]]] = {}
    for number, elements in enumerate(sets):
        step = SMALL
        while step < len(elements):
            step *= 2
        for value in item_minima(elements, step > SMALL).tolist():
            owners.setdefault(step, {}).setdefault(value, []).append(number)
    flags = np.zeros(1 << FLAG_BITS, dtype=bool)
    classes = []
    for step, by_value in sorted(owners.items()):
        minima = np.array(sorted(by_value), dtype=np.uint64)
        flags[(minima & np.uint64(len(flags) - 1)).astype(np.int64)] = True
        classes.append(
            SizeClass(step, step > SMALL, minima, [by_value[v] for v in minima.tolist()])
        )
    return Block(ids, sets, classes, flags)


def candidates(sequence: np.ndarray, block: Block) -> set[int]:
    """Items that agree with some window of one document in a bin's minimum."""
    found: set[int] = set()
    flagged = np.flatnonzero(block.flags[(sequence & np.uint64(len(block.flags) - 1)).astype(np.int64)])
    if len(flagged) == 0:
        return found
    values = sequence[flagged]
    for kind in block.classes:
        at = np.minimum(np.searchsorted(kind.minima, values), len(kind.minima) - 1)
        hits = np.flatnonzero(kind.minima[at] == values)
        for hit in hits.tolist():
            owners = kind.owners[at[hit]]
            if found.issuperset(owners):
                continue
            if not kind.binned or _is_minimum(sequence, int(flagged[hit]), kind.step):
                found.update(owners)
    return found


def _is_minimum(sequence: np.ndarray, place: int, step: int) -> bool:
    """Whether a shingle is its bin's minimum in one of the two windows that hold it."""
    value = sequence[place : place + 1]
    chunk = place // step
    for first in (chunk - 1, chunk):
        if first < 0:
            continue
        window = sequence[first * step : (first + 2) * step]
        rivals = window[_bins(window) == _bins(value)]
        if _ranks(rivals).min() == _ranks(value)[0]:
            return True
    return False


def _search(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            rows = []
            for part in slices(batch, "text"):
                found = words_of(part.column("text"), PUNCTUATION)
                ids = part.column("doc_id").to_pylist()
                # Shingles of the whole slice; those across two texts are not looked at.
                for row, doc_id in enumerate(ids):
                    sequence = shingles(found.hashes[found.bounds[row] : found.bounds[row + 1]], WORDS)
                    for item in candidates(sequence, block):
                        elements = block.sets[item]
                        held = int(np.isin(elements, sequence).sum())
                        if 100 * held >= percent * len(elements):
                            rows.append((doc_id, block.ids[item], len(elements), held))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.record_batch(
                [pa.array(column, pa.int64()) for column in columns],
                ["doc_id", "item_id", "n_item_shingles", "n_shared"],
            )

    return run


def matches(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared) of every document that holds an item.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z taken as a-z. An
    item is held if a document contains at least ``percent`` of its distinct five-word
    shingles. An item or document of fewer words is one shingle of its whole, so such an
    item is held only by a document that is equal to it. Null, empty and wordless texts match nothing; null
    ids are passed on; each row counts by itself, so repeated rows give repeated results.
    Other columns are ignored. Items reach the tasks in blocks of bounded size.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    items = items.select("item_id", "text")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    result = None
    for number in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        block = build_block([tuple(row) for row in chosen.collect()])
        found = docs.mapInArrow(
            _search(spark.sparkContext.broadcast(block), percent),
            "doc_id bigint, item_id bigint, n_item_shingles bigint, n_shared bigint",
        )
        result = found if result is None else result.unionByName(found)
    return result


def decontaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that hold an item; rows without doc_id stay.

    Rows with one doc_id leave together.
    """
    held = staged(matches(docs, items, percent).select("doc_id").distinct(), "held")
    return by_ids(docs, held.filter("doc_id is not null"), "left_anti")
