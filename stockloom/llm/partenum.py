"""Exact Jaccard self-join of documents on word n-grams by PartEnum signatures.

Sets of similar size share a band. A band's largest size fixes how many elements two
sets of the required similarity can differ in, say k. The domain of n-grams is cut by hash
into groups of three parts, more than k / 2 groups. Sets that differ in k elements at most
differ in two parts of at most k / 2 groups, so in some group two parts agree: all subsets
of two of a group's three parts are enumerated, and each is one signature. With s groups
more than needed, s + 1 signatures agree at least, so each set can leave out its s
smallest ones, which sets meet on by chance; the largest agreeing one is left out by none.

Sets with a common signature are compared by parity sketches, whose Hamming distance
never exceeds that of the sets. A sketch has more than twice as many bits as its band's
sets may differ in, so unrelated sets do not pass; pairs that do are compared by the sets
themselves. Groups of near copies are contracted by pivots, one per signature, round by
round; what pairs are left then are compared inside the join of signatures.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import count
from math import ceil, exp
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import staged
from stockloom.llm.components import components
from stockloom.llm.words import mix, shingles, slices, words_of

# Largest size of a band over its smallest.
BAND_RATIO = 1.4
# Parts of a group; all but one of them make a signature.
GROUP = 3
# Bits of a sketch over the number of elements that sets of its band may differ in.
SKETCH_RATIO = 2.3
# Words of a sketch that are columns; the others are an array.
SKETCH = [f"s{i}" for i in range(4)]
# Bits of a signature that hold the number of its band.
BAND_BITS = 6
# For the choice of groups: how alike sets are that meet by chance, and what such a
# meeting costs against moving one signature.
CHANCE, MEETING = 0.05, 200.0
# Sets that one task remembers, so that it emits the signatures of copies once.
REMEMBERED = 200_000
# Ids that may be broadcast: 32 MB of them.
BROADCAST_IDS = 4_000_000
# Rounds of pivots go on while one links more than this share of all sets linked so far.
WORTHWHILE = 0.02


class Band(NamedTuple):
    """Sets of ``low`` to ``high`` elements and of similar sets below."""

    number: int
    low: int
    high: int
    groups: int
    left_out: int
    bits: int


def bands(largest: int) -> list[tuple[int, int]]:
    """(smallest, largest) size of each band, up to the one that holds ``largest``."""
    found, low = [], 1
    while not found or found[-1][1] < largest:
        high = max(low, int(low * BAND_RATIO))
        found.append((low, high))
        low = high + 1
    return found


def distance_limit(size: int, percent: int) -> int:
    """How many elements two sets may differ in whose sizes sum up to ``size``."""
    return size * (100 - percent) // (100 + percent)


def _left_out(low: int, limit: int) -> int:
    """How many groups more than needed serve sets of ``low`` elements best.

    Each further group lets a set drop one more small signature, but makes all of them
    smaller. Numbers of elements are taken as Poisson distributed.
    """
    needed = limit // 2 + 1
    best, least = 0, float("inf")
    for more in sorted({round(needed * share / 20) for share in range(41)}):
        groups = needed + more
        mean = low * (GROUP - 1) / (GROUP * groups)
        drop, chance, cost = more / (GROUP * groups), exp(-mean), 0.0
        for size in range(ceil(mean) + 1):
            stays = max(0.0, chance - drop)
            drop = max(0.0, drop - chance)
            cost += stays * CHANCE**size
            chance *= mean / (size + 1)
        cost = GROUP * groups * (1.0 + MEETING * cost) - more
        if cost < least:
            best, least = more, cost
    return best


@lru_cache(maxsize=4096)
def band_at(number: int, low: int, high: int, percent: int) -> Band:
    limit = distance_limit(2 * high, percent)
    # Sets that must be equal have one signature, that of the whole set.
    left_out = _left_out(low, limit) if limit else 0
    groups = limit // 2 + 1 + left_out if limit else 0
    bits = 64 * len(SKETCH)
    while bits < SKETCH_RATIO * limit:
        bits *= 2
    return Band(number, low, high, groups, left_out, bits)


def bands_of(size: int, percent: int) -> list[Band]:
    """Bands in which a set of ``size`` elements can meet similar ones, smallest first."""
    found = []
    for number, (low, high) in enumerate(bands(ceil(size * 100 / percent))):
        if ceil(low * percent / 100) <= size <= high:
            found.append(band_at(number, low, high, percent))
    return found


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one non-empty sorted set of distinct hashes."""
    upper = elements >> np.uint64(32)
    spread = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements), dtype=np.uint64)])
    found = []
    for band in bands_of(len(elements), percent):
        if band.groups == 0:
            whole = mix(spread[-1:] ^ np.uint64(band.number))
            found.append(_numbered(whole, band.number))
            continue
        parts = GROUP * band.groups
        part = ((upper * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        ends = np.searchsorted(part, np.arange(parts + 1))
        counts = np.diff(ends).reshape(-1, GROUP)
        sums = np.diff(spread[ends]).reshape(-1, GROUP)
        # A subset is its group without one part.
        sizes = (counts.sum(axis=1, keepdims=True) - counts).ravel()
        subsets = (sums.sum(axis=1, keepdims=True, dtype=np.uint64) - sums).ravel()
        where = mix(np.arange(parts, dtype=np.uint64) + np.uint64(band.number << 32))
        own = _numbered(mix(subsets ^ where), band.number)
        if band.left_out:
            smallest = np.partition(sizes, band.left_out)[band.left_out]
            keep = sizes > smallest
            ties = np.flatnonzero(sizes == smallest)
            dropped = band.left_out - int((sizes < smallest).sum())
            keep[ties[np.argsort(own[ties])[dropped:]]] = True
            own = own[keep]
        found.append(own)
    return np.concatenate(found)


def _numbered(values: np.ndarray, number: int) -> np.ndarray:
    """Signatures whose last bits are the number of their band."""
    return (values << np.uint64(BAND_BITS)) | np.uint64(number)


def sketch(elements: np.ndarray, size: int) -> np.ndarray:
    """Parities of the number of elements per bit, as 64-bit words; ``size`` is a power of 2."""
    bits = (elements & np.uint64(size - 1)).astype(np.int64)
    odd = (np.bincount(bits, minlength=size) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """The sketch of ``size`` bits of the same set."""
    while 64 * len(words) > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def set_key(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    spread = mix(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    with np.errstate(over="ignore"):
        return int(mix(elements).sum(dtype=np.uint64).astype(np.int64)), int(
            spread.sum(dtype=np.uint64).astype(np.int64)
        )


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for part in slices(batch, "text"):
        found = words_of(part.column("text"))
        for row, doc_id in enumerate(part.column("doc_id").to_pylist()):
            own = found.hashes[found.bounds[row] : found.bounds[row + 1]]
            yield doc_id, np.unique(shingles(own, words))


def _classes(words: int, percent: int):
    """Size, key and widest sketch of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, keys, sketches = [], [], [], []
            for doc_id, elements in _sets(batch, words):
                ids.append(doc_id)
                sizes.append(len(elements))
                filled = len(elements) > 0
                keys.append(set_key(elements) if filled else (None, None))
                bits = bands_of(len(elements), percent)[-1].bits if filled else 0
                sketches.append(sketch(elements, bits).tobytes() if filled else None)
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([k for k, _ in keys], pa.int64()),
                    pa.array([k for _, k in keys], pa.int64()),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "n_shingles", "k1", "k2", "sketch"],
            )

    return run


def _in_bands(percent: int):
    """A row for each set and band, with the sketch as wide as that band's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, number, words, rest = [], [], [], []
            sizes = batch.column("n").to_pylist()
            for row, packed in enumerate(batch.column("sketch").to_pylist()):
                whole = np.frombuffer(packed, dtype=np.int64)
                for band in bands_of(sizes[row], percent):
                    own = folded(whole, band.bits)
                    place.append(row)
                    number.append(band.number)
                    words.append(own[: len(SKETCH)])
                    rest.append(own[len(SKETCH) :])
            first = np.array(words, dtype=np.int64).reshape(-1, len(SKETCH))
            ends = np.cumsum([0, *map(len, rest)])
            flat = np.concatenate([*rest, np.zeros(0, np.int64)])
            at = pa.array(place, pa.int64())
            yield pa.record_batch(
                [
                    batch.column("rep").take(at),
                    pa.array(number, pa.int64()),
                    *(pa.array(np.ascontiguousarray(first[:, i])) for i in range(len(SKETCH))),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                ["rep", "band", *SKETCH, "rest"],
            )

    return run


def _signature_rows(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys, rows, held = [], [], 0
            for _, elements in _sets(batch, words):
                if len(elements) == 0:
                    continue
                key = set_key(elements)
                if key in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(key)
                keys.append(key)
                rows.append(signatures(elements, percent))
                held += len(rows[-1])
                if held > 500_000:
                    yield _signature_batch(keys, rows)
                    keys, rows, held = [], [], 0
            if rows:
                yield _signature_batch(keys, rows)

    return run


def _signature_batch(keys: list[tuple[int, int]], rows: list[np.ndarray]) -> pa.RecordBatch:
    counts = [len(row) for row in rows]
    first = np.array([k for k, _ in keys], dtype=np.int64)
    return pa.record_batch(
        [pa.array(np.concatenate(rows).view(np.int64)), pa.array(np.repeat(first, counts))],
        ["sig", "k1"],
    )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and set, those of signatures with two sets or more.

    Streams: only the first row of the signature at hand is held back.
    """
    held = None  # (sig, k1, whether it has been passed on)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
        if held is not None:
            rows = np.concatenate([np.array([held[:2]], dtype=np.int64), rows])
        passed = held is not None and held[2]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        rows = rows[new]
        same = rows[1:, 0] == rows[:-1, 0]
        keep = np.zeros(len(rows), dtype=bool)
        keep[1:] |= same
        keep[:-1] |= same
        if passed:
            keep[0] = False
        last = bool(keep[-1]) or (passed and len(rows) == 1)
        held = (*map(int, rows[-1]), last)
        out = rows[keep]
        yield pa.record_batch(
            [pa.array(np.ascontiguousarray(out[:, i])) for i in range(2)], ["sig", "k1"]
        )


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int, int]] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                ids, sets = [], []
                for doc_id, elements in _sets(part, words):
                    if len(elements) == 0:
                        continue
                    row = (doc_id, *set_key(elements))
                    if row in seen:
                        continue
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(row)
                    ids.append(doc_id)
                    sets.append(elements.view(np.int64))
                lengths = np.cumsum([0, *(len(s) for s in sets)])
                flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))
                yield pa.record_batch([pa.array(ids, pa.int64()), lists], ["doc_id", "elements"])

    return run


def by_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``docs`` with ``ids``, which is broadcast up to a checked size."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", how).select(*docs.columns)


def similar_classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every document with its class of equal sets, and the components of linked classes.

    Returns (doc_id, n_shingles, rep) and (node, component), where all ids are the smallest
    doc_id of a class. A null rep marks an empty set or a null doc_id.
    """
    docs = docs.select("doc_id", "text")
    kinds = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, sketch binary"
    slim = staged(docs.mapInArrow(_classes(words, percent), kinds), "classes")
    reps = staged(
        slim.filter("k1 is not null and doc_id is not null")
        .groupBy("k1", "k2")
        .agg(
            F.min("doc_id").alias("rep"),
            F.max("n_shingles").alias("n"),
            F.any_value("sketch").alias("sketch"),
        ),
        "representatives",
    )
    columns = ", ".join(f"{name} bigint" for name in SKETCH)
    sketches = staged(
        reps.select("rep", "n", "sketch").mapInArrow(
            _in_bands(percent), f"rep bigint, band bigint, {columns}, rest array<bigint>"
        ),
        "sketches",
    )
    # Sets whose first key is equal by chance get each other's signatures too.
    shared = staged(
        docs.filter("doc_id is not null")
        .mapInArrow(_signature_rows(words, percent), "sig bigint, k1 bigint")
        .repartition("sig")
        .sortWithinPartitions("sig", "k1")
        .mapInArrow(_shared, "sig bigint, k1 bigint")
        .join(reps.select("k1", "rep", "n"), "k1")
        .select("sig", "rep", "n"),
        "signatures",
    )
    classes = slim.join(reps.select("k1", "k2", "rep"), ["k1", "k2"], "left")
    linked = _linked(docs, shared, sketches, words, percent)
    return classes.select("doc_id", "n_shingles", "rep"), linked


def _with_sets(docs: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Adds the sets of both sides as of_a and of_b.

    Only texts of the pairs are read again, so sets of other documents never move.
    """
    for side in "ab":
        ids = pairs.select(F.col(f"rep_{side}").alias("doc_id")).distinct()
        sets = by_ids(docs, ids, "left_semi").mapInArrow(
            _full_sets(words), "doc_id bigint, elements array<bigint>"
        )
        pairs = pairs.join(sets.toDF(f"rep_{side}", f"of_{side}"), f"rep_{side}")
    return pairs


def _verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The components (a, b) of those pairs (rep_a, c_a, rep_b, c_b) whose sets are similar."""
    return (
        _with_sets(docs, pairs, words)
        .withColumn("common", F.size(F.array_intersect("of_a", "of_b")))
        .filter(f"100 * common >= {percent} * (size(of_a) + size(of_b) - common)")
        .selectExpr("c_a as a", "c_b as b")
        .distinct()
    )


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select("sig", *(F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "sig"))


def _moved(df: DataFrame, column: str, merged: DataFrame) -> DataFrame:
    """``df`` with the components in ``column`` replaced by those they merged into."""
    joined = df.join(merged.toDF(column, "_into"), column, "left")
    return joined.withColumn(column, F.coalesce("_into", column)).select(*df.columns)


BAND = f"sig & {(1 << BAND_BITS) - 1}"


def _close(percent: int) -> str:
    """Whether the sketches of sides a and b differ in no more bits than similar sets may."""
    allowed = f"(n_a + n_b) * {100 - percent} div {100 + percent}"
    distance = " + ".join(f"bit_count({name}_a ^ {name}_b)" for name in SKETCH)
    further = "aggregate(zip_with(rest_a, rest_b, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    return f"{distance} <= {allowed} and {distance} + {further} <= {allowed}"


def _pairs_with_pivots(found: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Close pairs of a signature's pivot, side a, and another of its sets, side b.

    A pair that shares many signatures is reduced to one row in each task that meets it.
    """
    sizes = f"c_a <> c_b and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    sides = found.selectExpr(
        "pivot.rep as rep_a", "pivot.n as n_a", "pivot.c as c_a",
        "rep as rep_b", "n as n_b", "c as c_b", f"{BAND} as band",
    )
    own = ["rep_a", "n_a", "c_a", "rep_b", "n_b", "c_b"]
    pairs = sides.filter(sizes).groupBy(*own).agg(F.max("band").alias("band"))
    for side in "ab":
        of_side = sketches.toDF(
            f"rep_{side}", "band", *(f"{name}_{side}" for name in (*SKETCH, "rest"))
        )
        pairs = pairs.join(of_side, [f"rep_{side}", "band"])
    return pairs.filter(_close(percent))


def _all_pairs(found: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Close pairs of different components that share a signature, compared in the join."""
    rows = found.select("sig", "rep", "n", "c").withColumn("band", F.expr(BAND))
    rows = rows.join(sketches, ["rep", "band"]).drop("band")
    first, second = _side(rows, "a"), _side(rows, "b")
    met = (
        "rep_a < rep_b and c_a <> c_b"
        f" and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) and {_close(percent)}"
    )
    return first.join(second, (first["sig"] == second["sig"]) & F.expr(met))


def _linked(
    docs: DataFrame, shared: DataFrame, sketches: DataFrame, words: int, percent: int
) -> DataFrame:
    """(node, component) of all linked sets.

    ``shared`` has sig, rep and n. In each round every signature compares one pivot with
    its other sets, so a group of near copies takes as many comparisons as it has members.
    Sets that are linked by then are one component, and signatures within one component
    are done. When a round links few sets, all pairs of different components that are left
    are compared. Links within a component are never needed, so the components are exact.
    New links join components, not sets.
    """
    live = shared.withColumn("c", F.col("rep"))
    linked, gained, total = None, 0, 0
    for number in count():
        # One order of all sets, so that a group has one pivot in most signatures.
        pivots = (
            live.groupBy("sig")
            .agg(
                F.min("c").alias("low"),
                F.max("c").alias("high"),
                F.min_by(F.struct("rep", "n", "c"), F.xxhash64("rep", F.lit(number))).alias("pivot"),
            )
            .filter("low < high")
            .select("sig", "pivot")
        )
        found = staged(live.join(pivots, "sig"), "open-signatures")
        if found.isEmpty():
            break
        last = number > 0 and gained <= WORTHWHILE * total
        close = _all_pairs if last else _pairs_with_pivots
        pairs = close(found, sketches, percent)
        pairs = staged(pairs.select("rep_a", "c_a", "rep_b", "c_b").distinct(), "pairs")
        links = staged(_verified(docs, pairs, words, percent), "links")
        merged = staged(components(links), "merged")
        gained = merged.count()
        total += gained
        if linked is None:
            linked = merged
        else:
            linked = _moved(linked, "component", merged).unionByName(merged).distinct()
            linked = staged(linked, "linked")
        if last:
            break
        live = _moved(found.select("sig", "rep", "n", "c"), "c", merged)
    if linked is None:
        return live.selectExpr("rep as node", "c as component").limit(0)
    return linked


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``, which has doc_id and text.

    A set holds the distinct ``words``-word shingles of a text, A-Z taken as a-z; a text of
    fewer words is one shingle; a null or wordless text has none and links with nothing.
    Two documents link if 100 * |intersection| >= ``percent`` * |union|. component_id is
    the smallest doc_id that links lead to, itself included.

    Rows with one doc_id are one document: what links one of them links all. A row without
    a doc_id keeps its size, and its component is null. Other columns of ``docs`` are ignored.
    """
    slim, linked = similar_classes(docs, words, percent)
    joined = slim.join(linked.toDF("rep", "linked"), "rep", "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(
            F.col("doc_id").isNotNull(), F.coalesce("linked", "rep", "doc_id")
        ).alias("component_id"),
    )


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the members of a group of similar documents but its smallest doc_id.

    Rows that repeat the doc_id that stays are copies of it and are reduced to one.
    Documents without words or without doc_id stay. Columns and their order are kept.
    """
    groups = staged(jaccard_components(docs, words, percent), "groups")
    leave = groups.filter("component_id < doc_id").select("doc_id").distinct()
    kept = by_ids(docs, leave, "left_anti")
    repeated = groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    repeated = staged(repeated.select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    once = by_ids(kept, repeated, "left_semi").dropDuplicates(["doc_id"])
    return by_ids(kept, repeated, "left_anti").unionByName(once)
