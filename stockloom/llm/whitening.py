"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Entries become whole numbers, so sums over vectors are exact and do not depend on how
Spark deals the rows. Tasks add up sums, then the scatter around the rounded mean; only
these d + d * d numbers reach the driver, where d, the dimension, is some thousands at
most. The scatter is factored as L L' with pivoting; plane rotations then make the columns
of L orthogonal. Their squared norms are the eigenvalues, their directions the components.

Defined cases: vectors that are null or hold a null, NaN or infinity are dropped. A vector
shorter than the longest counts as followed by zeros, an empty one as all zeros. Entries
beyond the range of a long are clipped to it. Repeated rows stay, but equal vectors are
fitted once. Directions without variance are no components, so one vector, or none, gives
no rows. A deviation beyond the range of a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import staged

SCALE = 256
COMPONENTS = 4
# Rotations end when no two columns have a larger cosine than this times the dimension.
EPSILON = float(np.finfo(float).eps)
SWEEPS = 100
# Rows turned into one matrix at a time.
BLOCK = 4096

EXACT_DOUBLE, EXACT_LONG = 2**53, 2**62


class Whitening(NamedTuple):
    """A fit over ``n`` different vectors; ``components`` has one column per component."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    def scale(self) -> np.ndarray:
        """Columns that a centred vector is multiplied with."""
        return self.components / np.sqrt(self.eigenvalues)

    def centre(self) -> np.ndarray:
        return np.array([total / self.n for total in self.sums])


def whole_vectors(column: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the usable vectors, and their entries as longs without zeros at the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    present = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    column = column.drop_null()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    usable = bad[bounds[1:]] == bad[bounds[:-1]]
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(entries * float(scale))
        limit = float(2**63)
        longs = np.where(np.abs(scaled) < limit, scaled, 0.0).astype(np.int64)
    longs[scaled >= limit] = 2**63 - 1
    longs[scaled <= -limit] = -(2**63)
    filled = np.where(longs != 0, np.arange(1, len(longs) + 1), 0)
    vectors = []
    for row in np.flatnonzero(usable):
        low, high = bounds[row], bounds[row + 1]
        if high > low and not filled[high - 1]:
            high = max(low, int(filled[low:high].max()))
        vectors.append(longs[low:high])
    return present[usable], vectors


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the usable rows; x holds floor(scale * entry) as packed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = whole_vectors(batch.column("vector"), scale)
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array([v.tobytes() for v in found], pa.binary()),
                ],
                ["vec_id", "x"],
            )

    return vectors.select("vec_id", "vector").mapInArrow(run, "vec_id bigint, x binary")


def unpacked(column: pa.Array, width: int | None = None) -> Iterator[np.ndarray]:
    """Blocks of vectors as matrices of longs, as wide as the widest or as ``width``."""
    for first in range(0, len(column), BLOCK):
        packed = column.slice(first, BLOCK).to_pylist()
        lengths = [len(v) // 8 for v in packed]
        widest = max(lengths) if width is None else width
        if min(lengths) == widest:
            yield np.frombuffer(b"".join(packed), dtype=np.int64).reshape(len(packed), widest)
            continue
        block = np.zeros((len(packed), widest), dtype=np.int64)
        for row, vector in enumerate(packed):
            block[row, : lengths[row]] = np.frombuffer(vector, dtype=np.int64)
        yield block


def largest(block: np.ndarray) -> int:
    """The largest absolute entry."""
    return max(int(block.max()), -int(block.min())) if block.size else 0


def gram(block: np.ndarray) -> np.ndarray:
    """The exact products of all columns, as Python numbers where longs are too short."""
    bound = largest(block) ** 2 * len(block)
    if bound < EXACT_DOUBLE:
        wide = block.astype(float)
        return (wide.T @ wide).astype(np.int64)
    exact = block if bound < EXACT_LONG else block.astype(object)
    return exact.T @ exact


def around(block: np.ndarray, centre: list[int]) -> np.ndarray:
    """``block`` less a vector of whole numbers, exactly."""
    far = max((abs(c) for c in centre), default=0)
    if far + largest(block) < EXACT_LONG:
        return block - np.array(centre, dtype=np.int64)
    return block.astype(object) - np.array(centre, dtype=object)


def _cells(totals: dict[int, int]) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array(list(totals), pa.int64()),
            pa.array([Decimal(v) for v in totals.values()], pa.decimal128(38, 0)),
        ],
        ["cell", "total"],
    )


def _totals(df: DataFrame, run) -> dict[int, int]:
    """Sums by cell of what ``run`` emits once per task."""
    cells = df.mapInArrow(run, "cell bigint, total decimal(38,0)")
    cells = cells.groupBy("cell").agg(F.sum("total").alias("total"))
    return {row.cell: int(row.total) for row in cells.collect()}


def _count_and_sums(fit: DataFrame) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, int] = {-1: 0}
        for batch in batches:
            for block in unpacked(batch.column("x")):
                totals[-1] += len(block)
                short = largest(block) * len(block) < EXACT_LONG
                sums = (block if short else block.astype(object)).sum(axis=0)
                for place, value in enumerate(sums.tolist()):
                    totals[place] = totals.get(place, 0) + value
        yield _cells(totals)

    totals = _totals(fit, run)
    n = totals.pop(-1, 0)
    return n, [totals[place] for place in range(len(totals))]


def _scatter(fit: DataFrame, centre: list[int]) -> np.ndarray:
    """Products of the columns around ``centre``, as a matrix of Python numbers."""
    width = len(centre)
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), dtype=object)
        pending, room = np.zeros((width, width), dtype=np.int64), EXACT_LONG
        for batch in batches:
            for block in unpacked(batch.column("x"), width):
                moved = around(block, centre)
                need = largest(moved) ** 2 * len(moved)
                if need >= room:
                    total, room = total + pending.astype(object), EXACT_LONG
                    pending[:] = 0
                products = gram(moved)
                if need >= EXACT_LONG:
                    total = total + products
                else:
                    pending += products
                    room -= need
        total = total + pending.astype(object)
        cells = upper[0] * width + upper[1]
        yield _cells(dict(zip(cells.tolist(), total[upper].tolist(), strict=True)))

    totals = _totals(fit, run)
    found = np.zeros((width, width), dtype=object)
    for cell, value in totals.items():
        i, j = divmod(cell, width)
        found[i, j] = found[j, i] = value
    return found


def covariance(n: int, sums: list[int], fit: DataFrame) -> np.ndarray:
    """The covariance with divisor ``n``, each entry rounded once."""
    centre = [(2 * total + n) // (2 * n) for total in sums]
    products = _scatter(fit, centre)
    rest = [total - n * c for total, c in zip(sums, centre, strict=True)]
    width = len(sums)
    found = np.empty((width, width))
    for i in range(width):
        for j in range(i, width):
            exact = n * products[i, j] - rest[i] * rest[j]
            found[i, j] = found[j, i] = exact / (n * n)
    return found


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with L L' = ``matrix``, positive semidefinite; one column per rank.

    Each step takes the largest diagonal entry left, so rows in the order of the pivots
    form a triangle. It ends where rounding alone could have left what remains.
    """
    size = len(matrix)
    left = np.diag(matrix).astype(float).copy()
    least = size * EPSILON * max(left.max(initial=0.0), 0.0)
    factor = np.zeros((size, size))
    free = np.ones(size, dtype=bool)
    for step in range(size):
        pivot = int(np.argmax(np.where(free, left, -np.inf)))
        if left[pivot] <= least:
            return factor[:, :step]
        free[pivot] = False
        column = np.where(free, matrix[:, pivot] - factor[:, :step] @ factor[pivot, :step], 0.0)
        root = np.sqrt(left[pivot])
        factor[:, step] = column / root
        factor[pivot, step] = root
        left -= factor[:, step] ** 2
    return factor


def _rounds(count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of ``count`` columns in rounds of disjoint pairs, as in a tournament."""
    seats = list(range(count + count % 2))
    found = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [
            (a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True)
            if max(a, b) < count
        ]
        found.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return found


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """``factor`` times the rotations that make its columns orthogonal, longest first."""
    columns = factor.copy()
    rounds = _rounds(columns.shape[1])
    limit = max(columns.shape[0], 1) * EPSILON
    for _ in range(SWEEPS):
        moved = False
        for p, q in rounds:
            a, b = columns[:, p], columns[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            turn = np.abs(ab) > limit * np.sqrt(aa * bb)
            if not turn.any():
                continue
            moved = True
            ratio = (bb - aa) / np.where(turn, 2.0 * ab, 1.0)
            tangent = np.where(ratio < 0, -1.0, 1.0) / (np.abs(ratio) + np.hypot(1.0, ratio))
            tangent = np.where(turn, tangent, 0.0)
            cosine = 1.0 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            columns[:, p], columns[:, q] = cosine * a - sine * b, sine * a + cosine * b
        if not moved:
            norms = np.sqrt((columns * columns).sum(axis=0))
            return columns[:, np.argsort(-norms, kind="stable")]
    raise RuntimeError(f"columns are not orthogonal after {SWEEPS} sweeps")


def principal_axes(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors whose largest entry is positive."""
    columns = orthogonal_columns(pivoted_cholesky(matrix))
    norms = np.sqrt((columns * columns).sum(axis=0))
    axes = columns / norms
    strongest = np.argmax(np.abs(axes), axis=0)
    axes = axes * np.where(axes[strongest, np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return norms * norms, axes


def _identity_error(fit: DataFrame, centre: np.ndarray, scale: np.ndarray, n: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance less the identity."""
    count = scale.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            for block in unpacked(batch.column("x"), len(centre)):
                white = (block - centre) @ scale
                sums += white.sum(axis=0)
                products += white.T @ white
        values = np.concatenate([sums, products.ravel()])
        yield pa.record_batch(
            [pa.array(np.arange(len(values))), pa.array(values)], ["cell", "total"]
        )

    cells = fit.mapInArrow(run, "cell bigint, total double").groupBy("cell").agg(F.sum("total"))
    values = np.zeros(count + count * count)
    for cell, total in cells.collect():
        values[cell] = total
    mean, products = values[:count] / n, values[count:].reshape(count, count) / n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(count)).max())


def fitted(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """A fit to the different vectors of ``x``, a stored ``quantised`` table.

    None if they have no variance. Equal vectors meet by a distinct aggregate, which
    reduces copies in each task before they move.
    """
    fit = staged(x.select("x").distinct(), "different-vectors")
    n, sums = _count_and_sums(fit)
    if n < 2:
        return None
    matrix = covariance(n, sums, fit)
    values, axes = principal_axes(matrix)
    kept = min(components, len(values))
    if kept == 0:
        return None
    model = Whitening(n, sums, axes[:, :kept], values[:kept], float(np.trace(matrix)), 0.0)
    error = _identity_error(fit, model.centre(), model.scale(), n)
    return model._replace(identity_error=error)


def deviations(block: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2 for each row, exactly."""
    far = n * largest(block) + max((abs(s) for s in sums), default=0)
    if far**2 * max(len(sums), 1) < EXACT_LONG:
        moved = block * n - np.array(sums, dtype=np.int64)
        return (moved * moved).sum(axis=1).tolist()
    moved = block.astype(object) * n - np.array(sums, dtype=object)
    return [v if v < 2**63 else None for v in (moved * moved).sum(axis=1).tolist()]


def whitened(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, vector) and component.

    Columns: vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened,
    explained and identity_error. Other columns of ``vectors`` are ignored.
    """
    x = staged(quantised(vectors, scale), "whole-vectors")
    model = fitted(x, components)
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    if model is None:
        return x.sparkSession.createDataFrame([], schema)
    centre, factors = model.centre(), model.scale()
    explained = model.eigenvalues / model.trace
    count = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for block in unpacked(batch.column("x"), len(centre)):
                rows = len(block)
                ids = batch.column("vec_id").slice(first, rows)
                first += rows
                each = pa.array(np.repeat(np.arange(rows), count))
                moved = pa.array(deviations(block, model.n, model.sums), pa.int64())
                yield pa.record_batch(
                    [
                        ids.take(each),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * count, model.n, dtype=np.int64)),
                        moved.take(each),
                        pa.array(((block - centre) @ factors).ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * count, model.identity_error)),
                    ],
                    [part.split()[0] for part in schema.split(", ")],
                )

    return x.mapInArrow(run, schema)
