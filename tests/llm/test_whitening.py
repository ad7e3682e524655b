import math
from fractions import Fraction

import numpy as np
import pytest

from stockloom.llm import whitening

SCHEMA = "vec_id bigint, vector array<float>"


def brute(rows, components=4):
    """Exact sums over different vectors; numpy's eigenvectors; no code of the module."""
    kept = [
        (i, [math.floor(256 * float(c)) + 0 for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    width = max(len(x) for _, x in kept)
    kept = [(i, x + [0] * (width - len(x))) for i, x in kept]
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    sums = [sum(column) for column in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(x, sums)] for x in fit])
    matrix = centred.T @ centred / n
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for i, x in kept:
        moved = [n * v - s for v, s in zip(x, sums)]
        white = np.array([m / n for m in moved]) @ axes / np.sqrt(values)
        out[i] = (sum(m * m for m in moved), white)
    return n, out, values / np.trace(matrix)


def close_up_to_sign(a, b):
    return np.allclose(a, b, atol=1e-9) or np.allclose(a, -b, atol=1e-9)


def test_whitening_equals_brute_force(spark):
    draw = np.random.default_rng(5)
    spread = np.array([3.0, 2.0, 1.2, 0.7, 0.5, 0.4, 0.3, 0.2])
    turn = np.linalg.qr(draw.normal(size=(8, 8)))[0]
    vectors = (draw.normal(size=(300, 8)) * spread) @ turn + 5.0
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]
    rows += [(2000, None), (2001, [None] * 8), (2002, [math.nan] * 8), (2003, [math.inf] + [0.0] * 7)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    frame = frame.withColumn("x", frame.vec_id).withColumn("n", frame.vec_id)
    found = whitening.whitened(frame).collect()
    n, wanted, explained = brute(rows)
    assert n == 300 and len(found) == 500 * 4
    by_id = {}
    for row in found:
        assert row.n == n and row.identity_error <= 1e-9
        assert row.deviation == wanted[row.vec_id][0]
        assert row.explained == pytest.approx(explained[row.component - 1], rel=1e-9)
        by_id.setdefault(row.vec_id, {})[row.component] = row.whitened
    assert set(by_id) == set(wanted)
    ids = sorted(by_id)
    for k in range(4):
        ours = np.array([by_id[i][k + 1] for i in ids])
        assert close_up_to_sign(ours, np.array([wanted[i][1][k] for i in ids]))


def test_awkward_vectors(spark):
    def whiten(rows):
        return whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()

    assert whiten([]) == []
    assert whiten([(1, None), (2, [math.nan])]) == []
    assert whiten([(1, [0.5, 1.0]), (2, [0.5, 1.0])]) == []
    assert whiten([(1, []), (2, [])]) == []
    # A shorter vector is followed by zeros; one direction has all the variance.
    found = whiten([(1, [1.0, 0.0]), (2, [1.0]), (None, [3.0, 0.0, 0.0]), (4, [])])
    assert {(r.vec_id, r.component) for r in found} == {(1, 1), (2, 1), (None, 1), (4, 1)}
    by_id = {r.vec_id: r for r in found}
    assert by_id[1].n == 3 and by_id[1].explained == pytest.approx(1.0)
    assert by_id[1].whitened == by_id[2].whitened
    assert by_id[4].deviation == 1024**2
    # Values far beyond doubles' whole numbers stay exact or null, never wrong.
    big = whiten([(1, [3.0e38, 1.0]), (2, [1.0e15, 2.0]), (3, [-1.0e15, 3.0])])
    assert len(big) > 0 and all(r.deviation is None or r.deviation >= 0 for r in big)


def test_factor_and_rotations():
    draw = np.random.default_rng(11)
    for size, rank in ((1, 1), (5, 5), (9, 4), (33, 33)):
        base = draw.normal(size=(size, rank)) * np.logspace(0, -3, rank)
        matrix = base @ base.T
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape == (size, rank)
        assert np.allclose(factor @ factor.T, matrix, atol=1e-13)
        values, axes = whitening.principal_axes(matrix)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], atol=1e-13)
        assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-10)
        assert np.allclose(matrix @ axes, axes * values, atol=1e-12)
    # Equal eigenvalues and a zero matrix.
    values, axes = whitening.principal_axes(np.eye(6))
    assert np.allclose(values, 1.0) and np.allclose(axes.T @ axes, np.eye(6))
    assert whitening.principal_axes(np.zeros((3, 3)))[1].shape == (3, 0)
    pairs = {tuple(sorted(p)) for a, b in whitening._rounds(7) for p in zip(a.tolist(), b.tolist())}
    assert len(pairs) == 21


def test_query_over_the_whole_table(spark):
    from stockloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [
        (r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ]
    n, wanted, explained = brute(rows)
    found = QUERIES["op13_whitening"](spark, folder).collect()
    assert len(found) == 4 * len(wanted)
    assert all(r.deviation == wanted[r.vec_id][0] and r.n == n for r in found)
    assert all(r.identity_error < 1e-9 for r in found)
    assert all(abs(r.explained / explained[r.component - 1] - 1) < 1e-9 for r in found)
