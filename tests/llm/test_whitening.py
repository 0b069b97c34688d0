"""Whitening against numpy's eigenvectors and exact Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from motionloom.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int, component string, x double, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 0.5, "n") for i, v in rows], SCHEMA)


def by_force(rows, components=4):
    """{vec_id: [(deviation, whitened)]} with vectors of either sign, share of each component and the number of distinct vectors."""
    lengths = [len(v) for _, v in rows]
    width = max(set(lengths), key=lambda k: (lengths.count(k), k))
    kept = [(i, [max(min(math.floor(256 * c), 2**63 - 1), -2**63) for c in v]) for i, v in rows if len(v) == width]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    away = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit], float) / n
    values, vectors = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-values)[:components]
    turned = vectors[:, order] / np.sqrt(values[order])
    out = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), (np.array([n * a - s for a, s in zip(x, sums, strict=True)], float) / n) @ turned) for i, x in kept]
    return out, values[order] / values.sum(), n


def compared(spark, rows, extra=()):
    got = whitening.whitened(frame(spark, [*rows, *extra])).collect()
    want, explained, n = by_force(rows)
    assert len(got) == len(want) * 4 and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for k in range(4):
        mine = sorted(((r.vec_id is None, r.vec_id or 0, r.deviation or -1, r.whitened) for r in got if r.component == k + 1))
        theirs = sorted(((i is None, i or 0, d if d < 1 << 63 else -1, w[k]) for i, d, w in want))
        a, b = np.array([m[3] for m in mine]), np.array([t[3] for t in theirs])
        sign = np.sign(a @ b)
        if sign < 0:  # the order among repeated rows does not depend on the sign, since they are equal
            theirs = sorted((i, j, d, -w) for i, j, d, w in theirs)
        assert [m[:3] for m in mine] == [t[:3] for t in theirs]
        assert np.allclose(a, [t[3] for t in theirs], rtol=1e-6, atol=1e-9)
        assert all(abs(r.explained - explained[k]) < 1e-9 for r in got if r.component == k + 1)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(9) * np.arange(1, 10)).tolist()) for k in range(300)]
    rows += [(7, rows[7][1])] * 150 + [(None, rows[3][1]), (None, [0.0] * 9), (400, [-0.0] * 9), (401, [-0.001] * 9), (-5, rows[9][1])]
    extra = [(500, None), (501, []), (502, [1.0, 2.0]), (503, [1.0] * 8 + [None]), (504, [float("nan")] * 9), (505, [float("-inf")] * 9)]
    compared(spark, rows, extra)


def test_large_entries(spark):
    """Entries of 40 bits: products beyond 64 bits stay exact, deviations beyond a long are NULL."""
    rng = np.random.default_rng(3)
    rows = [(k, (rng.standard_normal(6) * 2.0 ** np.arange(8, 38, 5)).tolist()) for k in range(200)]
    compared(spark, rows)


def test_exact_scatter(spark):
    rng = np.random.default_rng(4)
    x = [[int(v) for v in rng.integers(-2**62, 2**62, 5)] for _ in range(300)] + [[2**63 - 1, -2**63, 0, 1, -1]]
    n, sums, matrix = whitening.scatter(spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(7))
    assert n == len(x) and sums == [sum(c) for c in zip(*x, strict=True)]
    assert matrix == [[n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(5)] for i in range(5)]


def test_polynomial_and_roots(spark):
    eigen = [90, 90, 17, 17, 17, 5, 1, 0, 0]
    rng = np.random.default_rng(5)
    polynomial = [1]
    for e in eigen:
        polynomial = [(polynomial[k - 1] if k else 0) - e * (polynomial[k] if k < len(polynomial) else 0) for k in range(len(polynomial) + 1)]
    diagonal = [[e if i == j else 0 for j in range(9)] for i, e in enumerate(eigen)]
    assert whitening.characteristic_polynomial(spark, diagonal) == polynomial
    assert [round(y / 2**s, 12) for y, s in whitening.largest_roots(polynomial, 9)] == eigen[:7]
    factor = rng.integers(-9, 9, (7, 7))
    matrix = (factor.T @ factor).tolist()
    got = whitening.characteristic_polynomial(spark, matrix)
    assert np.allclose(np.array(got[::-1], float), np.poly(np.array(matrix, float)), rtol=1e-6)
    assert got[0] == -round(np.linalg.det(factor.astype(float))) ** 2
    vectors = np.array(whitening.null_vectors(diagonal, whitening.largest_roots(polynomial, 6)), float)
    assert np.allclose(vectors @ vectors.T, np.eye(6)) and np.allclose(vectors @ np.array(diagonal), np.array(eigen[:6])[:, None] * vectors)
    assert whitening.largest_roots([-3, 1 << 40], 1)[0][0] / 2 ** whitening.largest_roots([-3, 1 << 40], 1)[0][1] == pytest.approx(3 / 2**40)


def test_few_components(spark):
    assert whitening.whitened(frame(spark, [])).count() == 0
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    got = whitening.whitened(frame(spark, [(k, [float(k), 2.0 * k, 3.0]) for k in range(4)])).collect()
    assert [r.component for r in got] == [1] * 4 and all(abs(r.explained - 1) < 1e-12 for r in got)
    assert sorted(abs(r.whitened) for r in got) == pytest.approx([0.4472135955, 0.4472135955, 1.3416407865, 1.3416407865])
