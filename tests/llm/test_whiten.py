"""Whitening against NumPy's eigenvectors and exact rational arithmetic; edge cases."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from drawlake.llm import whiten as W

SCHEMA = "vec_id long, embedding array<float>, n string, x string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], SCHEMA)


def gaussian(n, d, seed=1, copies=3):
    rnd = np.random.default_rng(seed)
    m = (rnd.normal(size=(n, d)) * np.linspace(3, 0.2, d)).astype(np.float32)
    return [(k, [float(x) for x in m[k // copies if k < n // 2 else k]]) for k in range(n)]


def usable(rows):
    return [(i, [math.floor(64.0 * c) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def check(spark, rows, count):
    got = W.whiten(frame(spark, rows), count).collect()
    x = usable(rows)
    fit = np.array(sorted({tuple(v) for _, v in x}), dtype=np.int64)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit * n - s) / n
    cov = centred.T @ centred / n
    value = np.sort(np.linalg.eigvalsh(cov))[::-1]
    positive = int((value > value[0] * 1e-9).sum()) if n > 1 else 0
    k = min(count, positive)
    assert len(got) == len(x) * k
    by = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(value[r.component - 1] / np.trace(cov), rel=1e-9)
        by.setdefault(r.component, {}).setdefault((r.vec_id, r.deviation), []).append(r.whitened)
    want = {(i, sum((n * a - int(b)) ** 2 for a, b in zip(v, s, strict=True))) for i, v in x}
    for c in by:
        assert set(by[c]) == want
    return by, x, cov, value


def test_equals_eigenvectors(spark):
    rows = gaussian(240, 9)
    by, x, cov, value = check(spark, rows, 5)
    vectors = np.linalg.eigh(cov)[1][:, ::-1]
    mean = np.array(sorted({tuple(v) for _, v in x}), dtype=float).mean(axis=0)
    for c in range(1, 6):
        plain = {i: float((np.array(v) - mean) @ vectors[:, c - 1]) / math.sqrt(value[c - 1]) for i, v in x}
        sign = None
        for (i, _), found in by[c].items():
            if abs(plain[i]) > 1e-3:
                sign = sign or math.copysign(1, plain[i] * found[0])
                assert found[0] == pytest.approx(sign * plain[i], rel=1e-7)


def test_edges(spark):
    rows = gaussian(60, 4) + [(900, None), (901, [1.0, None, 0.0, 0.0]), (902, [float("nan")] * 4), (903, [float("inf"), 0.0, 0.0, 0.0]),
                              (None, [1.0, 2.0, 3.0, 4.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    check(spark, rows, 16)  # only four components
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # one distinct vector: no variance
    flat = [(k, [float(k), 2.0 * k, 0.5]) for k in range(30)]  # rank one
    assert {r.component for r in W.whiten(frame(spark, flat)).collect()} == {1}
    short = [(k, [float(k % 5), float(k % 3)][:1 + k % 2]) for k in range(30)]
    padded = [(k, [*v, 0.0][:2]) for k, v in short]
    assert len(W.whiten(frame(spark, short)).collect()) == 60
    check(spark, padded, 2)
    huge = W.whiten(frame(spark, [(k, [3e38 * (-1) ** k, float(k)]) for k in range(6)])).collect()
    assert all(math.isfinite(r.whitened) for r in huge) and len(huge) == 12
    with pytest.raises(ValueError):
        W.whiten(frame(spark, [(1, [1.0] * 5)]), max_dims=4)


def test_equal_eigenvalues(spark):
    rows = [(k, [float((k >> j) & 1) for j in range(4)]) for k in range(16)]  # all four variances are the same
    got = W.whiten(frame(spark, rows), 4).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and max(r.identity_error for r in got) < 1e-9
    assert {round(r.explained, 9) for r in got} == {0.25}


def leverrier(m):
    """Coefficients from x^0 up by Faddeev and LeVerrier, in fractions."""
    d, c = len(m), [Fraction(1)]
    b = [[0] * d for _ in range(d)]
    for k in range(1, d + 1):
        b = [[sum(m[i][t] * b[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(Fraction(-sum(m[i][t] * b[t][i] for i in range(d) for t in range(d)), k))
    return [int(v) for v in reversed(c)]


@pytest.mark.parametrize("d", [1, 2, 5, 8])
def test_polynomial_is_exact(spark, d):
    rnd = random.Random(d)
    a = [[rnd.randint(-10 ** 6, 10 ** 6) if rnd.random() < 0.6 else 0 for _ in range(d)] for _ in range(d)]
    m = [[sum(a[t][i] * a[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
    assert W.characteristic_polynomial(spark, m) == leverrier(m)
    small = W.polynomials_mod(a, [5, 7, 2 ** 31 - 1])  # not symmetric, with zero pivots
    for row, p in zip(small.tolist(), [5, 7, 2 ** 31 - 1], strict=True):
        assert row == [v % p for v in leverrier(a)]


def test_roots():
    def poly(roots):
        p = [1]
        for r in roots:
            p = [(p[k - 1] if k else 0) - r * (p[k] if k < len(p) else 0) for k in range(len(p) + 1)]
        return p
    found = W.largest_roots(poly([0, 0, 3, 3, 7, 10 ** 20, 10 ** 20 + 1]), 5)
    assert [(int(v.to_integral_value()), m) for v, m in found] == [(10 ** 20 + 1, 1), (10 ** 20, 1), (7, 1), (3, 2)]
    assert W.largest_roots([0, 0, 1], 3) == [] and W.largest_roots([1], 3) == []
    assert W.primes_below(2 ** 31, 2) == [2 ** 31 - 1, 2 ** 31 - 19]


def test_products_in_whole_numbers():
    for top in (10, 2 ** 40):
        m = np.array([[top, -3], [5, top - 1], [top, top]], dtype=np.int64)
        want = [[sum(int(r[i]) * int(r[j]) for r in m) for j in range(2)] for i in range(2)]
        assert W.exact_products(m).tolist() == want
