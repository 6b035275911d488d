"""Embedding whitening from an exact characteristic polynomial.

Vectors become integers, so their scatter matrix is known exactly. Its
characteristic polynomial is computed modulo many primes (Hessenberg
reduction), joined by Chinese remaindering, and its largest roots are
isolated in exact rational arithmetic: every root is real, so by Descartes'
rule the sign changes of the polynomial shifted by ``a`` *are* the number of
roots beyond ``a``. Components are null vectors of ``scatter - root * I``,
found by inverse iteration in long decimals.

Spark makes the sums, deals the primes and the components over tasks, and
projects the rows; the driver holds d x d numbers for vectors of d entries.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drawlake.llm.common import prepare, write_and_reread

#: Decimal digits of the null vectors, and binary digits of a root relative to its size.
DIGITS, ROOT_BITS = 90, 200
#: Scaled entries beyond this size count as this size, so that they stay exact in a double and a long.
LARGEST = 2 ** 52
#: Primes handled by one task; rows of one block.
PRIMES_A_TASK, BLOCK = 16, 4096


def integer_entries(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """floor(scale * c) + shift of each entry, c as double; null for a vector that is null or holds
    a null or non-finite entry. Scaled entries are limited to +-2^52."""
    c = vector.cast("array<double>")
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    edge = lambda v: F.greatest(F.least(v * float(scale), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    return F.when(c.isNotNull() & ~F.coalesce(bad, F.lit(True)),
                  F.transform(c, lambda v: F.floor(edge(v)).cast("long") + shift))


def _matrices(batches: Iterator[pa.RecordBatch], column: str, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of at most ``BLOCK`` rows with their vectors as a zero-padded matrix."""
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK)
            lists = part.column(column)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if len(flat) == dims * part.num_rows:
                yield part, flat.reshape(part.num_rows, dims)
                continue
            m = np.zeros((part.num_rows, dims), dtype=flat.dtype)
            for k, v in enumerate(lists.to_pylist()):
                m[k, :len(v)] = v
            yield part, m


def exact_products(m: np.ndarray) -> np.ndarray:
    """m^T m in whole numbers: by doubles where every sum stays below 2^53, else by Python's."""
    most = int(np.abs(m).max(initial=0))
    if most * most * max(len(m), 1) < 2 ** 53:
        f = m.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = m.astype(object)
    return o.T @ o


@dataclass(frozen=True)
class Scatter:
    """Exact sums over the fit list: n vectors, sums S per dimension, and n * sum(x x^T) - S S^T."""

    n: int
    sums: list[int]
    matrix: list[list[int]]

    @property
    def trace(self) -> int:
        return sum(self.matrix[k][k] for k in range(len(self.sums)))


def scatter(fit: DataFrame, dims: int, shift: int = 1_000_000) -> Scatter:
    """Sums of the vectors (column ``x``) of a fit list; one row per pair of dimensions reaches the driver."""
    upper = [(i, j) for i in range(dims) for j in range(i, dims)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object)
        for _, m in _matrices(batches, "x", dims):
            m = m - shift  # the scatter does not change with the origin, and small numbers are fast
            n += len(m)
            sums = sums + m.astype(object).sum(axis=0)
            products = products + exact_products(m)
        if n:
            i, j = [-1, *[-1] * dims, *(a for a, _ in upper)], [-1, *range(dims), *(b for _, b in upper)]
            v = [n, *sums.tolist(), *(products[a, b] for a, b in upper)]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([str(x) for x in v], pa.string())], names=["i", "j", "v"])

    rows = fit.select("x").mapInArrow(add, "i int, j int, v string")
    total = {(r["i"], r["j"]): int(r["v"]) for r in
             rows.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    n = total.get((-1, -1), 0)
    y = [total.get((-1, k), 0) for k in range(dims)]
    matrix = [[n * total.get((min(a, b), max(a, b)), 0) - y[a] * y[b] for b in range(dims)] for a in range(dims)]
    return Scatter(n, [v + n * shift for v in y], matrix)


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top`` (at most 2^31), by deterministic Miller-Rabin."""
    def prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # settles every number below 3.2 * 10^9
            x = pow(base, odd, p)
            if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(twos - 1)):
                return False
        return True

    out, p = [], top - 1 - top % 2
    while len(out) < count:
        if prime(p):
            out.append(p)
        p -= 2
    return out


def polynomials_mod(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Characteristic polynomial of the matrix modulo each prime (below 2^31): coefficients from x^0 up.

    All primes go through the same steps as one array. Similarity transforms
    bring the matrix to Hessenberg form, whose polynomials follow by recurrence.
    """
    d, k = len(matrix), len(primes)
    p = np.array(primes, dtype=np.int64)
    h = np.array([[[v % q for v in row] for row in matrix] for q in primes], dtype=np.int64).reshape(k, d, d)
    each = np.arange(k)
    p1, p2 = p[:, None], p[:, None, None]
    for m in range(1, d - 1):
        nonzero = h[:, m:, m - 1] != 0
        pivot = m + np.argmax(nonzero, axis=1)
        some = nonzero.any(axis=1)  # otherwise the column is already clear, and the factors are 0
        a, b = h[each, m].copy(), h[each, pivot].copy()
        h[each, m], h[each, pivot] = b, a
        a, b = h[each, :, m].copy(), h[each, :, pivot].copy()
        h[each, :, m], h[each, :, pivot] = b, a
        inverse = np.array([pow(int(v), -1, q) if ok else 0 for v, q, ok in zip(h[:, m, m - 1], primes, some, strict=True)],
                           dtype=np.int64)
        u = h[:, m + 1:, m - 1] * inverse[:, None] % p1
        h[:, m + 1:] = (h[:, m + 1:] - u[:, :, None] * h[:, m:m + 1] % p2) % p2
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * u[:, None, :] % p2).sum(axis=2)) % p1
    poly = [np.zeros((k, d + 1), dtype=np.int64)]
    poly[0][:, 0] = 1
    for m in range(d):
        new = np.zeros((k, d + 1), dtype=np.int64)
        new[:, 1:] = poly[m][:, :-1]
        new = (new - h[:, m, m, None] * poly[m] % p1) % p1
        t = np.ones(k, dtype=np.int64)
        for i in range(m - 1, -1, -1):
            t = t * h[:, i + 1, i] % p
            new = (new - (h[:, i, m] * t % p)[:, None] * poly[i] % p1) % p1
        poly.append(new)
    return poly[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients (from x^0 up) for a positive semidefinite integer matrix.

    The coefficient of x^(d-k) is, but for its sign, the k-th elementary
    symmetric sum of the eigenvalues, so none exceeds (1 + trace / d)^d; the
    primes' product exceeds twice that. Tasks take the primes in groups.
    """
    prepare(spark)
    d = len(matrix)
    bits = d * (sum(matrix[k][k] for k in range(d)) // d + 2).bit_length() + 2
    primes = primes_below(2 ** 31, -(-bits // 30))
    groups = [primes[k:k + PRIMES_A_TASK] for k in range(0, len(primes), PRIMES_A_TASK)]
    sent = spark.sparkContext.broadcast((matrix, groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in batch.column(0).to_pylist():
                own = sent.value[1][g]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int64()), pa.array(polynomials_mod(sent.value[0], own).tolist(), pa.list_(pa.int64()))],
                    names=["prime", "coefficients"])

    rows = (spark.range(0, len(groups), 1, len(groups))
            .mapInArrow(run, "prime long, coefficients array<long>").collect())  # one row per prime
    value, modulus = [0] * (d + 1), 1
    for r in sorted(rows):
        q = r["prime"]
        inverse = pow(modulus, -1, q)
        value = [v + modulus * ((c - v) * inverse % q) for v, c in zip(value, r["coefficients"], strict=True)]
        modulus *= q
    return [v - modulus if 2 * v > modulus else v for v in value]


def _roots_beyond(poly: list[int], num: int, bits: int) -> int:
    """Number of roots greater than num / 2^bits, counted as often as they occur (all roots are real)."""
    d = len(poly) - 1
    c = [v << (bits * (d - k)) for k, v in enumerate(poly)]  # roots times 2^bits
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += num * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign_at(poly: list[int], num: int, bits: int) -> int:
    total, scale = 0, 0
    for v in reversed(poly):
        total, scale = total * num + (v << scale), scale + bits
    return (total > 0) - (total < 0)


def largest_roots(poly: list[int], count: int, root_bits: int = ROOT_BITS) -> list[tuple[Decimal, int]]:
    """The positive roots in falling order with their multiplicities, until ``count`` roots are reached.

    Bisection by exact counts isolates the roots, bisection by the sign at
    exact binary fractions narrows each down to ``root_bits`` binary digits.
    Roots that agree in all of them count as one of higher multiplicity.
    """
    zeros = next((k for k, v in enumerate(poly) if v), len(poly))
    poly = poly[zeros:]  # the remaining roots are positive
    if len(poly) <= 1:
        return []
    top = 1
    while _roots_beyond(poly, top, 0):
        top *= 2
    out: list[tuple[Decimal, int]] = []
    # (low, high, bits, roots beyond low, roots beyond high); the interval is low < root <= high over 2^bits
    stack = [(0, top, 0, len(poly) - 1, 0)]
    with decimal.localcontext() as ctx:
        ctx.prec = DIGITS
        while stack and sum(m for _, m in out) < count:
            low, high, bits, under, over = stack.pop()
            if under == over:
                continue
            if (high - low) << root_bits <= low:
                out.append((Decimal(low + high) / 2 / Decimal(2) ** bits, under - over))
                continue
            if (high - low) & 1:
                low, high, bits = 2 * low, 2 * high, bits + 1
            middle = (low + high) // 2
            if under - over == 1:
                here = _sign_at(poly, middle, bits)
                if here == 0:  # the root itself
                    out.append((Decimal(middle) / Decimal(2) ** bits, 1))
                    continue
                between = under if here == (-1) ** under else over  # r roots beyond a point: its sign is (-1)^r
            else:
                between = _roots_beyond(poly, middle, bits)
            stack.append((low, middle, bits, under, between))
            stack.append((middle, high, bits, between, over))
    return out


def null_vectors(matrix: list[list[int]], root: Decimal, count: int, steps: int = 4) -> list[list[float]]:
    """``count`` orthonormal vectors of the space in which ``matrix`` acts as ``root``.

    Inverse iteration: the shifted matrix, a tiny step beside singular, is
    factored once with pivots and solved again and again from fixed starts;
    several vectors of one root are orthogonalised after every step.
    """
    d = len(matrix)
    with decimal.localcontext() as ctx:
        ctx.prec = DIGITS
        a = [[Decimal(v) for v in row] for row in matrix]
        for k in range(d):
            a[k][k] -= root
        tiny = max(abs(root), Decimal(1)) * Decimal(10) ** (-DIGITS + 5)
        order = list(range(d))
        for k in range(d):
            pivot = max(range(k, d), key=lambda r: abs(a[r][k]))
            a[k], a[pivot] = a[pivot], a[k]
            order[k], order[pivot] = order[pivot], order[k]
            if abs(a[k][k]) < tiny:
                a[k][k] = tiny
            row = a[k]
            for r in range(k + 1, d):
                f = a[r][k] / row[k]
                a[r][k] = f
                if f:
                    own = a[r]
                    for c in range(k + 1, d):
                        own[c] -= f * row[c]

        def solve(b: list[Decimal]) -> list[Decimal]:
            y = [b[i] for i in order]
            for r in range(d):
                y[r] -= sum(map(Decimal.__mul__, a[r][:r], y[:r]), Decimal(0))
            for r in range(d - 1, -1, -1):
                y[r] = (y[r] - sum(map(Decimal.__mul__, a[r][r + 1:], y[r + 1:]), Decimal(0))) / a[r][r]
            return y

        def orthonormal(vectors: list[list[Decimal]]) -> list[list[Decimal]]:
            out: list[list[Decimal]] = []
            for v in vectors:
                size = sum(x * x for x in v).sqrt()
                v = [x / size for x in v]
                for _ in range(2):
                    for o in out:
                        t = sum(map(Decimal.__mul__, v, o), Decimal(0))
                        v = [x - t * y for x, y in zip(v, o, strict=True)]
                size = sum(x * x for x in v).sqrt()
                out.append([x / size for x in v])
            return out

        # Fixed starts without a pattern that an eigenvector could be orthogonal to.
        vectors = [[Decimal(((i + 1) * 2654435761 + (j + 1) ** 2 * 40503) % 65521 + 1) for i in range(d)] for j in range(count)]
        for _ in range(steps):
            vectors = orthonormal([solve(v) for v in vectors])
        return [[float(x) for x in v] for v in vectors]


@dataclass(frozen=True)
class Whitening:
    """Sums of the fit list and its leading components, by falling eigenvalue of the covariance."""

    n: int
    sums: tuple[int, ...]
    components: tuple[tuple[float, ...], ...]
    eigenvalues: tuple[float, ...]
    explained: tuple[float, ...]

    def projection(self) -> np.ndarray:
        """d x k matrix: a component over the root of its eigenvalue in each column."""
        return (np.array(self.components).reshape(len(self.eigenvalues), len(self.sums))
                / np.sqrt(np.array(self.eigenvalues))[:, None]).T


def components_of(spark: SparkSession, sums: Scatter, count: int) -> Whitening:
    """The ``count`` leading components (fewer where the rank is lower) of exact sums."""
    prepare(spark)
    matrix = sums.matrix
    if sums.n == 0 or sums.trace == 0:
        return Whitening(sums.n, tuple(sums.sums), (), (), ())
    roots = largest_roots(characteristic_polynomial(spark, matrix), count)
    sent = spark.sparkContext.broadcast((matrix, roots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                root, times = sent.value[1][k]
                found = null_vectors(sent.value[0], root, times)
                yield pa.RecordBatch.from_arrays([pa.array([k] * times, pa.int64()), pa.array(range(times), pa.int32()),
                                                  pa.array(found, pa.list_(pa.float64()))], names=["root", "place", "vector"])

    rows = (spark.range(0, len(roots), 1, len(roots))
            .mapInArrow(run, "root long, place int, vector array<double>").collect())  # one row per component
    rows = sorted(rows, key=lambda r: (r["root"], r["place"]))[:count]
    values = [roots[r["root"]][0] for r in rows]
    squared = Decimal(sums.n) ** 2
    return Whitening(sums.n, tuple(sums.sums), tuple(tuple(r["vector"]) for r in rows),
                     tuple(float(v / squared) for v in values), tuple(float(v / sums.trace) for v in values))


def _centred(m: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, as the quotient of exact whole numbers while those fit a long."""
    if int(np.abs(m).max(initial=0)) * n < 2 ** 62:
        return (m * n - sums.astype(np.int64)) / float(n)
    return ((m.astype(object) * n - sums) / n).astype(np.float64)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity.

    Two passes over the fit list: means, then products of the centred values;
    one row per pair of components reaches the driver each time.
    """
    spark, d, k = fit.sparkSession, len(model.sums), len(model.eigenvalues)
    if not k:
        return 0.0
    sent = spark.sparkContext.broadcast((model.projection(), np.array(model.sums, dtype=object)))

    def total(mean: np.ndarray | None) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by, sums = sent.value
            out = np.zeros(k) if mean is None else np.zeros((k, k))
            for _, m in _matrices(batches, "x", d):
                w = _centred(m, model.n, sums) @ by
                out += w.sum(axis=0) if mean is None else (w - mean).T @ (w - mean)
            yield pa.RecordBatch.from_arrays([pa.array(range(out.size), pa.int32()), pa.array(out.reshape(-1))], names=["i", "v"])

        rows = fit.select("x").mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        return np.array([r["v"] for r in sorted(rows)])

    mean = total(None) / model.n
    return float(np.abs(total(mean).reshape(k, k) / model.n - np.eye(k)).max())


def whiten(vectors: DataFrame, count: int = 16, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id",
           vector_col: str = "embedding", max_dims: int = 512) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable row and component.

    Entries become whole numbers (:func:`integer_entries`); the fit list is
    each distinct vector once. Components are numbered from 1 by falling
    eigenvalue; those with eigenvalue 0 are left out, so a table of one
    distinct vector, or none, gives no rows. Eigenvalues that agree to
    ``ROOT_BITS`` digits share one space, of which any orthonormal base is given.

    Rows whose vector is null or holds a null or non-finite entry take no part.
    Shorter vectors are padded with entries of 0.0; more than ``max_dims``
    entries raise. ``deviation`` is null where it leaves a long. Null and
    repeated ids, and equal vectors, stay rows of their own; extra columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), integer_entries(F.col(vector_col), scale, shift).alias("x"))
            .where("x is not null"))
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if dims > max_dims:
        raise ValueError(f"vectors of {dims} entries; at most {max_dims} are allowed")
    padded = F.concat("x", F.array_repeat(F.lit(shift).cast("long"), F.lit(dims) - F.size("x")))
    rows = rows.withColumn("x", padded)
    fit = write_and_reread(rows.select("x").distinct(), "fit")
    model = components_of(spark, scatter(fit, dims, shift), count)
    error = identity_error(fit, model)
    k = len(model.eigenvalues)
    sent = spark.sparkContext.broadcast((model.projection(), np.array(model.sums, dtype=object), model.explained))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, sums, explained = sent.value
        for part, m in _matrices(batches, "x", dims):
            if not k or not len(m):
                continue
            away = m * model.n - sums.astype(np.int64) if int(np.abs(m).max()) * model.n < 2 ** 62 else m.astype(object) * model.n - sums
            if int(np.abs(away).max()) ** 2 * dims >= 2 ** 63:
                away = away.astype(object)
            deviation = [v if v < 2 ** 63 else None for v in (away * away).sum(axis=1).tolist()]
            w = _centred(m, model.n, sums) @ by
            each = np.repeat(np.arange(len(m)), k)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))),
                 pa.array(np.full(len(each), model.n)), pa.array(deviation, pa.int64()).take(pa.array(each)),
                 pa.array(w.reshape(-1)), pa.array(np.tile(np.array(explained), len(m))), pa.array(np.full(len(each), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, "vec_id long, component int, n long, deviation long, whitened double, "
                                    "explained double, identity_error double")
