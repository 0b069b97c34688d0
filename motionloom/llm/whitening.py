"""Whitening by principal components from an exact characteristic polynomial.

Components are quantised to integers, so counts, sums and the scatter matrix are exact: tasks add products of narrow limbs in double
precision, where every partial sum is a whole number below 2**53, and Spark adds the tasks' results limb by limb.  The characteristic
polynomial of the integer matrix n**2 V is computed modulo as many primes below 2**31 as its coefficients need, one Hessenberg reduction a
prime, spread over tasks, and put together by the Chinese remainder theorem.

A symmetric matrix has real eigenvalues only, and for a polynomial with real roots alone the number of sign changes among the
coefficients shifted to a is exactly the number of roots beyond a, multiple roots included (Budan and Fourier).  Bisection by that count
isolates a root, then by the polynomial's sign, to ``BITS`` binary digits.  Eigenvectors come from inverse iteration on n**2 V minus the
root in ``DIGITS`` decimal digits, orthogonal to those before, which also spans the null space of a multiple root.

Cost: one distinct shuffle of the vectors, and arithmetic of the order D**3 for each prime; primes, coefficients and components depend
on the D dimensions and the logarithm of the entries alone, and only these reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Context, Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import small_batches, stored

SCALE, COMPONENTS = 256, 4
BITS, DIGITS = 192, 90
#: Bits of a limb in products, and of a limb in sums; rows whose limb products add up below 2**53.
LIMB, PIECE, PIECES, EXACT_ROWS = 20, 30, 6, 1 << 13
LARGEST_PRIME = (1 << 31) - 1


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the vectors that take part, x the entries times ``scale`` rounded down (entries beyond the range of a long end at its ends).

    Left out are vectors that are NULL, empty, of another length than most (of equally common lengths the longer counts), or that hold
    NULL or non-finite entries.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("c")).filter("c is not null and size(c) > 0")
    rows = rows.filter(F.forall("c", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c)))
    common = rows.groupBy(F.size("c").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("c") == (common["n"] if common else 0)).select("vec_id", F.transform("c", lambda c: F.floor(c * scale)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """``x`` as doubles of at most LIMB bits each, lowest first."""
    out = []
    while len(x) and max(int(x.max()), -int(x.min())) >= 1 << LIMB:
        out.append((x & ((1 << LIMB) - 1)).astype(float))
        x = x >> LIMB
    return [*out, x.astype(float)]


def _products(x: np.ndarray) -> np.ndarray:
    """Sum over rows of the products of all pairs of columns, in Python integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for first in range(0, len(x), EXACT_ROWS):
        limbs = _limbs(x[first:first + EXACT_ROWS])
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def scatter(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """Number of rows, sums and n**2 times the covariance of ``fit`` (x), all exact."""
    names = [f"p{k}" for k in range(PIECES)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                x = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)  # the column of ones gives count and sums
                total = _products(x) + (0 if total is None else total)
        if total is not None:
            i, j = np.triu_indices(len(total))
            values = [int(v) for v in total[i, j]]
            pieces = [[(v >> (PIECE * k)) & ((1 << PIECE) - 1) if k < PIECES - 1 else v >> (PIECE * k) for v in values] for k in range(PIECES)]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *(pa.array(p, pa.int64()) for p in pieces)], names=["i", "j", *names])

    schema = "i int, j int, " + ", ".join(f"{p} long" for p in names)
    rows = small_batches(fit.select("x")).mapInArrow(add, schema).groupBy("i", "j").agg(*(F.sum(p).alias(p) for p in names)).collect()
    value = {(r["i"], r["j"]): sum(r[p] << (PIECE * k) for k, p in enumerate(names)) for r in rows}
    d = max((j for _, j in value), default=0)
    n, sums = value.get((0, 0), 0), [value[0, j] for j in range(1, d + 1)]
    return n, sums, [[n * value[min(i, j) + 1, max(i, j) + 1] - sums[i] * sums[j] for j in range(d)] for i in range(d)]


# --- characteristic polynomial --------------------------------------------------------------------

def _is_prime(p: int) -> bool:
    """Miller and Rabin's test; these bases decide all numbers below 3.2 * 10**9."""
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        if base % p == 0:
            continue
        x = pow(base, odd, p)
        if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product exceeds ``bound``."""
    found, product, p = [], 1, LARGEST_PRIME
    while product <= bound:
        if _is_prime(p):
            found.append(p)
            product *= p
        p -= 2
    return found


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo ``p``, lowest first, by reduction to Hessenberg form."""
    a = (np.array(matrix, object) % p).astype(np.int64)
    d = len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not len(below):
            continue
        if (row := k + 1 + int(below[0])) != k + 1:
            a[[row, k + 1]] = a[[k + 1, row]]
            a[:, [row, k + 1]] = a[:, [k + 1, row]]
        factor = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:, k:] = (a[k + 2:, k:] - factor[:, None] * a[k + 1, k:] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * factor % p).sum(axis=1)) % p
    leading = np.zeros((d + 1, d + 1), np.int64)  # row k: polynomial of the leading k by k block
    leading[0, 0] = 1
    for k in range(1, d + 1):
        chain, weights = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):
            weights[i] = int(a[i, k - 1]) * chain % p
            chain = chain * int(a[i, i - 1]) % p
        leading[k, 1:] = leading[k - 1, :-1]
        leading[k] = (leading[k] - (weights[:, None] * leading[:k] % p).sum(axis=0)) % p
    return leading[d].tolist()


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(t - matrix), lowest first, for a positive semidefinite integer matrix."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # The k-th coefficient is a symmetric function of eigenvalues that are not negative and add up to the trace.
    primes = primes_beyond(2 * max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1)))
    sent = spark.sparkContext.broadcast(matrix)  # D * D numbers

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column("prime").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("prime"), pa.array([polynomial_modulo(sent.value, q) for q in p], pa.list_(pa.int64()))], names=["prime", "residues"])

    rows = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    residues = {r["prime"]: r["residues"] for r in rows.mapInArrow(reduce, "prime long, residues array<long>").collect()}
    sent.destroy()
    product = math.prod(primes)
    shares = {p: product // p * pow(product // p % p, -1, p) for p in primes}
    whole = [sum(residues[p][k] * shares[p] for p in primes) % product for k in range(d + 1)]
    return [c - product if 2 * c > product else c for c in whole]


# --- roots and vectors ----------------------------------------------------------------------------

def roots_beyond(polynomial: list[int], a: int) -> int:
    """How many roots exceed ``a``, multiple ones counted so often, if all roots are real."""
    c = list(polynomial)
    for i in range(len(c) - 1):
        for k in range(len(c) - 2, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def largest_roots(polynomial: list[int], k: int) -> list[tuple[int, int]]:
    """The ``k`` largest roots, those that are zero left out, falling, as (y, s): the root lies in (y - 1, y] / 2**s and y has over BITS bits."""
    d = len(polynomial) - 1
    out = []
    for number in range(1, min(k, roots_beyond(polynomial, 0)) + 1):
        scale, scaled, top = 0, polynomial, 1
        while roots_beyond(polynomial, top) >= number:
            top <<= 1
        while roots_beyond(scaled, max(top >> 1, 1)) < number:  # the root lies below: halve, or look closer
            if top > 2:
                top >>= 1
            else:
                scale, scaled = scale + 16, [c << (16 * (d - i)) for i, c in enumerate(scaled)]
                top = 2 << 16
        extra = max(0, BITS + 2 - top.bit_length())
        scaled = [c << (extra * (d - i)) for i, c in enumerate(scaled)]
        low, high = (top >> 1) << extra, top << extra
        above = roots_beyond(scaled, low), roots_beyond(scaled, high)
        while high - low > 1:
            middle = (low + high) // 2
            if above[0] - above[1] > 1:
                beyond = roots_beyond(scaled, middle)
            else:  # one simple root: the sign tells on which side it lies
                value = 0
                for c in reversed(scaled):
                    value = value * middle + c
                beyond = above[1] if value == 0 or (value > 0) == (above[1] % 2 == 0) else above[0]
            if beyond >= number:
                low, above = middle, (beyond, above[1])
            else:
                high, above = middle, (above[0], beyond)
        out.append((high, scale + extra))
    return out


def null_vectors(matrix: list[list[int]], roots: list[tuple[int, int]]) -> list[list[Decimal]]:
    """Unit eigenvectors of ``matrix`` for its ``roots``, orthogonal to each other; the entry of largest size is positive."""
    d, found = len(matrix), []
    with localcontext(Context(prec=DIGITS)):
        for number, (y, s) in enumerate(roots):
            root = (Decimal(y) - Decimal("0.5")) / Decimal(2) ** s
            rows = [[Decimal(x) - (root if i == j else 0) for j, x in enumerate(r)] for i, r in enumerate(matrix)]
            order, tiny = list(range(d)), root * Decimal(10) ** (8 - DIGITS)
            for k in range(d):
                best = max(range(k, d), key=lambda i: abs(rows[i][k]))
                rows[k], rows[best], order[k], order[best] = rows[best], rows[k], order[best], order[k]
                if abs(rows[k][k]) < tiny:
                    rows[k][k] = tiny
                pivot = rows[k]
                for i in range(k + 1, d):
                    if factor := rows[i][k] / pivot[k]:
                        row = rows[i]
                        for j in range(k + 1, d):
                            row[j] -= factor * pivot[j]
                    rows[i][k] = factor
            v = [Decimal(1 + (i * i + 7 * i * number + number) % 13) for i in range(d)]
            for _ in range(3):
                v = _unit(_apart(v, found))
                w = [v[i] for i in order]
                for i in range(d):
                    w[i] -= sum(rows[i][j] * w[j] for j in range(i))
                for i in reversed(range(d)):
                    w[i] = (w[i] - sum(rows[i][j] * w[j] for j in range(i + 1, d))) / rows[i][i]
                v = _unit(_apart(_unit(w), found))
            largest = max(v, key=abs)
            found.append([x.copy_sign(x * largest) for x in v])
    return found


def _apart(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    for o in others:
        share = sum(x * y for x, y in zip(v, o, strict=True))
        v = [x - share * y for x, y in zip(v, o, strict=True)]
    return v


def _unit(v: list[Decimal]) -> list[Decimal]:
    largest = max(map(abs, v))
    if not largest:
        return [Decimal(i == 0) for i in range(len(v))]
    v = [x / largest for x in v]
    length = sum(x * x for x in v).sqrt()
    return [x / length for x in v]


# --- whitening ------------------------------------------------------------------------------------

def _projected(rows: DataFrame, n: int, sums: list[int], turn: np.ndarray) -> DataFrame:
    """``rows`` (vec_id, x) with the exact squared deviation (NULL beyond the range of a long) and the whitened components."""
    furthest = max(map(abs, sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            reach = n * max(int(x.max()), -int(x.min())) + furthest
            whole = x.shape[1] * reach * reach < 1 << 63
            away = n * x - np.array(sums) if whole else x.astype(object) * n - np.array(sums, object)
            squared = (away * away).sum(axis=1)
            deviation = pa.array(squared if whole else [v if v < 1 << 63 else None for v in squared], pa.int64())
            white = away.astype(float) @ turn
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, pa.array(list(white), pa.list_(pa.float64()))], names=["vec_id", "deviation", "white"])

    return small_batches(rows.select("vec_id", "x")).mapInArrow(project, "vec_id long, deviation long, white array<double>")


def _largest(values: list[Column]) -> Column:
    return F.greatest(*values) if len(values) > 1 else values[0]


def whitened(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row for each vector that takes part and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Statistics are over the fit list, every distinct quantised vector once.  Components fall by eigenvalue; there are fewer than asked
    for if fewer eigenvalues differ from zero, so a table of one distinct vector, and an empty one, give no rows.  Components of equal
    eigenvalues are any orthonormal basis of their space.  Repeated rows and NULL ids are projected like any other; see ``quantised`` for
    rows that take no part.  ``deviation`` is NULL where it exceeds the range of a long.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale)
    fit = stored(rows.select("x").distinct(), "fit")
    n, sums, matrix = scatter(fit)
    roots = largest_roots(characteristic_polynomial(spark, matrix), components) if n else []
    if not roots:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    values = [(Decimal(y) - Decimal("0.5")) / Decimal(2) ** s for y, s in roots]
    turn = np.array([[float(x / value.sqrt()) for x in v] for v, value in zip(null_vectors(matrix, roots), values, strict=True)]).T
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    share = F.array(*(F.lit(float(value / trace)) for value in values))
    white = _projected(fit.select(F.lit(None).cast("long").alias("vec_id"), "x"), n, sums, turn)
    pairs = [(i, j) for i in range(len(roots)) for j in range(i + 1)]
    error = white.agg(_largest([F.abs(F.covar_pop(F.col("white")[i], F.col("white")[j]) - float(i == j)) for i, j in pairs])).first()[0]
    placed = _projected(rows, n, sums, turn).select("vec_id", "deviation", F.posexplode("white").alias("k", "whitened"))
    return placed.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                         F.element_at(share, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))
