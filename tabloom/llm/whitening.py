"""Exact whitening of integer vectors by way of the characteristic polynomial.

Components become integers, y = floor(64 c); the contract's x is y plus a constant, which no centred value sees. Over
the list of distinct vectors Spark adds up n, the sums S and all products exactly, so A = n * sum(y y') - S S' is the
integer scatter matrix and the covariance is A / n^2. Its characteristic polynomial is computed modulo 31-bit primes
by reduction to Hessenberg form, one prime a row, and put together by Chinese remaindering: the coefficients are exact.
All roots of such a polynomial are real, so by Descartes' rule the sign changes after a shift count the roots beyond a
point, multiplicities included; bisection on that count isolates the largest roots and refines them to ``DIGITS``
digits. Each component then comes from the null space of A - root by inverse iteration in decimal arithmetic, one root a
row; equal roots share a row and get orthogonal vectors.

Only p x p integers (p components a vector) pass through the driver; vectors are scanned by the tasks.

Edge cases: vectors that are null or hold a null or a non-finite component take no part; shorter vectors count as
ending in zero components; components without variance cannot be scaled to one and have no rows, so a table with fewer
than two distinct vectors gives none; a null id is kept; repeated rows stay rows, while the fit counts a vector once; a
deviation beyond 63 bits is null; components beyond 2^57 are outside of what is exact. Only vec_id and embedding are
read, so extra columns cannot clash.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.blocks import summed
from tabloom.llm.common import written

COMPONENTS = 16
SCALE = 64.0
DIGITS = 45  # of a root, relative
PRECISION = 100  # of decimal arithmetic
LIMB = 40  # bits; sums of products travel as a high and a low part


# --- integers ----------------------------------------------------------------------------------


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and y = floor(64 c) for vectors that take part, all of the width of the longest."""
    wide = F.transform("embedding", lambda c: c.cast("double"))
    valid = F.col("embedding").isNotNull() & F.forall(wide, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    rows = written(
        vectors.where(F.coalesce(valid, F.lit(False))).select("vec_id", F.transform(wide, lambda c: F.floor(c * SCALE).cast("long")).alias("y")), "whitening-rows"
    )
    shortest, longest = rows.agg(F.min(F.size("y")), F.max(F.size("y"))).first()
    if shortest == longest:
        return rows
    return rows.withColumn("y", F.concat("y", F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("y"))))


def matrix_of(column: pa.Array) -> np.ndarray:
    """An array column of equally long vectors as an int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact column sums and sums of products, as Python integers."""
    most = max(abs(int(y.max())), abs(int(y.min()))) if y.size else 0
    if len(y) * most * most < 1 << 53:
        real = y.astype(np.float64)
        return y.sum(axis=0).astype(object), (real.T @ real).astype(np.int64).astype(object)
    whole = y.astype(object)
    return whole.sum(axis=0), whole.T @ whole


def moments(fit: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """n, S and the sums of products over the fit list. Tasks add up their rows, Spark adds up the tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                y = matrix_of(batch.column(0).slice(start, 4096))
                s, q = products(y)
                n, sums, squares = n + len(y), sums + s, squares + q
        i, j = np.triu_indices(width)
        values = [n, *sums, *squares[i, j]]
        high = [Decimal(int(v) >> LIMB) for v in values]
        low = [int(v) & ((1 << LIMB) - 1) for v in values]
        yield pa.record_batch(
            [pa.array(range(len(values)), pa.int64()), pa.array(high, pa.decimal128(38, 0)), pa.array(low, pa.int64())], names=["at", "high", "low"]
        )

    parts = fit.mapInArrow(partial, "at bigint, high decimal(38,0), low bigint")
    totals = parts.groupBy("at").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    value = {r["at"]: (int(r["high"]) << LIMB) + int(r["low"]) for r in totals}
    squares = np.zeros((width, width), object)
    for at, (i, j) in enumerate(zip(*np.triu_indices(width))):
        squares[i, j] = squares[j, i] = value.get(1 + width + at, 0)
    return value.get(0, 0), [value.get(1 + i, 0) for i in range(width)], squares


# --- characteristic polynomial -----------------------------------------------------------------


def is_prime(q: int) -> bool:
    """Miller's test with bases that decide every number under 3,215,031,751."""
    if q % 2 == 0:
        return q == 2
    odd, twos = q - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, q)
        if q == base or x in (1, q - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % q
            if x == q - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """31-bit primes, largest first, whose product exceeds the bound, and one more as a check."""
    found, product, q = [], 1, (1 << 31) - 1
    while product <= bound or len(found) < 2:
        if is_prime(q):
            found.append(q)
            product *= q
        q -= 2
    while not is_prime(q):
        q -= 2
    return [*found, q]


def _power(base: np.ndarray, exponent: np.ndarray, q: np.ndarray) -> np.ndarray:
    result, base, exponent = np.ones_like(base), base.copy(), exponent.copy()
    while exponent.any():
        result = np.where(exponent & 1, result * base % q, result)
        base = base * base % q
        exponent >>= 1
    return result


def polynomials(h: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Characteristic polynomial of each residue matrix h[k] modulo primes[k]: coefficients, lowest power first."""
    h, k, p = h.copy(), np.arange(len(primes)), h.shape[1]
    q = primes[:, None]
    for m in range(p - 2):
        pivot = m + 1 + (h[:, m + 1 :, m] != 0).argmax(axis=1)
        h[k, m + 1], h[k, pivot] = h[k, pivot], h[k, m + 1]
        h[k, :, m + 1], h[k, :, pivot] = h[k, :, pivot], h[k, :, m + 1]
        inverse = _power(h[:, m + 1, m], primes - 2, primes)  # zero where the column is clear already
        factor = h[:, m + 2 :, m] * inverse[:, None] % q
        h[:, m + 2 :] = (h[:, m + 2 :] - factor[:, :, None] * h[:, m + 1][:, None, :] % q[:, :, None]) % q[:, :, None]
        h[:, :, m + 1] = (h[:, :, m + 1] + (h[:, :, m + 2 :] * factor[:, None, :] % q[:, :, None]).sum(axis=2)) % q
    chain = np.zeros((p + 1, len(primes), p + 1), np.int64)
    chain[0, :, 0] = 1
    for m in range(1, p + 1):
        last = chain[m - 1]
        chain[m, :, 1:] = last[:, :-1]
        chain[m] = (chain[m] - h[:, m - 1, m - 1][:, None] * last % q) % q
        below = np.ones(len(primes), np.int64)
        for i in range(1, m):
            below = below * h[:, m - i, m - i - 1] % primes
            chain[m] = (chain[m] - (h[:, m - i - 1, m - 1] * below % primes)[:, None] * chain[m - i - 1] % q) % q
    return chain[p]


def characteristic_polynomial(spark, a: np.ndarray) -> list[int]:
    """Coefficients of det(t - a), lowest power first, for an integer matrix with no negative root.

    Their absolute values add up to the product of 1 + root, which the mean of the roots bounds.
    """
    p = len(a)
    primes = primes_beyond((2 + sum(int(a[i, i]) for i in range(p)) // p) ** p)
    shared = spark.sparkContext.broadcast([[int(v) for v in row] for row in a])

    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            chosen = batch.column(0).to_pylist()
            for start in range(0, len(chosen), 16):
                whole = np.array(shared.value, object) if whole is None else whole
                part = [primes[i] for i in chosen[start : start + 16]]
                residues = np.array([(whole % q).astype(np.int64) for q in part])
                found = polynomials(residues, np.array(part, np.int64))
                yield pa.record_batch([pa.array(part, pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["q", "c"])

    tasks = max(1, min(len(primes) // 8, 256))
    rows = spark.range(0, len(primes), 1, tasks).mapInArrow(images, "q bigint, c array<bigint>").collect()
    image = {r["q"]: r["c"] for r in rows}
    check, used = primes[-1], primes[:-1]
    product = 1
    for q in used:
        product *= q
    weights = [product // q * pow(product // q, -1, q) for q in used]
    coefficients = []
    for power in range(p + 1):
        sign = -1 if (p - power) % 2 else 1
        size = sum(w * (sign * image[q][power] % q) for w, q in zip(weights, used)) % product
        coefficients.append(sign * size)
    if any((c - image[check][i]) % check for i, c in enumerate(coefficients)):
        raise ArithmeticError("the coefficients exceed their bound")
    return coefficients


# --- roots -------------------------------------------------------------------------------------


def roots_beyond(coefficients: Sequence[int], at: int) -> int:
    """How many roots of a real-rooted polynomial exceed an integer: the sign changes of its Taylor shift."""
    c = list(coefficients)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def value_sign(coefficients: Sequence[int], at: int) -> int:
    total = 0
    for c in reversed(coefficients):
        total = total * at + c
    return (total > 0) - (total < 0)


def largest_roots(coefficients: Sequence[int], count: int) -> list[tuple[Decimal, int]]:
    """The ``count`` largest positive roots as (value, multiplicity), falling, to ``DIGITS`` relative digits.

    The last multiplicity is whole, so the multiplicities may add up to more than ``count``.
    """
    degree = len(coefficients) - 1
    zeros = next(i for i, c in enumerate(coefficients) if c)
    wanted = min(count, degree - zeros)
    need = 4 * DIGITS  # bits, more than log2(10) a digit
    scale = need
    while True:
        scaled = [c << (scale * (degree - i)) for i, c in enumerate(coefficients)]
        top = 1 << (-scaled[-2]).bit_length() if degree else 1  # no root exceeds their sum
        known = {top: 0}

        def beyond(at: int) -> int:
            if at not in known:
                known[at] = roots_beyond(scaled, at)
            return known[at]

        found, ranked = [], 0
        while ranked < wanted:
            low, high = 0, min(t for t, n in known.items() if n <= ranked)
            low = max([t for t, n in known.items() if n > ranked], default=0)
            while high - low > 1 and not (low and beyond(low) - beyond(high) == 1):
                middle = (low + high) // 2
                if beyond(middle) > ranked:
                    low = middle
                else:
                    high = middle
            share = beyond(low) - beyond(high) if low else degree - zeros - beyond(high)
            known[high] = ranked
            end = high
            if share == 1 and high - low > 1:
                left = value_sign(scaled, low)
                while high - low > 1 and (high - low) << need > low:
                    middle = (low + high) // 2
                    sign = value_sign(scaled, middle)
                    if sign == 0:
                        low = middle - 1
                        high = middle
                        break
                    if sign == left:
                        low = middle
                    else:
                        high = middle
            found.append((high, share))
            ranked += share
            known[min(end, max(low, 1))] = ranked
        if all(high >> need for high, _ in found) or scale > 64 * need:
            break
        scale *= 4
    with decimal.localcontext(prec=PRECISION):
        return [(Decimal(high) / Decimal(1 << scale), share) for high, share in found]


# --- components --------------------------------------------------------------------------------


def _factored(m: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """LU with row exchanges, in place of a copy; a vanished pivot becomes a tiny one."""
    m, order = m.copy(), list(range(len(m)))
    tiny = max(abs(v) for v in m.ravel()) * Decimal(10) ** (10 - PRECISION) or Decimal(1)
    for i in range(len(m)):
        best = max(range(i, len(m)), key=lambda r: abs(m[r, i]))
        if best != i:
            m[[i, best]] = m[[best, i]]
            order[i], order[best] = order[best], order[i]
        if abs(m[i, i]) < tiny:
            m[i, i] = tiny
        if i + 1 < len(m):
            m[i + 1 :, i] = m[i + 1 :, i] / m[i, i]
            m[i + 1 :, i + 1 :] = m[i + 1 :, i + 1 :] - np.outer(m[i + 1 :, i], m[i, i + 1 :])
    return m, order


def _solved(lu: np.ndarray, order: list[int], b: np.ndarray) -> np.ndarray:
    x = b[order]
    for i in range(1, len(x)):
        x[i] = x[i] - (lu[i, :i] * x[:i]).sum()
    for i in range(len(x) - 1, -1, -1):
        x[i] = (x[i] - (lu[i, i + 1 :] * x[i + 1 :]).sum()) / lu[i, i]
    return x


def null_vectors(a: list[list[int]], root: Decimal, many: int) -> list[list[float]]:
    """``many`` orthonormal vectors of a root, each with its largest component positive."""
    with decimal.localcontext(prec=PRECISION):
        exact = np.array([[Decimal(v) for v in row] for row in a], object)
        shifted = exact.copy()
        for i in range(len(a)):
            shifted[i, i] = shifted[i, i] - root
        lu, order = _factored(shifted)
        found: list[np.ndarray] = []
        for start in range(many):
            # a fixed start without structure; what earlier vectors cover is taken out after every step
            z = np.array([Decimal(((i + 1) * 7919 + start * 104729) * 2654435761 % 4294967291 + 1) for i in range(len(a))], object)
            for _ in range(3):
                z = _solved(lu, order, z)
                for _ in range(2):
                    for f in found:
                        z = z - f * (f * z).sum()
                    z = z / (z * z).sum().sqrt()
            found.append(z)
        return [[float(v) for v in (f if f[np.abs(f.astype(float)).argmax()] > 0 else -f)] for f in found]


def components(spark, a: np.ndarray, roots: Sequence[tuple[Decimal, int]]) -> np.ndarray:
    """One row a component, in the order of the roots; every root is a task's work."""
    shared = spark.sparkContext.broadcast([[int(v) for v in row] for row in a])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                found = null_vectors(shared.value, *roots[i])
                yield pa.record_batch([pa.array([i], pa.int64()), pa.array([found], pa.list_(pa.list_(pa.float64())))], names=["i", "u"])

    rows = spark.range(0, len(roots), 1, len(roots)).mapInArrow(solve, "i bigint, u array<array<double>>").collect()
    return np.array([u for r in sorted(rows, key=lambda r: r["i"]) for u in r["u"]])


# --- whitening ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: distinct vectors, sums, roots of the scatter matrix, components, shares, worst error."""

    n: int
    sums: list[int]
    roots: list[float]
    components: np.ndarray
    explained: list[float]
    identity_error: float

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * y - S, exactly."""
        most = max(abs(int(y.max())), abs(int(y.min()))) if y.size else 0
        if self.n * most + max(map(abs, self.sums)) < 1 << 62:
            return y * self.n - np.array(self.sums, np.int64)
        return y.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return self.centred(y).astype(np.float64) @ self.components.T / np.sqrt(self.roots)


def fitted(rows: DataFrame, limit: int = COMPONENTS) -> Whitening | None:
    """The transform of a table with integer vectors ``y``, or None where no component has variance."""
    spark = rows.sparkSession
    fit = written(rows.select("y").distinct(), "whitening-fit")
    first = fit.first()
    if first is None or not first["y"]:
        return None
    width = len(first["y"])
    n, sums, squares = moments(fit, width)
    a = n * squares - np.outer(np.array(sums, object), np.array(sums, object))
    trace = sum(int(a[i, i]) for i in range(width))
    if trace == 0:
        return None
    roots = largest_roots(characteristic_polynomial(spark, a), limit)
    vectors = components(spark, a, roots)[:limit]
    listed = [r for r, many in roots for _ in range(many)][:limit]
    made = Whitening(n, sums, [float(r) for r in listed], vectors, [float(r / trace) for r in listed], 0.0)

    def add_mean(total: np.ndarray, batch: pa.RecordBatch) -> None:
        total += made.whitened(matrix_of(batch.column(0))).sum(axis=0)

    mean = summed(fit, add_mean, len(listed)) / n

    def add_products(total: np.ndarray, batch: pa.RecordBatch) -> None:
        off = made.whitened(matrix_of(batch.column(0))) - mean
        total += (off.T @ off).ravel()

    covariance = summed(fit, add_products, len(listed) ** 2).reshape(len(listed), -1) / n
    return Whitening(n, sums, made.roots, vectors, made.explained, float(np.abs(covariance - np.eye(len(listed))).max()))


def whiten(vectors: DataFrame, limit: int = COMPONENTS) -> DataFrame:
    """The contract's columns, one row for each vector and component."""
    rows = integers(vectors)
    made = fitted(rows, limit)
    id_type = dict(rows.dtypes)["vec_id"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if made is None or not batch.num_rows:
                continue
            y = matrix_of(batch.column(1))
            off = made.centred(y)
            if off.dtype != object and off.shape[1] * int(np.abs(off).max()) ** 2 >= 1 << 63:
                off = off.astype(object)
            deviation = [int(v) if v < 1 << 63 else None for v in (off * off).sum(axis=1)]
            w = made.whitened(y)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), pa.array(np.ascontiguousarray(w).ravel()))
            yield pa.record_batch([batch.column(0), pa.array(deviation, pa.int64()), flat], names=["vec_id", "deviation", "w"])

    found = rows.mapInArrow(apply, f"vec_id {id_type}, deviation bigint, w array<double>")
    long = found.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    shares = F.array(*[F.lit(e) for e in (made.explained if made else [0.0])])
    return long.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(made.n if made else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(made.identity_error if made else 0.0).alias("identity_error"),
    )
