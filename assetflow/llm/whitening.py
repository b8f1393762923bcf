"""Whitened components of integer vectors, from the exact characteristic polynomial of their scatter.

Each vector component c becomes x = floor(256 c). The fit list holds each distinct x vector once: n of them, with
sums S. Its scatter A = n * sum(x x') - S S' = sum((n x - S)(n x - S)') / n is a matrix of whole numbers, A = n^2 V
for the covariance V, and is kept exactly.

1. Tasks turn vectors into integers; distinct ones are found by a shuffle of their bytes.
2. Tasks add up S and the products of x minus a whole-number centre, exactly; A follows from the sums.
3. Tasks work out det(t I - A) modulo primes below 2^31, many primes at once: similarity steps to Hessenberg form,
   then its recurrence. Enough primes that the coefficients, bounded by the trace, follow by Chinese remaindering.
4. All roots are real, so after a shift t -> t + a the sign changes of the coefficients count the roots above a,
   repeated ones as often as they occur. Bisecting on that isolates the largest roots to ``DIGITS`` digits.
5. Inverse iteration in decimal arithmetic of as many digits again finds a null vector of A - root I for each
   root, kept at right angles to the ones before it, so a repeated root gets that many directions.

What the driver holds are matrices of the vectors' width, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Context, Decimal, localcontext
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_for, is_finite_vector, stored, table

SCALE = 256
COMPONENTS = 4
#: Significant digits of the isolated roots.
DIGITS = 40
#: Integers beyond this size take no part: the sums of products are kept in 64 bits a task.
LARGEST = 1 << 30
#: Vectors in a task's partial sums, about.
_SLICE = 1 << 14


class Fit(NamedTuple):
    n: int  # vectors in the fit list
    sums: list[int]  # S
    roots: list[Decimal]  # largest eigenvalues of A, falling
    vectors: np.ndarray  # unit eigenvectors in rows
    trace: int  # of A


def integers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and the packed integers (32 bits each, little-endian) of the vectors that take part.

    Those are the finite ones of the commonest length (of the longest of these) whose integers fit.
    """
    good = vectors.select(F.col(key).alias("__key"), F.col(vector).alias("__v")).where(is_finite_vector("__v"))
    width = good.groupBy(F.size("__v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).limit(1).collect()
    if not width:
        return good.select("__key", F.lit(b"").alias("__x"))
    kind = good.schema["__key"].dataType.simpleString()

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.floor(SCALE * np.asarray(b.column("__v").flatten().cast(pa.float64())).reshape(b.num_rows, -1))
                fits = (np.abs(x) < LARGEST).all(axis=1)
                raw = np.ascontiguousarray(x[fits].astype("<i4"))
                keys = b.column("__key").filter(pa.array(fits))
                yield pa.RecordBatch.from_arrays([keys, pa.array([r.tobytes() for r in raw], pa.binary())], ["__key", "__x"])

    return good.where(F.size("__v") == width[0]["w"]).mapInArrow(turn, f"__key {kind}, __x binary")


def _rows(col: pa.Array) -> np.ndarray:
    """Packed integers as rows of int64."""
    b = b"".join(col.to_pylist())
    return np.frombuffer(b, "<i4").reshape(len(col), -1).astype(np.int64)


def products(y: np.ndarray) -> np.ndarray:
    """y'y of at most 2^14 rows of integers below 2^32, as Python integers; exact in doubles by halves of 16 bits."""
    high, low = y >> 16, y & 0xFFFF
    mult = lambda a, b: (a.T.astype(float) @ b.astype(float)).astype(np.int64).astype(object)
    out = mult(low, low)
    if high.any():
        cross = mult(high, low)
        out = out + ((cross + cross.T) << 16) + (mult(high, high) << 32)
    return out


def scatter(fit_list: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, S and A of the packed vectors ``__x``, exactly."""
    first = fit_list.select("__x").limit(1).collect()
    if not first:
        return 0, [], []
    d = len(first[0]["__x"]) // 4
    totals = lambda df: df.groupBy("at").agg(F.sum("value").alias("value"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, np.int64), 0
        for b in batches:
            if b.num_rows:
                total, n = total + _rows(b.column("__x")).sum(axis=0), n + b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array([*total.tolist(), n], pa.int64())], ["at", "value"])

    got = {r["at"]: int(r["value"]) for r in totals(fit_list.select("__x").mapInArrow(sums, "at long, value long")
                                                   .select("at", F.col("value").cast("decimal(38,0)").alias("value"))).collect()}
    n, s = got[d], [got[i] for i in range(d)]
    centre = np.array([(2 * x + n) // (2 * n) for x in s], np.int64)  # nearest whole number to S / n
    upper = np.triu_indices(d)

    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(upper[0]), object)
        for b in batches:
            for a in range(0, b.num_rows, _SLICE):
                total = total + products(_rows(b.column("__x").slice(a, _SLICE)) - centre)[upper]
        # 38 decimal digits in two whole numbers of 60 bits and more
        low = [int(v) & ((1 << 60) - 1) for v in total]
        high = [int(v) >> 60 for v in total]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["at", "low", "high"])

    parts = (fit_list.select("__x").mapInArrow(square, "at long, low long, high long").groupBy("at")
             .agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")]).collect())
    flat = {r["at"]: int(r["low"]) + (int(r["high"]) << 60) for r in parts}
    off = [x - n * int(c) for x, c in zip(s, centre, strict=True)]  # sums about the centre
    a = [[0] * d for _ in range(d)]
    for k, (i, j) in enumerate(zip(*upper, strict=True)):
        a[i][j] = a[j][i] = n * flat[k] - off[i] * off[j]
    return n, s, a


def primes_below(top: int, count: int) -> list[int]:
    """The ``count`` largest primes below ``top``."""
    small = np.ones(math.isqrt(top) + 1, bool)
    small[:2] = False
    for p in range(2, math.isqrt(len(small)) + 1):
        if small[p]:
            small[p * p::p] = False
    small = np.flatnonzero(small)
    found: list[int] = []
    high = top
    while len(found) < count:
        low = max(2, high - (1 << 16))
        block = np.ones(high - low, bool)
        for p in small:
            first = max(p * p, -(-low // p) * p)
            block[first - low::p] = False
        found += [int(x) + low for x in np.flatnonzero(block)[::-1]]
        high = low
    return found[:count]


def _powers(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inverses of x modulo the primes p, by x^(p-2)."""
    out, e, base = np.ones_like(x), p - 2, x.copy()
    while e.any():
        out = np.where(e & 1, out * base % p, out)
        base, e = base * base % p, e >> 1
    return out


def characteristic(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients (from the constant up) of det(t I - a[k]) modulo p[k], for matrices stacked in ``a``.

    Each column below the subdiagonal is cleared by a row operation and the column operation that undoes it,
    after a swap of rows and columns brings a pivot up; then the polynomials of the leading blocks follow one
    from another.
    """
    k, d, _ = a.shape
    h, m, at = a.copy(), p[:, None], np.arange(k)
    for j in range(d - 2):
        below = h[:, j + 1:, j] != 0
        pivot = j + 1 + below.argmax(axis=1)  # the first row with an entry; itself if there is none
        rows = h[at, pivot].copy()
        h[at, pivot], h[:, j + 1] = h[:, j + 1].copy(), rows
        cols = h[at, :, pivot].copy()
        h[at, :, pivot], h[:, :, j + 1] = h[:, :, j + 1].copy(), cols
        inverse = _powers(h[:, j + 1, j], p)
        for i in range(j + 2, d):
            f = h[:, i, j] * inverse % p
            if f.any():
                f = f[:, None]
                h[:, i] = (h[:, i] - f * h[:, j + 1]) % m
                h[:, :, j + 1] = (h[:, :, j + 1] + f * h[:, :, i]) % m
    poly = [np.zeros((k, d + 1), np.int64)]
    poly[0][:, 0] = 1
    for j in range(d):
        q = np.zeros((k, d + 1), np.int64)
        q[:, 1:] = poly[j][:, :-1]
        q = (q - h[:, j, j, None] * poly[j]) % m
        run = np.ones(k, np.int64)
        for i in range(j - 1, -1, -1):
            run = run * h[:, i + 1, i] % p
            if not run.any():
                break
            q = (q - (run * h[:, i, j] % p)[:, None] * poly[i]) % m
        poly.append(q)
    return poly[d]


def polynomial(spark, a: list[list[int]]) -> list[int]:
    """Coefficients of det(t I - A), from the constant up, exactly: remainders by primes in tasks, then combined."""
    d = len(a)
    trace = sum(a[i][i] for i in range(d))
    # |e_k| <= C(d, k) (trace / d)^k for roots that are not negative
    most = max(math.comb(d, k) * (trace ** k) // d ** k + 1 for k in range(d + 1))
    primes = primes_below(1 << 31, (2 * most + 1).bit_length() // 30 + 1)
    held = spark.sparkContext.broadcast(a)

    def remainders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = np.array(held.value, object)
        for b in batches:
            p = np.asarray(b.column("p"))
            for i in range(0, len(p), 64):
                q = p[i:i + 64]
                got = characteristic(np.stack([(matrix % int(x)).astype(np.int64) for x in q]), q)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(got.tolist(), pa.list_(pa.int64()))], ["p", "c"])

    asked = spark.createDataFrame([(x,) for x in primes], "p long").repartition(groups_for(len(primes), 16))
    value, modulus = [0] * (d + 1), 1
    for r in asked.mapInArrow(remainders, "p long, c array<long>").collect():
        p, lift = r["p"], pow(modulus, -1, r["p"])
        value = [v + modulus * ((c - v) * lift % p) for v, c in zip(value, r["c"], strict=True)]
        modulus *= p
    held.unpersist()
    return [v - modulus if 2 * v > modulus else v for v in value]


def above(poly: list[int], num: int, shift: int) -> int:
    """How many roots of a polynomial with real roots only lie above num / 2^shift, repeated ones counted."""
    d = len(poly) - 1
    c = [x << shift * (d - i) for i, x in enumerate(poly)]  # roots times 2^shift
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += num * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def largest_roots(poly: list[int], count: int, top: int, digits: int = DIGITS) -> list[Decimal]:
    """The ``count`` largest positive roots (all, if fewer), falling; none is above ``top``."""
    bits = math.ceil(digits * math.log2(10))
    out: list[Decimal] = []
    known: list[tuple[int, int, int]] = []  # counts met before: numerator, shift, roots above
    for k in range(1, min(count, above(poly, 0, 0)) + 1):
        low, high, shift = 0, top + 1, 0  # at least k roots above low, fewer above high
        for num, s, n in known:
            up = max(shift, s)
            a, b, x = low << up - shift, high << up - shift, num << up - s
            if a < x < b:
                low, high, shift = (x, b, up) if n >= k else (a, x, up)
        while (high - low).bit_length() + bits > high.bit_length():
            if high - low <= 1:
                low, high, shift = 2 * low, 2 * high, shift + 1
            mid = (low + high) // 2
            n = above(poly, mid, shift)
            known.append((mid, shift, n))
            low, high = (mid, high) if n >= k else (low, mid)
        with localcontext(Context(prec=2 * digits)):
            out.append(Decimal(low + high) / Decimal(2 << shift))
    return out


def null_vectors(a: list[list[int]], roots: list[Decimal], digits: int = DIGITS) -> np.ndarray:
    """Unit vectors v with A v = root v, in rows, at right angles to each other; the largest entry is positive."""
    d = len(a)
    found: list[list[Decimal]] = []
    with localcontext(Context(prec=2 * digits)):
        dot = lambda x, y: sum((p * q for p, q in zip(x, y, strict=True)), Decimal(0))
        tiny = Decimal(10) ** (-2 * digits) * max(roots, default=Decimal(1))

        def proper(v: list[Decimal]) -> list[Decimal]:
            for _ in range(2):
                for u in found:
                    f = dot(u, v)
                    v = [x - f * y for x, y in zip(v, u, strict=True)]
            norm = dot(v, v).sqrt()
            return [x / norm for x in v]

        for k, root in enumerate(roots):
            m = [[Decimal(x) for x in row] for row in a]
            for i in range(d):
                m[i][i] -= root
            order = list(range(d))
            for j in range(d):
                best = max(range(j, d), key=lambda i: abs(m[i][j]))  # noqa: B023
                m[j], m[best], order[j], order[best] = m[best], m[j], order[best], order[j]
                if abs(m[j][j]) < tiny:
                    m[j][j] = tiny
                top = m[j]
                for i in range(j + 1, d):
                    if m[i][j]:
                        f = m[i][j] / top[j]
                        m[i] = m[i][:j] + [f] + [x - f * y for x, y in zip(m[i][j + 1:], top[j + 1:], strict=True)]
            # a start no eigenvector is likely to be at right angles to
            v = proper([Decimal((i * 7919 + k * 104729) % 1009 + 1) for i in range(d)])
            for _ in range(4):
                y = [v[i] for i in order]
                for i in range(d):
                    y[i] -= dot(m[i][:i], y[:i])
                for i in range(d - 1, -1, -1):
                    y[i] = (y[i] - dot(m[i][i + 1:], y[i + 1:])) / m[i][i]
                v = proper(y)
            big = max(v, key=abs)
            found.append([-x for x in v] if big < 0 else v)
    return np.array([[float(x) for x in v] for v in found]).reshape(len(found), d)


def fit(spark, fit_list: DataFrame, components: int = COMPONENTS) -> Fit:
    n, sums, a = scatter(fit_list)
    trace = sum(a[i][i] for i in range(len(a)))
    if not trace:
        return Fit(n, sums, [], np.zeros((0, len(a))), 0)
    # without the common divisor the numbers are as small as they can be; the roots scale back
    g = math.gcd(*[x for row in a for x in row])
    small = [[x // g for x in row] for row in a]
    roots = largest_roots(polynomial(spark, small), components, trace // g)
    return Fit(n, sums, [r * g for r in roots], null_vectors(small, roots), trace)


def _whitened(x: np.ndarray, f: Fit) -> np.ndarray:
    scale = np.array([float(f.n * f.n / r) for r in f.roots]) ** 0.5
    return (x - np.array([s / f.n for s in f.sums])) @ f.vectors.T * scale


def identity_error(fit_list: DataFrame, f: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity.

    Each slice gives its count, means and products about them; slices are joined by the usual update.
    """
    held = fit_list.sparkSession.sparkContext.broadcast(f)
    k = len(f.roots)

    def moments(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
        n, mean, m2 = 0, np.zeros(k), np.zeros((k, k))
        for c, u, p in parts:
            delta = u - mean
            m2 = m2 + p + np.outer(delta, delta) * (n * c / (n + c))
            mean, n = mean + delta * (c / (n + c)), n + c
        return n, mean, m2

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for b in batches:
            if b.num_rows:
                w = _whitened(_rows(b.column("__x")), held.value)
                u = w.mean(axis=0)
                yield len(w), u, (w - u).T @ (w - u)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, m2 = moments(slices(batches))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 16], pa.int32()), pa.array([n]), pa.array([mean.tolist()]), pa.array([m2.reshape(-1).tolist()])], _PARTS)

    def joined(t: pa.Table) -> pa.Table:
        n, mean, m2 = moments((c, np.array(u), np.array(p).reshape(k, k)) for c, u, p in zip(*(t.column(x).to_pylist() for x in _PARTS[1:]), strict=True))
        return pa.table({"part": pa.array([0], pa.int32()), "n": [n], "mean": [mean.tolist()], "m2": [m2.reshape(-1).tolist()]})

    kind = "part int, n long, mean array<double>, m2 array<double>"
    rows = fit_list.select("__x").mapInArrow(task, kind).groupBy("part").applyInArrow(joined, kind).collect()
    n, _, m2 = moments((r["n"], np.array(r["mean"]), np.array(r["m2"]).reshape(k, k)) for r in rows)
    return float(np.abs(m2 / n - np.eye(k)).max())


_PARTS = ["part", "n", "mean", "m2"]
_OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row and component: ``key``, component, n, deviation, whitened, explained, identity_error.

    Null vectors, those with null or non-finite entries, empty ones, those not of the commonest length and those
    with an entry of 2^22 or more take no part. Repeated rows count once in the fit and are all returned, a null
    key as any other. There are at most as many components as the scatter has positive roots: none if all
    vectors are equal. Of a repeated root any directions at right angles serve. A deviation beyond 64 bits is
    null. Other columns play no part, whatever their names.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    rows = stored(integers(vectors, key, vector), "whitening-rows")
    fit_list = stored(rows.select("__x").distinct(), "whitening-fit")
    f = fit(spark, fit_list, components)
    if not f.roots:
        return spark.createDataFrame([], f"__key {kind}, {_OUT}").withColumnRenamed("__key", key)
    error = identity_error(fit_list, f)
    explained = [float(r / f.trace) for r in f.roots]
    held = spark.sparkContext.broadcast(f)
    k = len(f.roots)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = held.value
        fits = 4 * f.n * LARGEST < 1 << 62 and max(abs(s) for s in f.sums) < 1 << 62
        s = np.array(f.sums, np.int64 if fits else object)
        for b in batches:
            x = _rows(b.column("__x"))
            if not len(x):
                continue
            d = f.n * (x if fits else x.astype(object)) - s
            if fits and float(np.abs(d).max()) ** 2 * d.shape[1] < 2.0 ** 62:
                deviation = (d * d).sum(axis=1).tolist()
            else:
                d = d.astype(object)
                deviation = [v if v < 1 << 63 else None for v in (d * d).sum(axis=1)]
            rep = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                b.column("__key").take(pa.array(rep)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(rep), f.n)),
                pa.array([deviation[i] for i in rep], pa.int64()), pa.array(_whitened(x, f).reshape(-1)),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rep), error))],
                ["__key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, f"__key {kind}, {_OUT}").withColumnRenamed("__key", key)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: all embeddings on the first four whitened components."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
