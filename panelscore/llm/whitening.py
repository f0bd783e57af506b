"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Entries are fixed-point numbers x = floor(scale * c). Each distinct vector counts once: n vectors with sums S give the
integer scatter M = n * sum(x x') - S S', which is n^2 times the covariance. Batches add up their products in integers;
sums of all batches are added in limbs, so that nothing is rounded and nothing overflows.

The characteristic polynomial of M is found modulo as many primes as its coefficients need, each by a reduction to
Hessenberg form in a task of its own, and put together by Chinese remaindering. All its roots are real and none is
negative, so the sign changes after a shift (Descartes) count the roots above a number exactly; bisection on this count
gives the largest roots to ``BITS`` bits, repeated ones as often as they occur. A component is the null vector of M less
its root, by inverse iteration in ``DIGITS`` decimal digits, orthogonal to the components before it.

Model and matrix are bounded by the square of the dimension, whatever the number of rows; only they reach the driver.

Defined results: rows are dropped whose vector is null or empty, holds null or non-finite entries or entries of
2^62 or more after scaling, or has another dimension than most vectors (of equally frequent ones the larger). Null and repeated
ids and equal vectors are kept. There are no more components than dimensions. A deviation
of more than 38 digits is null. A component without variance has the
explained share 0 and a null whitened value, and does not count for ``identity_error``, which is 0 if no component has
variance. An empty table gives no rows. Other columns of the input are not carried.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.llm.common import stage

SCALE = 256
COMPONENTS = 4
#: Precision of the roots in bits below the leading one of the trace, and digits of the inverse iteration.
BITS, DIGITS = 96, 60
#: Limbs of exact sums.
LIMB, LIMBS = 40, 5
PRIME_BITS = 31
MOST_DIMENSIONS = 1024


@dataclass(frozen=True)
class Model:
    """``sums`` and ``n`` of the fit list; ``vectors[k]`` and ``values[k]`` in order of falling value; values of M / n^2."""
    n: int
    sums: tuple[int, ...]
    vectors: tuple[tuple[float, ...], ...]
    values: tuple[float, ...]
    explained: tuple[float, ...]


def fixed_point(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the usable rows, as integers of one dimension."""
    real = F.col(embedding).cast("array<double>")
    wide = F.lit(float(1 << 62))
    sound = F.forall(real, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < wide))
    rows = vectors.where(F.coalesce(sound, F.lit(False)) & (F.size(F.col(embedding)) > 0))
    made = rows.select(F.col(vec_id).alias("vec_id"), F.transform(real, lambda c: F.floor(c * scale)).alias("x"))
    sizes = made.groupBy(F.size("x").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return made.where(F.size("x") == (most["size"] if most else 0))


def _product(x: np.ndarray) -> np.ndarray:
    """x' x in whole numbers."""
    top = max(abs(int(x.max())), abs(int(x.min())))
    if top * top * len(x) < 1 << 53:
        real = x.astype(float)
        return (real.T @ real).astype(np.int64).astype(object)
    whole = x.astype(object)
    return whole.T @ whole


def scatter(fit: DataFrame, dimension: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, M) of the rows ``x``."""
    kind = "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension + 1, dimension + 1), object)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(-1, dimension)
                total += _product(np.hstack([np.ones((len(x), 1), np.int64), x]))
        i, j = np.triu_indices(dimension + 1)
        value, limbs = total[i, j], []
        for _ in range(LIMBS - 1):  # the lower limbs are not negative, the last one has the sign
            limbs.append(pa.array((value % (1 << LIMB)).tolist(), pa.int64()))
            value = value // (1 << LIMB)
        limbs.append(pa.array(value.tolist(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *limbs],
                                         names=["i", "j", *[f"l{k}" for k in range(LIMBS)]])

    sums = fit.select("x").mapInArrow(summed, kind).groupBy("i", "j").agg(
        *[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)])
    exact = [[0] * (dimension + 1) for _ in range(dimension + 1)]
    for row in sums.collect():  # bounded by the square of the dimension
        value = sum(row[f"l{k}"] << (LIMB * k) for k in range(LIMBS))
        exact[row["i"]][row["j"]] = exact[row["j"]][row["i"]] = value
    n, s = exact[0][0], exact[0][1:]
    return n, s, [[n * exact[i + 1][j + 1] - s[i] * s[j] for j in range(dimension)] for i in range(dimension)]


def primes(count: int, bits: int = PRIME_BITS) -> list[int]:
    """The largest primes below 2**bits."""
    def is_prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):  # enough below 3.2e9
            x = pow(base, odd, p)
            if x not in (1, p - 1):
                for _ in range(twos - 1):
                    x = x * x % p
                    if x == p - 1:
                        break
                else:
                    return False
        return True

    found, p = [], (1 << bits) - 1
    while len(found) < count:
        if is_prime(p):
            found.append(p)
        p -= 2
    return found


def characteristic_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo the prime ``p`` < 2**31, the lowest first."""
    h = np.array(matrix, np.int64) % p
    size = len(h)
    for k in range(size - 2):
        pivots = np.flatnonzero(h[k + 1:, k])
        if not len(pivots):
            continue
        at = k + 1 + pivots[0]
        if at != k + 1:
            h[[k + 1, at]] = h[[at, k + 1]]
            h[:, [k + 1, at]] = h[:, [at, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factor[:, None] * h[k + 1][None] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * factor[None] % p).sum(axis=1)) % p
    found = [np.ones(1, np.int64)]
    for k in range(size):
        poly = np.zeros(k + 2, np.int64)
        poly[1:] = found[k]
        poly[:-1] -= h[k, k] * found[k] % p
        below = 1
        for i in range(k - 1, -1, -1):
            below = below * int(h[i + 1, i]) % p
            poly[:i + 1] -= below * int(h[i, k]) % p * found[i] % p
            poly %= p
        found.append(poly % p)
    return found[size]


def characteristic(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), the lowest first; a task of Spark for each few primes."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    # a coefficient is a sum of products of roots: at most a binomial times a power of the trace
    bound = 2 * (trace + 1) ** size << size
    moduli = primes(bound.bit_length() // (PRIME_BITS - 1) + 1)

    def reduced(batches):
        import pandas as pd
        for batch in batches:
            rows = [(p, characteristic_modulo(np.array([[v % p for v in row] for row in matrix]), p).tolist())
                    for p in batch["id"].tolist()]
            yield pd.DataFrame(rows, columns=["p", "found"])

    given = spark.createDataFrame([(p,) for p in moduli], "id long")
    found = given.repartition(min(len(moduli), 16), "id").mapInPandas(reduced, "p long, found array<long>")
    whole, modulus = [0] * (size + 1), 1
    for row in sorted(found.collect()):  # one row a prime
        inverse = pow(modulus, -1, row["p"])
        whole = [w + modulus * ((f - w) * inverse % row["p"]) for w, f in zip(whole, row["found"])]
        modulus *= row["p"]
    return [w - modulus if w > modulus // 2 else w for w in whole]


def roots_above(poly: list[int], at: int) -> int:
    """Roots of a real-rooted polynomial above ``at``: the sign changes of its coefficients after a shift by ``at``."""
    shifted = list(poly)
    for i in range(len(poly) - 1):
        for j in range(len(poly) - 2, i - 1, -1):
            shifted[j] += at * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: list[int], count: int, bits: int) -> list[int]:
    """The largest roots, repeated as they occur, times 2**bits and rounded up; for roots that are not negative."""
    degree = len(poly) - 1
    scaled = [c << (bits * (degree - k)) for k, c in enumerate(poly)]
    top = max(1, -scaled[-2])  # their sum
    known: dict[int, int] = {}
    found = []
    for nth in range(1, min(count, degree) + 1):
        low, high = -1, top
        for at, above in known.items():  # what is known from the roots before
            low, high = (max(low, at), high) if above >= nth else (low, min(high, at))
        while high - low > 1:  # more than nth - 1 roots above low, not above high
            mid = (low + high) // 2
            known[mid] = roots_above(scaled, mid)
            low, high = (mid, high) if known[mid] >= nth else (low, mid)
        found.append(high)
    return found


def null_vectors(matrix: list[list[int]], roots: list[int], bits: int, digits: int) -> list[list[decimal.Decimal]]:
    """Unit vectors of ``matrix`` for ``roots`` (times 2**bits), each orthogonal to those before it."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    found: list[np.ndarray] = []
    with decimal.localcontext() as context:
        context.prec = digits + len(str(trace))
        whole = np.array([[decimal.Decimal(v) for v in row] for row in matrix])
        for root in roots:
            # off the root by less than its precision, so that the matrix stays regular
            value = (decimal.Decimal(2 * root + 1) / 2) / (decimal.Decimal(2) ** bits)
            lu, order = whole - np.diag([value] * size), list(range(size))
            for k in range(size):
                at = max(range(k, size), key=lambda r: abs(lu[r, k]))
                lu[[k, at]] = lu[[at, k]]
                order[k], order[at] = order[at], order[k]
                if not lu[k, k]:
                    lu[k, k] = decimal.Decimal(10) ** -digits
                lu[k + 1:, k] = lu[k + 1:, k] / lu[k, k]
                lu[k + 1:, k + 1:] -= lu[k + 1:, k:k + 1] * lu[k:k + 1, k + 1:]
            vector = np.array([decimal.Decimal(1 + (7 * i + 3 * len(found)) % 11) for i in range(size)])
            for _ in range(4):
                for other in found:
                    vector = vector - other * (other @ vector)
                y = vector[order]
                for k in range(size):
                    y[k] -= lu[k, :k] @ y[:k] if k else 0
                for k in range(size - 1, -1, -1):
                    y[k] = (y[k] - (lu[k, k + 1:] @ y[k + 1:] if k < size - 1 else 0)) / lu[k, k]
                for other in found:
                    y = y - other * (other @ y)
                vector = y / (y @ y).sqrt()
            found.append(vector)
    return [list(v) for v in found]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of the distinct vectors of ``fixed_point`` rows; None without rows."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    if first["d"] > MOST_DIMENSIONS:
        raise ValueError(f"more than {MOST_DIMENSIONS} dimensions")
    n, sums, matrix = scatter(rows.select("x").distinct(), first["d"])
    trace = sum(matrix[i][i] for i in range(first["d"]))
    poly = characteristic(rows.sparkSession, matrix)
    bits = max(0, BITS - trace.bit_length())
    # an integer matrix has no root as small as the last bit of BITS, but for 0
    roots = [r if r > 1 else 0 for r in largest_roots(poly, components, bits)]
    vectors = null_vectors(matrix, roots, bits, DIGITS)
    with decimal.localcontext() as context:
        context.prec = DIGITS
        exact = [decimal.Decimal(r) / decimal.Decimal(2) ** bits for r in roots]
        return Model(n, tuple(sums), tuple(tuple(map(float, v)) for v in vectors),
                     tuple(float(e / (n * n)) for e in exact),
                     tuple(float(e / trace) if trace else 0.0 for e in exact))


def transformed(rows: DataFrame, model: Model) -> DataFrame:
    """Adds ``deviation``, the sum of (n x - S)^2, and ``whitened``, an entry a component, to ``fixed_point`` rows."""
    n, dimension = model.n, len(model.sums)
    wide = max(map(abs, model.sums), default=0)
    axes = np.array(model.vectors).T
    scale = np.array([n * np.sqrt(v) if v > 0 else np.nan for v in model.values])

    def projected(x: pa.Array) -> pa.Array:
        flat = x.flatten().to_numpy().reshape(-1, dimension)
        top = max(abs(int(flat.max())), abs(int(flat.min()))) if len(flat) else 0
        kind = np.int64 if (n * top + wide) ** 2 * dimension < 1 << 63 else object
        off = flat.astype(kind) * n - np.array(model.sums, kind)
        moved = (off.astype(float) @ axes) / scale
        values = pa.array(moved.ravel(), from_pandas=True)  # not a number: null
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * axes.shape[1], pa.int32()), values)
        squares = [int(v) for v in (off * off).sum(axis=1)]
        exact = pa.array([decimal.Decimal(v) if v < 10 ** 38 else None for v in squares], pa.decimal128(38, 0))
        return pa.StructArray.from_arrays([exact, listed], names=["deviation", "whitened"])

    projected.__annotations__ = {"x": pa.Array, "return": pa.Array}
    made = F.arrow_udf(projected, "deviation decimal(38,0), whitened array<double>")
    return rows.withColumn("__made", made("x")).select("*", "__made.deviation", "__made.whitened").drop("__made")


def identity_error(rows: DataFrame, model: Model) -> float:
    """Largest entry of the covariance of the distinct rows, whitened, less the identity."""
    used = [k for k, v in enumerate(model.values) if v > 0]
    if not used:
        return 0.0
    made = transformed(rows.select("x").distinct(), model).select(*[F.col("whitened")[k].alias(f"w{k}") for k in used])

    def off(a: int, b: int) -> Column:
        return F.abs(F.covar_pop(f"w{a}", f"w{b}") - (1.0 if a == b else 0.0))

    return made.agg(F.greatest(*[off(a, b) for a in used for b in used if a <= b], F.lit(0.0), F.lit(0.0))).first()[0]


def whitened(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable row and component."""
    rows = stage(fixed_point(vectors, vec_id, embedding), "fixed-point")
    model = fit(rows, components)
    error = identity_error(rows, model) if model else 0.0
    model = model or Model(0, (), (), (), ())
    moved = transformed(rows, model) if model.n else rows.select(
        "*", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    each = moved.select("vec_id", "deviation", F.posexplode("whitened").alias("nth", "whitened"))
    share = F.element_at(F.array(*[F.lit(e) for e in model.explained]).cast("array<double>"), F.col("nth") + 1)
    return each.select("vec_id", (F.col("nth") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                       "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
