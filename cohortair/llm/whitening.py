"""Embedding whitening by spectrum slicing.

The covariance is summed exactly in Spark (integer Gram matrices per task,
added as decimals per entry), so only a d x d matrix reaches the driver. Its
leading eigenvalues are found one by one: the inertia of V - sigma*I, read off
the signs of the pivots of an LDL^T factorisation, counts the eigenvalues
below sigma; bisection on that count isolates the k-th largest in an interval,
Rayleigh quotient iteration then converges cubically to it, and a final count
certifies that the value found is the k-th one (numbering). Rows are whitened
in Spark with the components as literals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the contract: entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
EXACT = T.DecimalType(38, 0)


@dataclass(frozen=True)
class Spectrum:
    n: int
    sums: list[int]  # per-dimension sums of the shifted entries y = x - OFFSET
    values: np.ndarray  # leading eigenvalues, falling
    vectors: np.ndarray  # d x k, unit columns
    trace: float


def integer_entries(vector: Column) -> Column:
    """floor(64 * c) shifted down by the offset: y = x - 1,000,000, as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def clean(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows whose vector is there and holds only finite entries, of the most common length.

    Vectors of another length than the most common one (ties: the longest)
    cannot share a covariance with the others and are dropped as well.
    """
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    kept = df.where(F.col(vector).isNotNull() & finite)
    lengths = kept.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return kept.limit(0), 0
    return kept.where(F.size(vector) == lengths[0]["d"]), lengths[0]["d"]


def _gram_of_batches(d: int):
    """Per task: count, sums and Gram matrix of the shifted entries, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, gram = 0, [0] * d, [[0] * d for _ in range(d)]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            y = flat.reshape(batch.num_rows, d)
            big = int(np.abs(y).max()) if y.size else 0
            if big * big * batch.num_rows < 2**62:
                part_sums, part_gram = y.sum(axis=0).tolist(), (y.T @ y).tolist()
            else:  # entries too large for int64 products: Python integers
                objects = y.astype(object)
                part_sums, part_gram = objects.sum(axis=0).tolist(), (objects.T @ objects).tolist()
            count += batch.num_rows
            sums = [a + int(b) for a, b in zip(sums, part_sums, strict=True)]
            gram = [[a + int(b) for a, b in zip(ra, rb, strict=True)] for ra, rb in zip(gram, part_gram, strict=True)]
        if count:
            # Entry -1 is the count, -2 - i the sum of dimension i, then the Gram matrix, row by row.
            index = [-1, *(-2 - i for i in range(d)), *range(d * d)]
            value = [count, *sums, *(v for row in gram for v in row)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(index, pa.int64()), pa.array([str(v) for v in value], pa.string())], names=["i", "v"]
            )

    return run


def moments(fit: DataFrame, column: str, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Count, sums and Gram matrix of a table of long vectors, summed exactly in Spark."""
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("v", T.StringType())])
    parts = fit.select(column).mapInArrow(_gram_of_batches(d), schema)
    totals = {r["i"]: int(r["v"]) for r in parts.groupBy("i").agg(F.sum(F.col("v").cast(EXACT)).alias("v")).collect()}
    n = totals.get(-1, 0)
    sums = [totals.get(-2 - i, 0) for i in range(d)]
    gram = [[totals.get(i * d + j, 0) for j in range(d)] for i in range(d)]
    return n, sums, gram


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Householder reduction: diagonal and off-diagonal of a matrix orthogonally like a."""
    t = np.array(a, dtype=float)
    n = len(t)
    for k in range(n - 2):
        x = t[k + 1 :, k]
        norm = np.linalg.norm(x)
        if norm == 0.0:
            continue
        v = x.copy()
        v[0] += math.copysign(norm, x[0])
        v /= np.linalg.norm(v)
        t[k + 1 :, :] -= 2.0 * np.outer(v, v @ t[k + 1 :, :])
        t[:, k + 1 :] -= 2.0 * np.outer(t[:, k + 1 :] @ v, v)
    return np.diag(t).copy(), np.diag(t, 1).copy()


def tridiagonal_inertia(diag: np.ndarray, off: np.ndarray, sigma: float, tiny: float) -> int:
    """LDL^T pivots of a tridiagonal matrix minus sigma*I: count of negative ones."""
    negatives, pivot = 0, 1.0
    for k in range(len(diag)):
        pivot = diag[k] - sigma - (off[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        if pivot < 0:
            negatives += 1
    return negatives


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors.

    Spectrum slicing: counts of the tridiagonal form isolate the j-th largest
    value (j counted from the top) by bisection; Rayleigh quotient iteration
    from the isolating interval polishes value and vector; a count at the
    bounds of the final value certifies its number. A cluster of equal values
    that bisection cannot split gets an orthonormal basis by inverse
    iteration against the vectors found before. Each vector's largest entry
    (first among equals) is positive.
    """
    d = len(a)
    k = min(k, d)
    if k == 0:
        return np.zeros(0), np.zeros((d, 0))
    diag, off = tridiagonal(a)
    scale = max(1.0, float(np.abs(a).max(initial=0.0)))
    tiny = np.finfo(float).eps * scale
    radius = np.abs(a).sum(axis=1)
    low, high = float((np.diag(a) - radius).min()) - tiny, float((np.diag(a) + radius).max()) + tiny

    def below(sigma: float) -> int:
        return tridiagonal_inertia(diag, off, sigma, tiny)

    values, vectors = [], []
    for j in range(k):  # j-th largest: d - 1 - j values lie below it
        rank = d - 1 - j
        lo, hi = low, high
        # Bisect on the count (below(lo) <= rank < below(hi) throughout) down to rounding level,
        # which isolates the value unless it is one of several equal ones.
        for _ in range(200):
            mid = 0.5 * (lo + hi)
            if hi - lo <= 4 * np.finfo(float).eps * max(abs(lo), abs(hi), scale):
                break
            if below(mid) > rank:
                hi = mid
            else:
                lo = mid
        mu = 0.5 * (lo + hi)
        rng = np.random.default_rng(j)
        x = rng.standard_normal(d)
        basis = np.array(vectors).T if vectors else np.zeros((d, 0))
        for _ in range(50):
            x -= basis @ (basis.T @ x)
            norm = np.linalg.norm(x)
            x /= norm
            shifted = a - mu * np.eye(d)
            try:
                y = np.linalg.solve(shifted, x)
            except np.linalg.LinAlgError:
                break  # mu is an eigenvalue to machine precision
            y -= basis @ (basis.T @ y)
            new = y / np.linalg.norm(y)
            new_mu = float(new @ a @ new)
            if lo <= new_mu <= hi:
                mu = new_mu  # Rayleigh quotient step, cubic near the value
            done = np.linalg.norm(a @ new - mu * new) <= 8 * tiny * max(1.0, d)
            x = new
            if done:
                break
        x -= basis @ (basis.T @ x)
        x /= np.linalg.norm(x)
        mu = float(x @ a @ x)
        # The count certifies the number of the value found.
        margin = 64 * tiny * d
        if not below(mu - margin) <= rank < below(mu + margin):
            raise ArithmeticError(f"eigenvalue {j + 1} not certified: {mu}")
        top = int(np.argmax(np.abs(x)))
        values.append(mu)
        vectors.append(x if x[top] >= 0 else -x)
    return np.array(values), np.array(vectors).T


def spectrum(fit: DataFrame, column: str, d: int, components: int = COMPONENTS) -> Spectrum:
    """Exact moments of the fit list in Spark; the leading eigenpairs of V on the driver (d x d)."""
    n, sums, gram = moments(fit, column, d)
    if n == 0:
        return Spectrum(0, sums, np.zeros(0), np.zeros((d, 0)), 0.0)
    # n^2 V = n * Gram - S S^T, exact in integers before the one division.
    scaled = [[n * gram[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    v = np.array([[x / (n * n) for x in row] for row in scaled], dtype=float)
    values, vectors = leading_eigenpairs(v, components)
    return Spectrum(n, sums, values, vectors, sum(scaled[i][i] for i in range(d)) / (n * n))


def _projection(centred: Column, component: np.ndarray) -> Column:
    weights = F.array(*(F.lit(float(w)) for w in component))
    return F.aggregate(F.zip_with(centred, weights, lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """One row per kept row and component: whitened coordinates of the integer vectors.

    Rows with a null vector, null or non-finite entries, or another length
    than the most common one are dropped. x = floor(64c) + 1,000,000; the fit
    list is each distinct x vector once (a distinct over vectors, combined in
    each task before the shuffle, so a group of copies of any size costs one
    row). Returns key, component (from 1, falling eigenvalue), n,
    deviation (sum over dimensions of (n x - S)^2, exact, long), whitened
    ((x - S/n) . u / sqrt(e); null where e is not positive), explained
    (e / trace V; null for a zero trace) and identity_error (largest
    |entry| of whitened's covariance over the fit list minus I). An empty
    table gives no rows; extra columns are not carried.
    """
    kept, d = clean(df, vector)
    ys = kept.select(F.col(key).alias("key"), integer_entries(F.col(vector)).alias("y"))
    fit = ys.select("y").distinct()
    spec = spectrum(fit, "y", d, components)
    schema = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if spec.n == 0 or d == 0:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    n = spec.n
    means = [s / n for s in spec.sums]
    centred = F.zip_with(F.col("y"), F.array(*(F.lit(float(m)) for m in means)), lambda y, m: y.cast("double") - m)
    sums = F.array(*(F.lit(s).cast(EXACT) for s in spec.sums))
    spread = F.aggregate(
        F.zip_with(F.col("y"), sums, lambda y, s: (y.cast(EXACT) * F.lit(n).cast(EXACT) - s) * (y.cast(EXACT) * F.lit(n).cast(EXACT) - s)),
        F.lit(0).cast(EXACT),
        lambda acc, t: (acc + t).cast(EXACT),
    ).cast("long")
    count = len(spec.values)
    scores = [
        (_projection(centred, spec.vectors[:, j]) / F.lit(math.sqrt(e))) if e > 0 else F.lit(None).cast("double")
        for j, e in enumerate(spec.values)
    ]
    check = identity_error(fit, spec, means)
    per_component = F.arrays_zip(
        F.sequence(F.lit(1), F.lit(count)).alias("component"),
        F.array(*scores).alias("whitened"),
        F.array(*(F.lit(float(e / spec.trace) if spec.trace > 0 else None).cast("double") for e in spec.values)).alias("explained"),
    )
    out = ys.select(
        "key", spread.alias("deviation"), F.explode(per_component).alias("c")
    ).select(
        F.col("key").alias(key),
        F.col("c.component").cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        F.lit(check).cast("double").alias("identity_error"),
    )
    return out


def identity_error(fit: DataFrame, spec: Spectrum, means: list[float]) -> float | None:
    """Largest |entry| of the covariance of the whitened fit list minus the identity, from Spark sums."""
    usable = [j for j, e in enumerate(spec.values) if e > 0]
    if not usable:
        return None
    centred = F.zip_with(F.col("y"), F.array(*(F.lit(float(m)) for m in means)), lambda y, m: y.cast("double") - m)
    w = fit.select(F.array(*(_projection(centred, spec.vectors[:, j]) / F.lit(math.sqrt(spec.values[j])) for j in usable)).alias("w"))
    k = len(usable)
    sums = [F.sum(F.col("w")[i]).alias(f"s{i}") for i in range(k)]
    products = [F.sum(F.col("w")[i] * F.col("w")[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)]
    row = w.agg(F.count(F.lit(1)).alias("n"), *sums, *products).first()
    n = row["n"]
    worst = 0.0
    for i in range(k):
        for j in range(i, k):
            cov = row[f"p{i}_{j}"] / n - (row[f"s{i}"] / n) * (row[f"s{j}"] / n)
            worst = max(worst, abs(cov - (1.0 if i == j else 0.0)))
    return worst
