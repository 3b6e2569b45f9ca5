"""Operator 12, embedding whitening: pivoted Cholesky, then one-sided Jacobi.

Vectors are whole numbers x = ``floor(scale * c)``. The fit list holds each
distinct x once (a Spark ``distinct``, so a vector that a third of the rows
share counts once). Its size n and sums S are exact; a second job subtracts the
rounded mean from every vector and adds up the products, in whole numbers too,
so the centred scatter does not depend on the order or the number of tasks. What
the rounding of the mean leaves is taken off exactly, and the covariance V is
the nearest doubles.

V (as large as the dimension squared, whatever the rows) is then factored on the
driver: Cholesky with diagonal pivoting, ``P'VP = LL'``, and rotations of pairs
of L's columns until all are orthogonal. The squared norms of the rotated
columns are V's eigenvalues, the normalised columns its eigenvectors. Pivoting
gives a factor with graded columns, on which the rotations converge in a few
sweeps and keep the small eigenvalues' digits; V itself is never rotated. Each
component's sign makes its largest entry positive.

Rows are whitened in one more pass: ``(x - S/n)`` projected on each component,
over the root of its eigenvalue. The covariance of the whitened fit list is
summed by Spark and compared with the identity.

Defined results: rows whose vector is null or holds a null or non-finite entry
are dropped; null and repeated ids and repeated vectors give a row each. Shorter
vectors count as ending in zeros. Components whose eigenvalue is 0 (fewer
distinct vectors or dimensions than components) can't be whitened and give no
row, so a table with one distinct vector, or an empty one, gives none.
``deviation`` is a decimal of 38 digits, null where even that cannot hold it;
entries beyond the long range are its ends. Extra columns are ignored.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import cut, table
from strata.llm.vectors import largest, matrix, usable, whole

COMPONENTS = 4
SWEEPS = 60
_HALF = 1 << 20  # exact sums of products are taken in two halves of S


def _decimals(values) -> pa.Array:
    return pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def column_sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each of their entries."""

    def sums(batches):
        total, n = [0] * width, 0
        for batch in batches:
            x = matrix(batch["x"], width)
            if len(x) * largest(x) >= 1 << 63:
                x = x.astype(object)
            total = [t + int(s) for t, s in zip(total, x.sum(axis=0), strict=True)]
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, width), pa.int64()), _decimals([n, *total])], names=["i", "v"])

    got = fit.mapInArrow(sums, "i long, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    by = {r["i"]: int(r["v"]) for r in got}  # one row for each dimension
    return by.get(-1, 0), [by.get(i, 0) for i in range(width)]


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance of the fit list (divisor n), centred before multiplying, to the nearest doubles."""
    width = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]  # the rounded mean
    upper = np.triu_indices(width)

    def products(batches):
        total = np.zeros(len(upper[0]), object)
        for batch in batches:
            x = matrix(batch["x"], width)
            big = largest(x) + max(map(abs, centre), default=0)
            y = x - np.array(centre, np.int64) if big < 1 << 62 else x.astype(object) - np.array(centre, object)
            if len(y) * big * big < 1 << 53:
                y = y.astype(np.float64)  # sums of whole numbers below 2**53 are exact
                part = (y.T @ y)[upper].astype(np.int64)
            else:
                y = y.astype(object)
                part = (y.T @ y)[upper]
            total = total + part.astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int64()), _decimals(total)], names=["i", "v"])

    got = fit.mapInArrow(products, "i long, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    by = {r["i"]: int(r["v"]) for r in got}  # as many rows as the upper triangle has
    left = [s - n * c for s, c in zip(sums, centre, strict=True)]
    out = np.zeros((width, width))
    for k, (i, j) in enumerate(zip(*(u.tolist() for u in upper), strict=True)):
        out[i, j] = out[j, i] = (n * by[k] - left[i] * left[j]) / (n * n)
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order) with ``a[order][:, order] = L L'``; as many columns as the rank."""
    a, d = a.copy(), len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    least = np.finfo(float).eps * d * a.diagonal().max(initial=0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= least:
            return factor[:, :k], order
        for m in (a, factor):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated in pairs until they are orthogonal.

    A sweep pairs every two columns once, in rounds of disjoint pairs (the
    schedule of a round-robin tournament), which are rotated together.
    """
    g, r = factor.copy(), factor.shape[1]
    seats = list(range(r + r % 2))  # an odd number plays with a bye
    tolerance = np.finfo(float).eps * max(1, np.sqrt(len(g)))
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(max(len(seats) - 1, 0)):
            half = len(seats) // 2
            pairs = [(p, q) for p, q in zip(seats[:half], seats[:half - 1:-1], strict=True) if p < r and q < r]
            if pairs:
                p, q = np.array(pairs).T
                a, b = g[:, p], g[:, q]
                alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
                skew = np.abs(gamma) / np.sqrt(np.maximum(alpha * beta, 1e-300))
                worst = max(worst, skew.max())
                turn = skew > tolerance
                zeta = (beta - alpha) / np.where(turn, 2 * gamma, 1)
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
                c = np.where(turn, 1 / np.sqrt(1 + t * t), 1.0)
                s = np.where(turn, c * t, 0.0)
                g[:, p], g[:, q] = c * a - s * b, s * a + c * b
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst <= tolerance:
            break
    return g


def principal_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(the ``k`` largest eigenvalues of a covariance, unit eigenvectors as columns); fewer at a lower rank."""
    factor, order = pivoted_cholesky(v)
    turned = one_sided_jacobi(factor)
    values = (turned * turned).sum(axis=0)
    top = np.argsort(-values, kind="stable")[:k]
    vectors = np.zeros((len(v), len(top)))
    vectors[order] = turned[:, top] / np.sqrt(values[top])
    peak = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(top))] if len(top) else np.zeros(0)
    return values[top], vectors * np.where(peak < 0, -1.0, 1.0)


def _identity_error(fit: DataFrame, width: int, mean: np.ndarray, map_: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = map_.shape[1]

    def moments(batches):
        n, one, two = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = (matrix(batch["x"], width) - mean) @ map_
            n, one, two = n + len(w), one + w.sum(axis=0), two + w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(1 + k + k * k), pa.int64()), pa.array(np.concatenate([[n], one, two.ravel()]))],
            names=["i", "v"])

    got = fit.mapInArrow(moments, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    v = np.array([r["v"] for r in sorted(got, key=lambda r: r["i"])])
    one, two = v[1:1 + k] / v[0], v[1 + k:].reshape(k, k) / v[0]
    return float(np.abs(two - np.outer(one, one) - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = 256, vec: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable row.

    One row for each component from 1, the largest eigenvalue first.
    ``deviation`` is the sum over dimensions of ``(n x - S)**2``.
    """
    spark = rows.sparkSession
    schema = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    kept = rows.filter(usable(F.col(vector))).select(
        F.col(vec).cast("long").alias("vec_id"), whole(F.col(vector), scale).alias("x"))
    width = kept.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], schema)
    # equal once padded is equal: the shorter ones end in zeros
    padded = F.when(F.size("x") == width, F.col("x")).otherwise(
        F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x"))))
    fit = cut(kept.select(padded.alias("x")).distinct(), "fit-list")
    n, sums = column_sums(fit, width)
    v = covariance(fit, n, sums)
    values, vectors = principal_components(v, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    mean, map_ = np.array([s / n for s in sums]), vectors / np.sqrt(values)
    explained, error = values / np.trace(v), _identity_error(fit, width, mean, map_)
    square = sum(s * s for s in sums)

    def rows_of(batches):
        for batch in batches:
            x = matrix(batch["x"], width)
            w = (x - mean) @ map_
            halves = [[s >> 20 for s in sums], [s & (_HALF - 1) for s in sums]]
            small = width * largest(x) * max(largest(x), _HALF, *map(abs, halves[0])) < 1 << 63
            y = x if small else x.astype(object)
            high, low = (y @ np.array(h, np.int64 if small else object) for h in halves)
            own = (y * y).sum(axis=1)
            deviation = [n * n * int(a) - 2 * n * ((int(b) << 20) + int(c)) + square
                         for a, b, c in zip(own, high, low, strict=True)]
            held = [decimal.Decimal(d) if d < 10 ** 38 else None for d in deviation]
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                pa.array(batch["vec_id"]).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                pa.array([d for d in held for _ in range(k)], pa.decimal128(38, 0)),
                pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(rows_of, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened components of every usable row of ``embeddings``.

    ``deviation`` is a long; it grows with the square of n and is null where a
    long cannot hold it (from some 10**7 rows on), where the operator's decimal can.
    """
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
