"""Embedding whitening: principal components from a pivoted Cholesky factor and one-sided Jacobi rotations.

Components become integers x = floor(64 * c) + 1000000. Spark adds up, exactly and in two passes, the sums of each dimension
and the products of components that are centred on whole numbers next to their means; the remainder is corrected exactly,
so the scatter is an integer matrix without rounding, whatever the order of tasks. It has dimension^2 entries, and
they alone reach the driver. There its covariance V is factored, P'VP = L L', taking the largest remaining diagonal entry each time and
ending at the rank. Jacobi rotations of the columns of L, without ever forming a product, make them orthogonal: their norms squared
are the eigenvalues of V, and the columns divided by their norms its eigenvectors. Two more passes write the whitened vectors and
measure their covariance.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped, as are vectors not of the commonest
dimension. Components without variance (beyond the rank, relative to rounding) can't be whitened and give no rows, so one row, or
equal rows alone, give none. Repeated rows all count; null ids stay null. Components must lie within +-2^40
(else an error). A deviation beyond 64 bits is null in `whitened`, and whole in `whiten`. Of equal eigenvalues, which component comes first is
settled by the factor's order. An empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import finite_vectors, scaled

SCALE, OFFSET, MOST = 64, 1_000_000, 1 << 46
COMPONENTS = 32
#: Rows of a product of matrices.
TOGETHER = 4096
EXACT = "decimal(38,0)"


class Fit(NamedTuple):
    """n rows; shift, a whole number near each mean of x; rest, the sums of x - shift; eigenvalues, falling; components, a column each; trace of V."""

    n: int
    shift: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """order and L, with a[order][:, order] = L L', of a positive semidefinite matrix; L has as many columns as the rank, and is lower triangular."""
    rest, n = np.array(a, np.float64), len(a)
    order, columns = np.arange(n), np.zeros((n, n))
    least = n * np.finfo(float).eps * max(rest.diagonal().max(initial=0), 0)
    for k in range(n):
        j = k + int(rest.diagonal()[k:].argmax())
        if rest[j, j] <= least:
            return order, columns[:, :k]
        for m in (rest, columns):
            m[[k, j]] = m[[j, k]]
        rest[:, [k, j]] = rest[:, [j, k]]
        order[[k, j]] = order[[j, k]]
        columns[k, k] = np.sqrt(rest[k, k])
        columns[k + 1 :, k] = rest[k + 1 :, k] / columns[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(columns[k + 1 :, k], columns[k + 1 :, k])
    return order, columns


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor times rotations that make its columns orthogonal to working precision.

    Each step of a sweep rotates disjoint pairs of columns, which a round robin deals so that every two meet once a sweep.
    """
    w = np.array(factor, np.float64)
    r = w.shape[1]
    ring = np.arange(r + r % 2)
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            i, j = ring[:half], ring[half:][::-1]
            real = (i < r) & (j < r)
            i, j = np.minimum(i, j)[real], np.maximum(i, j)[real]
            x, y = w[:, i], w[:, j]
            a, b, c = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            rotate = np.abs(c) > 4 * np.finfo(float).eps * np.sqrt(a * b)
            if rotate.any():
                turned = True
                z = (b[rotate] - a[rotate]) / (2 * c[rotate])
                t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.hypot(1, z))
                cos = 1 / np.hypot(1, t)
                x, y = x[:, rotate], y[:, rotate]
                w[:, i[rotate]], w[:, j[rotate]] = cos * (x - t * y), cos * (t * x + y)
            ring = np.concatenate((ring[:1], ring[-1:], ring[1:-1]))
        if not turned:
            break
    return w


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns of a covariance, without those that rounding can't tell from zero.

    Of each vector the largest entry in size is positive.
    """
    order, factor = pivoted_cholesky(v)
    w = orthogonal_columns(factor)
    values = (w * w).sum(axis=0)
    falling = np.argsort(-values, kind="stable")
    falling = falling[values[falling] > len(v) * np.finfo(float).eps * values.max(initial=0)]
    vectors = np.empty((len(v), len(falling)))
    vectors[order] = w[:, falling] / np.sqrt(values[falling])
    top = np.abs(vectors).argmax(axis=0) if len(falling) else np.zeros(0, int)
    return values[falling], vectors * np.where(vectors[top, np.arange(len(falling))] < 0, -1.0, 1.0)


def _sums(dim: int):
    def run(batches):
        n, total = 0, [0] * dim
        for batch in batches:
            x = scaled(batch.column(0), dim, SCALE, MOST)
            n += len(x)
            for lo in range(0, len(x), TOGETHER):
                total = [t + s for t, s in zip(total, x[lo : lo + TOGETHER].sum(axis=0).tolist())]
        if n:
            yield pa.record_batch([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array([str(t) for t in total])], names=["i", "n", "s"])

    return run


def _products(dim: int, shift: np.ndarray):
    """Per task: sums of products of centred components, for i <= j."""
    i, j = np.triu_indices(dim)

    def run(batches):
        total, ran = np.zeros((dim, dim), object), False
        for batch in batches:
            y = scaled(batch.column(0), dim, SCALE, MOST) - shift
            ran |= len(y) > 0
            for lo in range(0, len(y), TOGETHER):
                part = y[lo : lo + TOGETHER]
                if int(np.abs(part).max()) ** 2 * len(part) < 2**53:  # doubles hold every sum exactly
                    part = part.astype(np.float64)
                    total += (part.T @ part).astype(np.int64).astype(object)
                else:
                    part = part.astype(object)
                    total += part.T @ part
        if ran:
            yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array([str(s) for s in total[i, j]])], names=["i", "j", "s"])

    return run


def fit(rows: DataFrame, dim: int) -> Fit | None:
    """The components of all rows (vec); None without rows."""
    told = rows.select("vec").mapInArrow(_sums(dim), "i int, n long, s string").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(EXACT)).alias("s")).collect()
    if not told:
        return None
    n, shift, rest = int(told[0]["n"]), np.zeros(dim, np.int64), [0] * dim
    for r in told:
        shift[r["i"]] = round(int(r["s"]) / n)
        rest[r["i"]] = int(r["s"]) - n * int(shift[r["i"]])
    told = rows.select("vec").mapInArrow(_products(dim, shift), "i int, j int, s string").groupBy("i", "j").agg(F.sum(F.col("s").cast(EXACT)).alias("s")).collect()
    v = np.zeros((dim, dim))
    for r in told:
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / (n * n)  # a quotient of whole numbers, rounded once
    values, vectors = eigen(v)
    return Fit(n, shift, np.array(rest, object), values, vectors, float(np.trace(v)))


def _project(x: np.ndarray, f: Fit, k: int) -> np.ndarray:
    """Whitened values of centred integers."""
    centred = (x - f.shift).astype(np.float64) - (f.rest / f.n).astype(np.float64)
    return centred @ (f.vectors[:, :k] / np.sqrt(f.values[:k]))


def _deviation(x: np.ndarray, f: Fit) -> list[int]:
    """Sum over dimensions of (n * x - S)^2, exactly."""
    y, rest = x - f.shift, f.rest
    most = f.n * int(np.abs(y).max()) + max(abs(s) for s in rest)
    if most * most * x.shape[1] < 2**63:
        t = f.n * y - rest.astype(np.int64)
        return (t * t).sum(axis=1).tolist()
    t = f.n * y.astype(object) - rest
    return (t * t).sum(axis=1).tolist()


def whiten(df: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Fit | None]:
    """vec_id, deviation (decimal) and whitened (array<double>, by component) of each vector (vec_id, embedding), and the fit."""
    rows, dim = finite_vectors(df, F.col("vec_id").cast("long").alias("vec_id"))
    f = fit(rows, dim) if dim else None
    schema = f"vec_id long, deviation {EXACT}, whitened array<double>"
    if f is None:
        return df.sparkSession.createDataFrame([], schema), None
    k = min(components, len(f.values))

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = scaled(batch.column(1), dim, SCALE, MOST)
            w = _project(x, f, k)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
            yield pa.record_batch([batch.column(0), pa.array([str(d) for d in _deviation(x, f)]), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))], names=["vec_id", "deviation", "whitened"])

    told = rows.select("vec_id", "vec").mapInArrow(run, "vec_id long, deviation string, whitened array<double>")
    return told.select("vec_id", F.col("deviation").try_cast(EXACT).alias("deviation"), "whitened"), f


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """The largest entry in size of the covariance of whitened (array<double>) minus the identity, measured over all rows."""

    def run(batches):
        products, sums, ran = np.zeros((k, k)), np.zeros(k), False
        for batch in batches:
            ran |= len(batch) > 0
            w = np.asarray(batch.column(0).flatten(), np.float64).reshape(-1, k)
            products += w.T @ w
            sums += w.sum(axis=0)
        if ran:
            i, j = np.indices((k + 1, k))
            yield pa.record_batch([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(np.concatenate((products, sums[None])).ravel())], names=["i", "j", "s"])

    told = whitened.select("whitened").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    m = np.zeros((k + 1, k))
    for r in told:
        m[r["i"], r["j"]] = r["s"] / n
    return float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max(initial=0))


def whitened(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error: a row for each vector and component."""
    rows, f = whiten(df, components)
    names = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    k = 0 if f is None else min(components, len(f.values))
    if not k:
        return df.sparkSession.createDataFrame([], names)
    error = identity_error(rows, f.n, k)
    explained = F.array(*(F.lit(float(e / f.trace)) for e in f.values[:k]))
    each = rows.select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("p", "whitened"))
    return each.select("vec_id", (F.col("p") + 1).alias("component"), F.lit(f.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("p")).alias("explained"), F.lit(error).alias("identity_error"))
