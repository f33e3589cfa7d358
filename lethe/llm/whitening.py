"""Whitening of embeddings: principal components by Cholesky and Jacobi.

1. *Fit list*: each different integer vector once (``distinct``, counted before the shuffle).
2. *Sums and scatter*: each task adds up its vectors, then the products of its centred vectors; Spark adds up the tasks' parts.
   Only ``d`` sums and ``d * (d + 1) / 2`` products reach the driver, whatever the number of rows.
3. *Pivoted Cholesky* of the centred scatter gives a triangular factor ``L`` with ``L L' = scatter``, columns by falling
   pivot; it ends where the rest is rounding error, which settles the rank.
4. *One-sided Jacobi* on ``L``: columns are turned against each other in disjoint pairs until all are orthogonal. The
   squared column norms are then the eigenvalues of the scatter and the columns, at length one, its eigenvectors.
   The scatter is never multiplied out again, so small eigenvalues keep their relative accuracy.
5. Every row is centred, projected and divided by the roots of the eigenvalues, in the tasks.

Defined cases: null vectors, vectors with null or non-finite entries, empty vectors and vectors of another length than most
are left out; repeated rows and ids, and null ids, are kept; components whose eigenvalue is rounding error (a
constant table, fewer different vectors than components) do not exist and give no rows; an empty table gives no rows;
``deviation`` is null where it exceeds 64 bits. Coordinates are limited to about 2^30 / sqrt(d).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from lethe.llm.frames import ship, stored
from lethe.llm.vectors import matrix, scaled

COMPONENTS = 4
#: Rows multiplied at once in a task.
BLOCK = 8192


@dataclass
class Fit:
    """What all rows need; of a size that depends on the dimension only."""

    n: int
    sums: np.ndarray  # of the fit list, exact
    values: np.ndarray  # eigenvalues of the covariance, falling
    vectors: np.ndarray  # one column for each
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - self.sums / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def _blocks(batches: Iterator[pa.RecordBatch], column: int, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for row in range(0, batch.num_rows, BLOCK):
            part = batch.slice(row, BLOCK)
            yield part, matrix(part.column(column), d)


def added_up(rows: DataFrame, d: int, part, shape: tuple[int, ...], kind: type = np.float64) -> np.ndarray:
    """The sum of ``part(block)`` over all blocks of vectors: one partial sum a task, added by Spark."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for _, x in _blocks(batches, 0, d):
            total += part(x)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place])], names=["place", "value"])

    name = "long" if kind is np.int64 else "double"
    found = rows.select("x").mapInArrow(task, f"place long, value {name}").groupBy("place").agg(F.sum("value").alias("value"))
    out, parts = np.zeros(int(np.prod(shape)), kind), found.toArrow()
    out[parts.column("place").to_numpy()] = parts.column("value").to_numpy()
    return out.reshape(shape)


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): ``scatter[order][:, order] = L L'``, with as many columns as the scatter has rank."""
    d = len(scatter)
    order, rest, factor = np.arange(d), scatter.diagonal().copy(), np.zeros((d, d))
    least = d * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(rest[k:]))
        if rest[p] <= least:
            return factor[:, :k], order
        for a in (order, rest, factor):
            a[[k, p]] = a[[p, k]]
        factor[k, k] = np.sqrt(rest[k])
        below = scatter[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = below / factor[k, k]
        rest[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns turned until they are orthogonal, longest first.

    Columns meet as in a round-robin tournament, so half as many pairs as columns turn at once.
    """
    g, r = factor.copy(), factor.shape[1]
    places = list(range(r + r % 2))
    for _ in range(sweeps if r > 1 else 0):
        turned = False
        for _ in range(len(places) - 1):
            pairs = [(a, b) for a, b in zip(places[: len(places) // 2], reversed(places)) if a < r and b < r]
            p, q = np.array(pairs).T
            x, y = g[:, p], g[:, q]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            some = np.abs(gamma) > 1e-15 * np.sqrt(alpha * beta)
            turned |= bool(some.any())
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros(len(p)), where=some)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(some, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, p], g[:, q] = c * x - c * t * y, c * t * x + c * y
            places = [places[0], places[-1], *places[1:-1]]
        if not turned:
            break
    return g[:, np.argsort(-(g * g).sum(0), kind="stable")]


def principal(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a scatter matrix, by falling value; the rank says how many.

    Each vector's entry of largest size is positive.
    """
    factor, order = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(factor)
    lengths = np.sqrt((turned * turned).sum(0))
    vectors = np.empty_like(turned)
    vectors[order] = turned / lengths
    if vectors.size:
        largest = np.abs(vectors).argmax(0)
        vectors *= np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return lengths**2, vectors


def fit(vectors: DataFrame, d: int, components: int = COMPONENTS) -> Fit | None:
    """The whitening of the different vectors ``x``; nothing if there are none."""
    different = stored(vectors.select("x").distinct(), "fit-list")
    n = different.count()
    if n == 0:
        return None
    sums = added_up(different, d, lambda x: x.sum(0), (d,), np.int64)
    mean = sums / n

    def products(x: np.ndarray) -> np.ndarray:
        y = x - mean
        return np.triu(y.T @ y)

    scatter = added_up(different, d, products, (d, d))
    scatter += np.triu(scatter, 1).T
    values, axes = principal(scatter)
    found = Fit(n, sums, values[:components] / n, axes[:, :components], scatter.trace() / n)
    k = len(found.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = found.whiten(x)
        return np.vstack([w.sum(0), w.T @ w])

    if k:
        first, *second = added_up(different, d, moments, (k + 1, k)) / n
        found.identity_error = float(np.abs(np.array(second) - np.outer(first, first) - np.eye(k)).max())
    return found


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Squared lengths of ``n * x - sums``, exact; null beyond 64 bits."""
    reach = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if reach * reach * x.shape[1] < 1 << 63:
        y = x * n - sums
        return pa.array((y * y).sum(1))
    y = x.astype(object) * n - sums.astype(object)
    return pa.array([v if v < 1 << 63 else None for v in (y * y).sum(1)], pa.int64())


def whiten(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row of (vec_id, embedding)."""
    rows, d = scaled(df, "vec_id")
    rows = stored(rows, "vectors")
    schema = StructType(
        [
            rows.schema["vec_id"],
            StructField("component", IntegerType()),
            StructField("n", LongType()),
            StructField("deviation", LongType()),
            StructField("whitened", DoubleType()),
            StructField("explained", DoubleType()),
            StructField("identity_error", DoubleType()),
        ]
    )
    found = fit(rows, d, components)
    if found is None or not len(found.values):
        return df.sparkSession.createDataFrame([], schema)
    k = len(found.values)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, 1, d):
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), found.n)),
                    deviations(x, found.n, found.sums).take(pa.array(each)),
                    pa.array(found.whiten(x).ravel()),
                    pa.array(np.tile(found.values / found.trace, len(x))),
                    pa.array(np.full(len(each), found.identity_error)),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(task, schema)


ship(__name__)
