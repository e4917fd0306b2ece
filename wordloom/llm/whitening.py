"""Whitening of embeddings: blockwise QR, bidiagonal form, dqds, twisted factorisations."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import schema_of, stored
from wordloom.llm.singular import right_singular
from wordloom.llm.vectors import as_matrix, integer_vectors

#: Triangles that one task, or at last the driver, stacks and reduces to one.
_FAN_IN = 32


@dataclass(frozen=True)
class Whitening:
    """What is learned from the distinct vectors: ``whiten(x) = (x - mean) @ directions``."""

    n: int
    sums: list[int]  # of the components, exact
    variances: np.ndarray  # of the components kept, falling
    trace: float
    directions: np.ndarray  # a unit vector over the deviation, in each column

    def off(self, x: np.ndarray) -> np.ndarray:
        """The vectors minus the mean, of which the whole part is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.off(x) @ self.directions

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((n x - S)^2)`` exactly; null where it does not fit a long."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if largest < 2**62:
            off = x * self.n - np.array(self.sums, dtype=np.int64)
            if x.shape[1] * int(np.abs(off).max(initial=0)) ** 2 < 2**63:
                return (off * off).sum(axis=1).tolist()
            off = off.astype(object)
        else:
            off = x.astype(object) * self.n - np.array(self.sums, dtype=object)
        exact = (off * off).sum(axis=1).tolist()
        return [value if value < 2**63 else None for value in exact]


def _sums(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each component."""

    def add(batches):
        n, sums = 0, np.zeros(dimensions, dtype=np.int64)
        for batch in batches:
            x = as_matrix(batch.column("_x"), dimensions)
            n += len(x)
            sums += x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimensions)), pa.array(sums), pa.array(np.full(dimensions, n))],
                names=["dimension", "total", "n"],
            )

    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    parts = fit.mapInArrow(add, "dimension long, total long, n long")
    rows = parts.groupBy("dimension").agg(exact, F.sum("n").alias("n")).orderBy("dimension").collect()
    return (rows[0]["n"] if rows else 0), [int(row["total"]) for row in rows]


def _triangle(fit: DataFrame, start: Whitening, dimensions: int) -> np.ndarray:
    """The upper triangle R of the QR decomposition of all centred vectors.

    A task reduces its vectors block by block: the triangle so far is stacked on the next
    block and decomposed again. So every task ends with one triangle, and so many of those
    are stacked in a task that few are left for the driver.
    """

    def reduce(batches):
        r = np.zeros((0, dimensions))
        for batch in batches:
            x = start.off(as_matrix(batch.column("_x"), dimensions))
            r = np.linalg.qr(np.vstack([r, x]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()])],
                names=["part", "r"],
            )

    def stack(group: pa.Table) -> np.ndarray:
        order = np.argsort(group["part"].to_numpy(), kind="stable")
        held = group["r"].to_pylist()
        rows = [np.frombuffer(held[i]).reshape(-1, dimensions) for i in order]
        return np.linalg.qr(np.vstack(rows), mode="r")

    def join(group: pa.Table) -> pa.Table:
        part = group["part"][0].as_py() // _FAN_IN
        return pa.table({"part": pa.array([part]), "r": pa.array([stack(group).tobytes()])})

    parts = stored(fit.mapInArrow(reduce, "part long, r binary"))
    while parts.count() > _FAN_IN:
        above = F.floor(F.col("part") / _FAN_IN)
        parts = stored(parts.groupBy(above).applyInArrow(join, "part long, r binary"))
    r = stack(parts.toArrow())
    square = np.zeros((dimensions, dimensions))
    square[: len(r)] = r
    return square


def fit_whitening(
    vectors: DataFrame, dimensions: int, components: int
) -> tuple[Whitening, DataFrame]:
    """Learns from ``_x`` of ``vectors``, each distinct vector once; returns those as well.

    Directions are right singular vectors of the centred vectors: their R is brought to
    bidiagonal form by reflections, dqds gives its singular values, twisted factorisations
    its vectors. Directions without variance (singular values below 10^-12 of the largest)
    are left out, so there may be fewer than ``components``.
    """
    # Copies are dropped before the shuffle as well; what is stored has every vector once.
    fit = stored(vectors.select("_x").distinct())
    n, sums = _sums(fit, dimensions)
    nothing = Whitening(n, sums, np.zeros(0), 0.0, np.zeros((dimensions, 0)))
    if n == 0:
        return nothing, fit
    squares, directions = right_singular(_triangle(fit, nothing, dimensions))
    kept = int((squares[:components] > 1e-24 * squares[0]).sum())
    variances = squares / n
    scaled = directions[:, :kept] / np.sqrt(variances[:kept])
    return Whitening(n, sums, variances[:kept], float(variances.sum()), scaled), fit


def identity_error(fit: DataFrame, model: Whitening, dimensions: int) -> float:
    """The largest entry of the covariance of the whitened vectors minus the identity."""
    k = len(model.variances)

    def add(batches):
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whiten(as_matrix(batch.column("_x"), dimensions))
            total += w.sum(axis=0)
            products += w.T @ w
        i, j = np.divmod(np.arange(k * k + k), k)  # the row after the last has the sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), pa.array(np.concatenate([products.ravel(), total]))],
            names=["i", "j", "value"],
        )

    rows = fit.mapInArrow(add, "i long, j long, value double")
    values = np.zeros((k + 1, k))
    for row in rows.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        values[row["i"], row["j"]] = row["value"]
    mean = values[k] / model.n
    return float(np.abs(values[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten_vectors(
    vectors: DataFrame,
    components: int = 16,
    dimensions: int = 64,
    scale: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every
    vector and each of the first ``components`` principal components, numbered from 1.

    A component c of a vector becomes ``floor(scale * c)``. A constant added to it changes
    no result, so none is added. Mean and covariance
    are those of the ``n`` distinct vectors; ``whitened`` is the vector minus the mean,
    projected on the component, over the root of its variance; ``explained`` the share of
    the component in the whole variance; ``deviation`` the exact sum of ``(n x - S)^2``,
    null where that does not fit a long; ``identity_error`` what is measured over all
    distinct vectors after whitening.

    Vectors that are null, of another length, or have a component that is null, not finite
    or of 2^27 or more after scaling, have no rows. Copies count once in the fit and have
    rows each; null ids stay null. An empty table, or one with a single distinct vector,
    has no variance and gives no rows. Other columns are not read. What is gathered are
    sums and triangles of ``dimensions`` squared numbers, so no task holds more than 32 of
    those besides a batch of vectors.
    """
    rows = stored(integer_vectors(vectors, dimensions, scale, id_column, vector_column))
    model, fit = fit_whitening(rows, dimensions, components)
    k = len(model.variances)
    schema = schema_of(
        rows,
        ["_id"],
        component="int",
        n="long",
        deviation="long",
        whitened="double",
        explained="double",
        identity_error="double",
    )
    error = identity_error(fit, model, dimensions) if k else 0.0
    explained = model.variances / model.trace if k else model.variances

    def project(batches):
        for batch in batches:
            x = as_matrix(batch.column("_x"), dimensions)
            m = len(x)
            deviation = pa.array(model.deviations(x), pa.int64())
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    deviation.take(each),
                    pa.array(model.whiten(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=schema.names,
            )

    found = rows.mapInArrow(project, schema) if k else rows.sparkSession.createDataFrame([], schema)
    return found.withColumnRenamed("_id", id_column)
