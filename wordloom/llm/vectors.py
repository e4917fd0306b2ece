"""Vectors of whole numbers made of embeddings, as rows of bytes that numpy reads."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import schema_of

#: Components are smaller than this, so squared distances of 64 of them fit a long.
LARGEST = 2**27


def scaled_rows(column: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the usable vectors of an Arrow list column, and a matrix with
    ``floor(scale * c)`` of their components, as 32-bit numbers."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(lengths == dimensions)
    values = column.take(pa.array(places)).flatten().cast(pa.float64())
    values = values.to_numpy(zero_copy_only=False).reshape(len(places), dimensions)
    with np.errstate(invalid="ignore", over="ignore"):
        numbers = np.floor(values * scale)
        usable = (np.abs(numbers) < LARGEST).all(axis=1)  # false for NaN and infinities
    return places[usable], numbers[usable].astype(np.int32)


def as_bytes(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix, each as little-endian bytes."""
    data = np.ascontiguousarray(matrix, dtype="<i4")
    ends = np.arange(len(data) + 1, dtype=np.int32) * np.int32(data.shape[1] * 4)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())]
    )


def as_matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """The matrix of a column that :func:`as_bytes` made, in 64-bit numbers."""
    rows = np.frombuffer(b"".join(column.to_pylist()), dtype="<i4")
    return rows.reshape(-1, dimensions).astype(np.int64)


def integer_vectors(
    vectors: DataFrame, dimensions: int, scale: int, id_column: str, vector_column: str
) -> DataFrame:
    """``_id, _x`` of every usable vector: ``_x`` has ``floor(scale * c)`` of its components.

    Left out are null vectors, those of another length, and those with a component that is
    null, not finite, or of 2^27 or more after scaling.
    """
    rows = vectors.select(F.col(id_column).alias("_id"), F.col(vector_column).alias("_x"))

    def convert(batches):
        for batch in batches:
            places, matrix = scaled_rows(batch.column("_x"), dimensions, scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(places)), as_bytes(matrix)], names=["_id", "_x"]
            )

    return rows.mapInArrow(convert, schema_of(rows, ["_id"], _x="binary"))
