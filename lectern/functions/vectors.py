"""Vector functions: normalization, dot products, half-precision packing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import let


def dot_product(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v
    )


def l2_normalize(vector: Column) -> Column:
    """Vector over its length; the zero vector stays as it is."""
    return let(
        F.sqrt(dot_product(vector, vector)),
        lambda n: F.transform(vector, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n)),
    )


def matrix_of(vectors: pa.Array, length: int | None = None) -> np.ndarray:
    """Vectors without nulls as rows of double precision; all must have one length."""
    sizes = pc.list_value_length(vectors)
    least, most = pc.min_max(sizes).values() if len(vectors) else (pa.scalar(0), pa.scalar(0))
    if len(vectors) and (least.as_py() != most.as_py() or (length or most.as_py()) != most.as_py()):
        raise ValueError(f"vectors of {least} to {most} components where {length or 'one length'} is asked for")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), most.as_py() or length or 0)


def dot_with(vector: Column, query: list[float]) -> Column:
    """Dot product with one constant vector, a matrix product per Arrow batch.

    A vector of another length than the query's stops the job.
    """
    q = np.asarray(query, dtype=np.float64)

    @F.arrow_udf(T.DoubleType())
    def score(vectors: pa.Array) -> pa.Array:
        out = np.full(len(vectors), np.nan)
        held = np.asarray(vectors.is_valid())
        if held.any():
            out[held] = matrix_of(vectors.drop_null(), q.size) @ q
        return pa.array(out, mask=~held)

    return score(vector)


def _with_nulls(values: pa.Array, held: np.ndarray) -> pa.Array:
    """``values`` at the held places, null elsewhere."""
    return values.take(pa.array(np.where(held, np.cumsum(held) - 1, 0), mask=~held))


@F.arrow_udf(T.BinaryType())
def pack_f16(vectors: pa.Array) -> pa.Array:
    """Vectors scaled to unit length, as little-endian half-precision bytes.

    Vectors of one batch are one matrix; vectors of different lengths stop the job.
    """
    held, rows = np.asarray(vectors.is_valid()), matrix_of(vectors.drop_null())
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    halves = np.ascontiguousarray((rows / np.where(norms == 0, 1.0, norms)[:, None]).astype("<f2"))
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (2 * rows.shape[1])
    packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(halves)])
    return _with_nulls(packed, held)


@F.arrow_udf(T.ArrayType(T.FloatType()))
def unpack_f16(blobs: pa.Array) -> pa.Array:
    """Little-endian half-precision bytes as float vectors."""
    held, kept = np.asarray(blobs.is_valid()), blobs.drop_null()
    lengths = pc.binary_length(kept).to_numpy(zero_copy_only=False) // 2
    joined = kept.cast(pa.binary())
    start, end = (joined.offset, joined.offset + len(joined))
    places = np.frombuffer(joined.buffers()[1], dtype=np.int32)[start:end + 1] if len(joined) else np.zeros(1, np.int32)
    data = np.frombuffer(joined.buffers()[2] or b"", dtype=np.uint8)[places[0]:places[-1]]
    floats = data.tobytes()
    values = pa.array(np.frombuffer(floats, dtype="<f2").astype(np.float32))
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return _with_nulls(pa.ListArray.from_arrays(offsets, values), held)
