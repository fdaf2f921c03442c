"""Vectors as numpy matrices: reading array columns, and which vectors can be compared."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def comparable(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, matrix in double precision) of the vectors that can be compared.

    Left out: vectors that are null, empty, zero or hold a null or non-finite component.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets).astype(np.int64)
    values = np.asarray(column.values.cast(pa.float64()).fill_null(float("nan")))
    size = np.diff(offsets)
    known = ~np.asarray(column.is_null())
    for d in np.unique(size[known & (size > 0)]):
        rows = np.flatnonzero(known & (size == d))
        x = values[offsets[rows][:, None] + np.arange(d)]
        ok = np.isfinite(x).all(1) & (x != 0).any(1)
        if ok.any():
            yield int(d), rows[ok], x[ok]


def packed(vectors: DataFrame, id_col: str, vec_col: str, null_ids: bool = False, odd: bool = False) -> DataFrame:
    """(id long, d int, v binary): the comparable vectors as bytes of 32-bit floats, or of 64-bit ones if the column is wider.

    Rows with a null id are left out unless null_ids; with odd, the rows that can't be compared come instead, without vectors.
    """
    kind = vectors.schema[vec_col].dataType.elementType.simpleString()
    to = np.float32 if kind == "float" else np.float64
    names = ["id", "d", "v"]

    def pack(batches):
        for b in batches:
            left = np.ones(b.num_rows, bool)
            for d, rows, x in comparable(b.column(1)):
                left[rows] = False
                if not odd:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), d, np.int32)), rows_binary(x.astype(to))], names)
            if odd and left.any():
                ids = b.column(0).filter(pa.array(left))
                yield pa.RecordBatch.from_arrays([ids, pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())], names)

    own = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("v"))
    return (own if null_ids else own.where("id is not null")).mapInArrow(pack, "id long, d int, v binary")


def rows_binary(x: np.ndarray) -> pa.Array:
    """A binary array with each row's bytes."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize if x.ndim == 2 else x.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(x)]).cast(pa.binary()) if len(x) else pa.array([], pa.binary())


def matrix(column, d: int, dtype=None) -> np.ndarray:
    """The rows of a binary column whose rows are all of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    if dtype is None:
        dtype = np.float32 if len(raw) == 4 * n * d else np.float64
    return np.frombuffer(raw.tobytes(), dtype).reshape(n, d)
