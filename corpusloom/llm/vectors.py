"""Columns of vectors as numpy rows: what the vector operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole(col: str) -> Column:
    """True where a vector is there and holds neither nulls nor components that aren't finite."""
    return F.col(col).isNotNull() & ~F.exists(F.col(col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def kept(vectors: DataFrame, vec_col: str, *columns: Column) -> DataFrame:
    """The columns and v, the vectors as doubles, of rows whose vector counts; other columns are left behind."""
    return vectors.filter(whole(vec_col)).select(*columns, F.col(vec_col).cast("array<double>").alias("v"))


def shape(rows: DataFrame) -> tuple[int, int, float]:
    """How many rows kept() gave, the length of the longest vector (1 at least), and the largest magnitude of a component."""
    n, dim, most = rows.agg(F.count("*"), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))).first()
    return int(n), max(1, int(dim or 0)), float(most or 0.0)


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a column without nulls as rows of doubles; shorter ones are filled up with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    values = col.flatten().to_numpy(zero_copy_only=False)
    sizes = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) * dim == len(values) and (sizes == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def scaled(x: np.ndarray, scale: int, add: int = 0) -> np.ndarray:
    """floor(scale * x) + add as longs."""
    return np.floor(scale * x).astype(np.int64) + add


def as_lists(x: np.ndarray) -> pa.ListArray:
    """Rows of numbers as a column of lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The batches put together to about as many rows, so that numpy works on long arrays; none is empty."""
    held, n = [], 0
    for b in batches:
        if len(b):
            held.append(b)
            n += len(b)
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)
