"""Vector columns: which rows take part, and their numbers as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(vec: Column) -> Column:
    """The vector is there, and so is each component, as a finite number."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~bad


def finite_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows whose vector holds nothing but finite numbers; other columns,
    whatever their names, stay out of the way."""
    return rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).filter(is_finite(F.col("vec")))


def by_length(column: pa.Array, kind=np.float64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of the vectors in a column of lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    lengths = np.diff(column.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """A column of lists of one length."""
    for _, m in by_length(column, kind):
        return m
    return np.zeros((0, 0), kind)
