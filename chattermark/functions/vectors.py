"""Distances between embedding columns (arrays of floats).

The arithmetic runs on whole Arrow batches: for 64 dimensions that took a
third of the time of `aggregate(zip_with(...))`, which calls a lambda for each
element, and the gap widens with the dimension.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Send these functions along with the job, so that executors need no copy of
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEASURES = ("cosine_similarity", "cosine_distance", "euclidean", "manhattan")


def doubles(*names: str) -> T.StructType:
    """Struct type of double fields."""
    return T.StructType([T.StructField(name, T.DoubleType()) for name in names])


def as_matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list array without nulls as a matrix of doubles."""
    lengths = pc.unique(pc.list_value_length(vectors))
    if len(lengths) > 1:
        raise ValueError(f"vectors differ in length: {sorted(lengths.to_pylist())}")
    width = lengths[0].as_py() if len(lengths) else 0
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(vectors), width)


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise cosine similarity; 0 where a vector has no length."""
    lengths = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
    dots = np.einsum("ij,ij->i", x, y)
    return np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)


@F.arrow_udf(doubles(*MEASURES))
def _measure(a: pa.Array, b: pa.Array) -> pa.Array:
    both = pc.and_(pc.is_valid(a), pc.is_valid(b))
    x, y = as_matrix(a.filter(both)), as_matrix(b.filter(both))
    if x.shape != y.shape:
        raise ValueError(f"vectors differ in length: {x.shape[1]} and {y.shape[1]}")
    gap = x - y
    similarity = cosine(x, y)
    values = [similarity, 1 - similarity, np.linalg.norm(gap, axis=1), np.abs(gap).sum(axis=1)]
    present = np.asarray(both)
    columns = []
    for value in values:
        column = np.zeros(len(a))
        column[present] = value
        columns.append(pa.array(column, mask=~present))
    return pa.StructArray.from_arrays(columns, names=list(MEASURES))


def measures(a: str | Column, b: str | Column) -> Column:
    """Struct of cosine similarity, cosine distance, Euclidean and Manhattan distance."""
    return _measure(a, b)
