"""Vectors of a table: what takes part, and classes of equal vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample


def usable(vector: Column) -> Column:
    """Neither null nor zero nor empty, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def matrix(batch: pa.RecordBatch, name: str, rows: slice | None = None) -> np.ndarray:
    """A column of equally long arrays as a matrix of doubles."""
    col = batch.column(batch.schema.get_field_index(name))
    if rows is not None:
        col = col.slice(rows.start, rows.stop - rows.start)
    flat = np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(col), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample_vectors(rows: DataFrame, n: int, vector: str = "v", key: str = "rank") -> np.ndarray:
    """At most n vectors, the smallest by hash of the key (a bounded sample)."""
    if n <= 0:
        return np.zeros((0, 0))
    picked = hash_sample(rows.select(vector, key), n, key).select(vector).toArrow()
    return unit(np.array(picked.column(0).to_pylist(), np.float64)) if picked.num_rows else np.zeros((0, 0))
