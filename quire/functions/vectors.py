"""Vector arithmetic on array columns in double precision: in the JVM, and for long vectors in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector is null or zero or the lengths differ."""
    scale = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (scale > 0), dot(a, b) / scale)


def unit(a: Column) -> Column:
    """The vector at length 1; a zero vector stays zero (its norm is clipped at 1e-12)."""
    n = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(a, lambda x: (x.cast("double") / n).cast("float"))


def finite(a: Column, dims: int) -> Column:
    """Whether a vector has `dims` finite values, not all zero."""
    bad = F.exists(a, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(a) == dims) & ~bad & F.exists(a, lambda x: x != 0), F.lit(False))


def cosine_to(a: Column, vector: list[float]) -> Column:
    """Cosine similarity of each vector to a given one, a matrix product per batch; null for null, zero, non-finite
    and odd-length vectors."""
    query = np.array(vector, dtype=np.float64)
    query = query / np.linalg.norm(query) if np.any(query) else query

    @F.arrow_udf(DoubleType())
    def run(column: pa.Array) -> pa.Array:
        out = np.full(len(column), np.nan)
        right = np.flatnonzero(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == len(query))
        x = column.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(right), len(query))
        good = np.isfinite(x).all(axis=1)
        x[~good] = 0
        norm = np.linalg.norm(x, axis=1)
        good &= norm > 0
        out[right[good]] = x[good] @ query / norm[good]
        return pa.array(out, from_pandas=True)

    return run(a)
