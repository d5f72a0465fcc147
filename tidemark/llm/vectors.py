"""Vectors as integers, and their packing into tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps of a component of 1.
SCALE = 256
#: Integers up to this are exact as doubles.
EXACT = 1 << 53
#: Ends of 64-bit integers.
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Kinds of integers that a vector is packed as, the smallest that holds it.
KINDS = ("<i1", "<i2", "<i4", "<i8")


def floors(values: np.ndarray) -> np.ndarray:
    """floor(256 * value) of finite doubles; beyond 64 bits, the nearest end."""
    with np.errstate(over="ignore"):
        f = np.floor(SCALE * values)
    inside = (f >= float(LEAST)) & (f < float(1 << 63))
    return np.where(inside, np.where(inside, f, 0).astype(np.int64), np.where(f > 0, MOST, LEAST))


def integers(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each vector of a list column of doubles as integers; None for one that is null, empty, or holds null or
    non-finite components."""
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    finite = np.isfinite(values)
    x = floors(np.where(finite, values, 0))
    odd = np.concatenate([[0], np.cumsum(~finite)])
    ends = column.offsets.to_numpy()
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (odd[ends[1:]] == odd[ends[:-1]]) & (ends[1:] > ends[:-1])
    for i, good in enumerate(usable):
        yield x[ends[i] : ends[i + 1]] if good else None


def kind_of(x: np.ndarray) -> int:
    """The smallest of ``KINDS`` that holds x."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    return next(k for k in range(4) if -(1 << (8 << k) - 1) <= low and high < 1 << (8 << k) - 1)


def doubles(embeddings: DataFrame, *more: str) -> DataFrame:
    """vec_id (long), embedding (array of doubles), and columns that are named."""
    return embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), *more)
