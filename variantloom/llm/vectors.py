"""Vectors as exact integers, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 64 times an entry may be this large in either direction; beyond, sums with it would leave 64 bits.
LARGEST = 1 << 61


def integers(df: DataFrame, col: str = "embedding") -> DataFrame:
    """(vec_id, embedding) -> vec_id, x = floor(64 * entry) of each entry as double; without the rows whose vector is null,
    empty, or holds an entry that is null, not finite, or over 2^55 in size."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(col).cast("array<double>").alias("x"))
    fine = F.forall("x", lambda c: F.coalesce(F.abs(c) <= LARGEST / 64, F.lit(False)))  # NaN is above every number
    return rows.where(F.col("x").isNotNull() & (F.size("x") > 0) & fine).select("vec_id", F.transform("x", lambda c: F.floor(c * 64)).alias("x"))


def matrix(batch: pa.RecordBatch, col: str = "x") -> np.ndarray:
    """The lists of equal length of an Arrow column as rows of a matrix."""
    column = batch.column(col)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def as_long(values: np.ndarray) -> pa.Array:
    """Integers of any size as 64-bit ones; null where they don't fit."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([v if -(1 << 63) <= v < 1 << 63 else None for v in values.tolist()], pa.int64())


def exact_sum(x: np.ndarray) -> np.ndarray:
    """The sums of the columns, as Python's integers."""
    small = len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
    return (x if small else x.astype(object)).sum(0).astype(object)


def totals(rows: DataFrame, size: int, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the `size` integers that `of` makes of a batch of them, exact. A task sends what it has
    summed up, in two halves of 64 bits and more; a shuffle adds these, and the driver gets `size` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=object)
        for b in batches:
            if len(b):
                total = total + of(b)
        at = np.flatnonzero(total)
        halves = [divmod(v, 1 << 64) for v in total[at].tolist()]
        text = [pa.array([str(h[i]) for h in halves], pa.string()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *text], ["at", "high", "low"])

    halves = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    out = np.zeros(size, dtype=object)
    for r in rows.mapInArrow(run, "at int, high string, low string").groupBy("at").agg(*halves).collect():
        out[r.at] = (int(r.high) << 64) + int(r.low)
    return out
