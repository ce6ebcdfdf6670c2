"""Rows of whole-number vectors: what the vector operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDEST = 2.0 ** 62
SUMS = "grp int, dim int, n long, high long, low long"
SUMS_ARROW = pa.schema([("grp", pa.int32()), ("dim", pa.int32()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64())])


def is_finite(vector: Column) -> Column:
    """No null, NaN or infinite entry (null for a null vector)."""
    return F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))


def whole_numbers(vector: Column, scale: int = 64, offset: int = 0) -> Column:
    """floor(scale * v) + offset of every entry, as longs; an entry beyond 2^62 is an error, not a wrapped number."""
    def one(v: Column) -> Column:
        scaled = F.floor(v * F.lit(float(scale)))
        fits = F.abs(v * F.lit(float(scale))) < F.lit(WIDEST)
        return F.when(fits, scaled.cast("long")).otherwise(
            F.raise_error(F.lit("a vector entry is too large for a long")).cast("long")) + F.lit(offset).cast("long")
    return F.transform(vector, one)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls as rows x width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class GroupSums:
    """Exact sums of whole-number rows by group: the partial sums of one task."""

    def __init__(self, groups: int, width: int):
        self.count = np.zeros(groups, dtype=np.int64)
        self.high = np.zeros((groups, width), dtype=np.int64)
        self.low = np.zeros((groups, width), dtype=np.int64)

    def add(self, group: np.ndarray, rows: np.ndarray) -> None:
        """Halves of 32 bits are summed apart, so no sum over a task leaves a long."""
        high, low = rows >> 32, rows & 0xFFFFFFFF
        for g in np.unique(group):
            mine = group == g
            self.count[g] += int(mine.sum())
            self.high[g] += high[mine].sum(axis=0)
            self.low[g] += low[mine].sum(axis=0)

    def batches(self) -> Iterator[pa.RecordBatch]:
        groups = np.flatnonzero(self.count)
        width = self.high.shape[1]
        if len(groups):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(groups, width), pa.int32()), pa.array(np.tile(np.arange(width), len(groups)), pa.int32()),
                pa.array(np.repeat(self.count[groups], width), pa.int64()),
                pa.array(self.high[groups].ravel(), pa.int64()), pa.array(self.low[groups].ravel(), pa.int64())], schema=SUMS_ARROW)


def merged_sums(partial: DataFrame, width: int) -> dict[int, tuple[int, list[int]]]:
    """group -> (rows, exact sum per dimension): groups x width rows reach the driver."""
    total = partial.groupBy("grp", "dim").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in total.collect():
        out.setdefault(r["grp"], (r["n"], [0] * width))[1][r["dim"]] = (r["high"] << 32) + r["low"]
    return out
