"""What the operators on embedding tables share: finite vectors, moments over all rows, results brought back to equal rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000


def finite(vector: Column, below: float | None = None) -> Column:
    """True for a vector with entries, none of them null, NaN or infinite (or, with ``below``, as large as that)."""
    limit = F.lit(float("inf") if below is None else float(below))
    entries = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < limit))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & entries, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    """A list column without nulls, all lists of one length, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(rows, -1 if rows else 0)


def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a list column."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * np.int32(values.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def moments(found: DataFrame, size: int, centred, dim: int, column: str = "x") -> tuple[float, np.ndarray, np.ndarray]:
    """Total weight, weighted sums and weighted products of the vectors ``column`` with weights ``w``, over all rows.

    ``centred`` turns a batch matrix into the doubles to multiply. Every task multiplies its batches and hands on one
    triangle; the driver gets ``dim`` squared sums, whatever the number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, sums, products = 0.0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                w = batch.column(1).to_numpy().astype(float)
                rows = centred(matrix(batch.column(0)))
                weight += w.sum()
                sums += w @ rows
                products += (rows * w[:, None]).T @ rows
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([[-2], np.full(dim, -1), i])), pa.array(np.concatenate([[0], np.arange(dim), j])),
            pa.array(np.concatenate([[weight], sums, products[i, j]])),
        ], ["i", "j", "v"])

    parts = found.filter(F.size(column) == size).select(column, "w").mapInArrow(run, "i long, j long, v double")
    weight, sums, products = 0.0, np.zeros(dim), np.zeros((dim, dim))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v")).collect():
        if i == -2:
            weight = v
        elif i == -1:
            sums[j] = v
        else:
            products[i, j] = products[j, i] = v
    return weight, sums, products


def bring_back(rows: DataFrame, found: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with the columns of ``found``, one row of which belongs to ``w`` equal rows.

    What holds more than a thousandth of all rows, at most 1,000 such rows of ``found``, is broadcast; so no task gets the
    rows of a hot key. The others meet by a shuffle.
    """
    hot = found.filter(F.col("w") * HOT_SHARE > F.lit(total))
    cold = found.filter(F.col("w") * HOT_SHARE <= F.lit(total))
    near = rows.join(F.broadcast(hot), keys)
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return near.unionByName(far)
