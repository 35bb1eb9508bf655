"""Batches of ML vectors as numpy arrays: sparse rows stay sparse."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stored(vector: str | Column) -> Column:
    """A vector column as the struct ``type, size, indices, values`` that :class:`Rows` reads."""
    return F.unwrap_udt(vector)


def vector_width(vector: str | Column) -> Column:
    """Number of components, stored or not."""
    u = stored(vector)
    return F.coalesce(u["size"], F.size(u["values"]))


class Rows:
    """A batch of vectors of one width.  A batch of dense vectors only is a matrix ``X``; any other is a list of
    ``row, index, value`` of the stored components."""

    def __init__(self, column: pa.Array, width: int):
        kinds, _, indices, values = column.flatten()
        self.n, self.width, self.X = len(column), width, None
        lengths = pc.list_value_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.value = values.flatten().to_numpy(zero_copy_only=False)
        dense = kinds.fill_null(0).to_numpy(zero_copy_only=False) == 1
        if len(self.value) == self.n * width and dense.all():
            self.X = self.value.reshape(self.n, width)
            return
        self.row = np.repeat(np.arange(self.n), lengths)
        self.index = np.arange(len(self.value)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.index[~dense[self.row]] = indices.flatten().to_numpy(zero_copy_only=False)

    def triples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.X is None:
            return self.row, self.index, self.value
        return np.repeat(np.arange(self.n), self.width), np.tile(np.arange(self.width), self.n), self.value

    def dot(self, w: np.ndarray) -> np.ndarray:
        """Each row's product with ``w``: a vector, or a matrix of ``width`` rows."""
        if self.X is not None:
            return self.X @ w
        if w.ndim == 1:
            return np.bincount(self.row, weights=self.value * w[self.index], minlength=self.n)
        out = np.zeros((self.n, w.shape[1]))
        np.add.at(out, self.row, self.value[:, None] * w[self.index])
        return out

    def weighted_sum(self, weights: np.ndarray) -> np.ndarray:
        """The sum of the rows, each times its weight (a vector), or times its row of weights (a matrix: width x columns)."""
        if self.X is not None:
            return self.X.T @ weights
        if weights.ndim == 1:
            return np.bincount(self.index, weights=self.value * weights[self.row], minlength=self.width)
        out = np.zeros((self.width, weights.shape[1]))
        np.add.at(out, self.index, self.value[:, None] * weights[self.row])
        return out

    def row_sums(self, of) -> np.ndarray:
        """Each row's sum of ``of(index, value)`` over its stored components; ``of`` must be 0 where the value is."""
        if self.X is not None:
            return of(np.arange(self.width)[None], self.X).sum(axis=1)
        return np.bincount(self.row, weights=of(self.index, self.value), minlength=self.n)


# Numbers of partial sums that the driver adds up itself, numbers of one slice that an executor adds up, and bytes of rows that a
# task should have at least.
COLLECT_NUMBERS = 1 << 20
SLICE_NUMBERS = 1 << 16
TASK_BYTES = 8 << 20


def fewer_tasks(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` in no more partitions than its counted size needs (no shuffle): iterations over little data are short jobs."""
    return df.coalesce(max(1, -(-rows * row_bytes // TASK_BYTES)))


def summed_arrays(parts: DataFrame, tasks: int, size: int, column: str = "s") -> np.ndarray:
    """The sum of the arrays of a frame, one for each of its ``tasks``.  Few are added up on the driver; of more, slices are summed on
    the executors first, and ``size`` numbers reach the driver.  Arrays travel as bytes."""
    total = np.zeros(size)
    if tasks * size <= COLLECT_NUMBERS:
        for r in parts.select(column).mapInArrow(_packed, "s binary").collect():
            total += np.frombuffer(r[0])
        return total
    numbers = SLICE_NUMBERS

    def sliced(arrow):
        for x in _arrays(arrow):
            cut = [x[i:i + numbers].tobytes() for i in range(0, len(x), numbers)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())], ["i", "s"])

    slices = parts.select(column).mapInArrow(sliced, "i int, s binary")
    for r in slices.groupBy("i").applyInArrow(_slice_sum, "i int, s binary").collect():
        at = r["i"] * numbers
        total[at:at + numbers] = np.frombuffer(r["s"])
    return total


def summed_slices(parts: RDD, tasks: int, size: int) -> np.ndarray:
    """:func:`summed_arrays` for an RDD of arrays, one for each of its ``tasks``."""
    if tasks * size <= COLLECT_NUMBERS:
        return sum(parts.collect(), np.zeros(size))
    numbers, total = SLICE_NUMBERS, np.zeros(size)
    for at, x in parts.flatMap(lambda x: [(i, x[i:i + numbers]) for i in range(0, len(x), numbers)]).reduceByKey(lambda a, b: a + b).collect():
        total[at:at + numbers] += x
    return total


def _arrays(arrow):
    for b in arrow:
        for k in range(len(b)):
            yield b.column(0)[k].values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def _packed(arrow):
    for x in _arrays(arrow):
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["s"])


def _slice_sum(key, table):
    total = 0.0
    for x in table.column("s"):
        total = total + np.frombuffer(x.as_buffer())
    return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "s": pa.array([total.tobytes()], pa.binary())})


def array_rows(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow list column."""
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(matrix, np.float64).ravel()))
