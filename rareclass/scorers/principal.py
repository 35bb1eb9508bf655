"""Principal axes of standardised rows by randomised subspace iteration (Halko, Martinsson & Tropp 2011)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .rows import Rows, array_rows, summed_arrays

# Directions beyond the wanted ones.
OVERSAMPLE = 64


def principal_axes(rows: DataFrame, tasks: int, n: int, mean: np.ndarray, scale: np.ndarray, k: int, tol: float = 1e-7, max_iter: int = 60,
                   seed: int = 42, oversample: int = OVERSAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """``(axes, variances)``: the k first principal axes (width x k) of ``(row - mean) / scale`` and the variances along
    them, largest first.  ``rows`` has one column, vectors as :func:`~rareclass.scorers.rows.stored` shows them.

    The correlation matrix is only ever multiplied by a block of ``k + oversample`` directions, one job each time: a task
    adds up ``row * (row . block)`` over its rows, sparse rows staying sparse, and centring is put in afterwards.  The
    driver orthogonalises the block; nothing of the size width x width exists.  It ends when the k variances are settled
    to ``tol`` of their sum.  Up to ``k + oversample`` features the block is the whole space and one job is exact.
    """
    width = len(mean)
    size = min(width, k + oversample)
    whole = size == width

    def product(block: np.ndarray) -> np.ndarray:
        """The correlation matrix times ``block``."""
        weights = block / scale[:, None]

        def partial(batches):
            acc = np.zeros((width, size))
            for batch in batches:
                part = Rows(batch.column(0), width)
                acc += part.weighted_sum(part.dot(weights))
            yield pa.RecordBatch.from_arrays([array_rows(acc.reshape(1, -1))], names=["s"])

        total = summed_arrays(rows.mapInArrow(partial, "s array<double>"), tasks, width * size).reshape(width, size)
        return (total / n - np.outer(mean, mean @ weights)) / scale[:, None]

    block = np.eye(width) if whole else np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    before = np.zeros(k)
    for _ in range(max_iter):
        image = product(block)
        small = block.T @ image
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1][:k]
        axes, variances = block @ vectors[:, order], values[order]
        if whole or np.abs(variances - before).max(initial=0.0) <= tol * max(np.abs(variances).sum(), 1e-300):
            break
        before, block = variances, np.linalg.qr(image)[0]
    return axes, np.maximum(variances, 0.0)
