"""Polynomial kernel by TensorSketch (Pham & Pagh 2013): a feature map of fixed width for vectors of any width."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import Rows, array_rows, stored

# Hash values are taken modulo this prime, so products of two fit 64 bits.
PRIME = (1 << 31) - 1
# Numbers of a block that is transformed at a time.
BLOCK_CELLS = 1 << 20


class TensorSketch:
    """``z`` with ``<z(x), z(y)>`` near ``(gamma <x, y> + coef0) ** degree``, an unbiased estimate whose error falls with
    the square root of ``n_components``.

    A count sketch adds each component, times a hashed sign, to a hashed place.  The polynomial kernel's map is the
    ``degree``-fold outer product of the vector with itself; the circular convolution of ``degree`` independent count
    sketches - a product of their Fourier transforms - is a count sketch of it.  Signs are 4-wise and places pairwise
    independent polynomials modulo a prime, computed from the component's number: no table grows with the width, and
    only stored components of a sparse vector are read.
    """

    def __init__(self, width: int, gamma: float, coef0: float = 0.0, degree: int = 3, n_components: int = 1024, seed: int = 42):
        if coef0 < 0:
            raise ValueError("coef0 must not be negative")
        rng = np.random.default_rng(seed)
        self.width, self.gamma, self.coef0, self.D = width, gamma, coef0, n_components
        self.places = rng.integers(1, PRIME, (degree, 2))
        self.signs = rng.integers(1, PRIME, (degree, 4))

    def _hashed(self, index: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and sign of components in the sketch ``which``; number ``width`` is the constant ``coef0``."""
        a, b = self.places[which]
        sign = np.zeros_like(index)
        for c in self.signs[which]:
            sign = (sign * index + c) % PRIME
        return (a * index + b) % PRIME % self.D, 1.0 - 2.0 * (sign & 1)

    def map(self, rows: Rows) -> np.ndarray:
        row, index, value = rows.triples()
        index = index.astype(np.int64)
        product = None
        for which in range(len(self.places)):
            place, sign = self._hashed(index, which)
            flat = np.bincount(row * self.D + place, weights=value * sign * math.sqrt(self.gamma), minlength=rows.n * self.D)
            sketch = flat.reshape(rows.n, self.D)
            if self.coef0:
                at, own = self._hashed(np.array([self.width]), which)
                sketch[:, at[0]] += own[0] * math.sqrt(self.coef0)
            wave = np.fft.rfft(sketch, axis=1)
            product = wave if product is None else product * wave
        return np.fft.irfft(product, self.D, axis=1)

    def transform(self, df: DataFrame, features: str = "features", out: str = "sketch") -> DataFrame:
        step = max(1, BLOCK_CELLS // max(self.D, 1))

        @F.arrow_udf("array<double>")
        def sketch(column: pa.Array) -> pa.Array:
            parts = [self.map(Rows(column.slice(at, step), self.width)) for at in range(0, len(column), step)]
            return array_rows(np.vstack(parts) if parts else np.zeros((0, self.D)))

        return df.withColumn(out, array_to_vector(sketch(stored(features))))
