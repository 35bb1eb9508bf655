"""Principal axes and reconstruction errors equal the dense solver's."""

import numpy as np
import pytest
from test_kernels import frame, wide

from rareclass.scorers import ReconstructionScorer
from rareclass.scorers.principal import principal_axes
from rareclass.scorers.rows import fewer_tasks, stored


def dense(X, k):
    """Mean, scale and axes by the correlation matrix."""
    mean, std = X.mean(axis=0), X.std(axis=0)
    scale = np.where(std > 1e-12, std, 1.0)
    Z = (X - mean) / scale
    values, vectors = np.linalg.eigh(Z.T @ Z / len(X))
    return Z, mean, scale, vectors[:, np.argsort(values)[::-1][:k]], np.sort(values)[::-1][:k]


def table(n=200, d=90, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 6)) @ rng.normal(size=(6, d)) + 0.3 * rng.normal(size=(n, d)) + 2.0
    X[:, 7] = 1.0  # constant
    X[:, 8] = X[:, 9]  # rank-deficient
    X[rng.random(X.shape) < 0.4] = 0.0
    return X


@pytest.mark.parametrize("oversample", [200, 8])
def test_axes_equal_the_dense_solver(spark, oversample):
    X = table()
    Z, mean, scale, axes, values = dense(X, 4)
    rows = fewer_tasks(frame(spark, X, sparse=lambda i: i % 2 == 0).select(stored("features").alias("u")), 200, 8)
    got, variances = principal_axes(rows, rows.rdd.getNumPartitions(), 200, mean, scale, 4, tol=1e-10, oversample=oversample)
    assert np.allclose(variances, values, rtol=1e-6)
    assert np.allclose(np.abs((got * axes).sum(axis=0)), 1, atol=1e-4)  # same axes, either sign
    assert np.allclose(got.T @ got, np.eye(4), atol=1e-9)


@pytest.mark.parametrize("k", [3, 500])
def test_errors_equal_the_dense_solver(spark, k):
    X = table(d=20)
    df = frame(spark, X, sparse=lambda i: i % 3 == 0).coalesce(2).persist()
    Z, *_, axes, _ = dense(X, min(k, 20))
    scores = [r["score"] for r in ReconstructionScorer(k).fit(df).transform(df).orderBy("id").select("score").collect()]
    assert np.allclose(scores, ((Z - Z @ axes @ axes.T) ** 2).mean(axis=1), atol=1e-9)


def test_wide_sparse_rows(spark):
    """3,000 features, 10 stored a row, 200 of them in one pattern: the pattern's rows lie on the axes, the others do not."""
    X = wide(260, 3000, 10, seed=4)
    X[:200] = 0.0
    X[:200, :10] = np.random.default_rng(1).normal(size=(200, 1)) * np.arange(1, 11)
    df = frame(spark, X, [0.0] * 200 + [1.0] * 60, sparse=lambda i: True).coalesce(2).persist()
    scored = ReconstructionScorer(2).fit(df).transform(df).select("label", "score").collect()
    assert max(r["score"] for r in scored if r["label"] == 0) < 1e-9 < min(r["score"] for r in scored if r["label"] == 1)
