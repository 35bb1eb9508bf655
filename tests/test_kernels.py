"""TensorSketch, L-BFGS and the one-class and kernel SVM on wide and sparse features."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rareclass.operators.tune import RANGES, draw
from rareclass.scorers import KernelSVMScorer, OneClassSVMScorer
from rareclass.scorers.lbfgs import minimise
from rareclass.scorers.rows import Rows, stored, vector_width
from rareclass.scorers.sketch import TensorSketch
from rareclass.scorers.supervised import KernelMap, gamma_value

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])


def frame(spark, X, labels=None, sparse=lambda i: False):
    def vector(i, x):
        return Vectors.sparse(len(x), {int(j): float(x[j]) for j in np.flatnonzero(x)}) if sparse(i) else Vectors.dense(x.tolist())

    return spark.createDataFrame([(i, float(labels[i]) if labels is not None else 0.0, vector(i, x)) for i, x in enumerate(X)], SCHEMA)


def wide(n, d, stored_each, seed=0):
    rng = np.random.default_rng(seed)
    X = np.zeros((n, d))
    for x in X:
        x[rng.choice(d, stored_each, replace=False)] = rng.normal(size=stored_each)
    return X


def batch(spark, X, sparse):
    got = frame(spark, X, sparse=sparse).orderBy("id").select(stored("features").alias("u")).toArrow()
    return got.column("u").combine_chunks()


@pytest.mark.parametrize("sparse", [lambda i: False, lambda i: True, lambda i: i % 3 == 0])
def test_rows_of_any_kind(spark, sparse):
    X = wide(50, 30, 6)
    X[7] = 0.0
    rows = Rows(batch(spark, X, sparse), 30)
    w, W, s = np.arange(30.0), np.arange(90.0).reshape(30, 3), np.linspace(-1, 1, 50)
    assert np.allclose(rows.dot(w), X @ w) and np.allclose(rows.dot(W), X @ W)
    assert np.allclose(rows.weighted_sum(s), s @ X) and np.allclose(rows.weighted_sum(np.stack([s, 2 * s], 1)), X.T @ np.stack([s, 2 * s], 1))
    assert np.allclose(rows.row_sums(lambda i, a: a * a * i), (X * X) @ np.arange(30))
    df = frame(spark, X, sparse=sparse)
    assert {r["w"] for r in df.select(vector_width("features").alias("w")).collect()} == {30}
    assert gamma_value(df, "scale")[0] == pytest.approx(1 / (30 * X.var())) and gamma_value(df, "auto") == (1 / 30, 30)


@pytest.mark.parametrize("coef0", [0.0, 1.0])
def test_sketch_is_near_the_kernel_and_its_error_falls(spark, coef0):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(60, 64))
    gamma = 1 / 64
    K = (gamma * X @ X.T + coef0) ** 3
    scale = (gamma * (X * X).sum(axis=1) + coef0) ** 1.5
    rows = Rows(batch(spark, X, lambda i: i % 2 == 0), 64)
    errors = []
    for D in (256, 1024, 8192):
        Z = TensorSketch(64, gamma, coef0, 3, D).map(rows)
        errors.append(math.sqrt((((Z @ Z.T - K) / np.outer(scale, scale)) ** 2).mean()))
    assert errors[0] > errors[1] > errors[2] and errors[1] < 0.08 and errors[2] < 0.03
    assert np.mean([TensorSketch(64, gamma, coef0, 3, 256, s).map(rows)[0] @ TensorSketch(64, gamma, coef0, 3, 256, s).map(rows)[1]
                    for s in range(200)]) == pytest.approx(K[0, 1], abs=0.05 * scale[0] * scale[1])


def test_degree_one_keeps_products_of_few_components(spark):
    """One stored component each: a count sketch of degree 1 gives the products exactly."""
    X = np.eye(5) * 3
    Z = TensorSketch(5, 1.0, 0.0, 1, 4096).map(Rows(batch(spark, X, lambda i: True), 5))
    assert np.allclose(Z @ Z.T, X @ X.T)


def test_poly_map_has_a_fixed_width_on_wide_sparse_rows(spark):
    X = wide(40, 2000, 12)
    fmap = KernelMap("poly", 1 / 2000, 2000, 1024)
    got = fmap(frame(spark, X, sparse=lambda i: True)).select(vector_width("kfeat").alias("w")).distinct().collect()
    assert [r["w"] for r in got] == [1024]
    again = KernelMap.from_spec(fmap.spec())
    assert again.spec() == fmap.spec() and (again._map.signs == fmap._map.signs).all()


def dense_bfgs(value, start, tol, rounds=2000):
    """Plain BFGS with a dense inverse Hessian."""
    x, H = start, np.eye(len(start))
    f, g = value(x)
    for _ in range(rounds):
        if np.abs(g).max() <= tol:
            break
        p = -H @ g
        t = 1.0
        while value(x + t * p)[0] > f + 1e-4 * t * (g @ p) and t > 1e-12:
            t /= 2
        f2, g2 = value(x + t * p)
        s, y = t * p, g2 - g
        if s @ y > 1e-14:
            r = 1 / (s @ y)
            left = np.eye(len(x)) - r * np.outer(s, y)
            H = left @ H @ left.T + r * np.outer(s, s)
        x, f, g = x + s, f2, g2
    return f


def test_lbfgs_on_known_functions():
    A = np.diag(np.logspace(0, 4, 30))
    b = np.arange(30.0)
    best = minimise(lambda x: (0.5 * x @ A @ x - b @ x, A @ x - b), np.zeros(30), 1e-6, 2000)
    assert best.converged and np.allclose(best.point, b / np.diag(A), atol=1e-5)

    def valley(x):
        return ((1 - x[0]) ** 2 + 100 * (x[1] - x[0] ** 2) ** 2,
                np.array([-2 * (1 - x[0]) - 400 * x[0] * (x[1] - x[0] ** 2), 200 * (x[1] - x[0] ** 2)]))

    best = minimise(valley, np.array([-1.2, 1.0]), 1e-6, 500)
    assert best.converged and np.allclose(best.point, 1, atol=1e-4)
    assert all(a >= b - 1e-12 for a, b in zip(best.objective, best.objective[1:]))


def one_class_objective(Z, nu, corner=1e-2):
    def value(p):
        u = p[-1] - Z @ p[:-1]
        slope = np.clip(u / corner, 0, 1)
        hinge = np.where(u >= corner, u - corner / 2, np.where(u > 0, u * u / (2 * corner), 0)).sum()
        c = 1 / (nu * len(Z))
        return 0.5 * p[:-1] @ p[:-1] + c * hinge - p[-1], np.append(p[:-1] - c * slope @ Z, c * slope.sum() - 1)

    return value


@pytest.mark.parametrize("kernel", ["rbf", "poly", "linear"])
def test_one_class_svm_reaches_the_dense_solver_s_objective(spark, kernel):
    X = np.random.default_rng(1).normal(size=(200, 8)) + 1.0
    df = frame(spark, X, sparse=lambda i: i % 2 == 1)
    model = OneClassSVMScorer(nu=0.2, kernel=kernel, n_components=64, sketch_size=64, tol=1e-5).fit(df)
    Z = np.stack([r["kfeat"].toArray() for r in model.fmap(df).orderBy("id").select("kfeat").collect()])
    value = one_class_objective(Z, 0.2)
    assert model.converged and value(np.append(model.w, model.rho))[0] == pytest.approx(dense_bfgs(value, np.zeros(Z.shape[1] + 1), 1e-6), abs=1e-4)
    scores = [r["score"] for r in model.transform(df).orderBy("id").select("score").collect()]
    assert np.allclose(scores, model.rho - Z @ model.w)
    assert np.clip(np.array(scores) / 1e-2, 0, 1).mean() == pytest.approx(0.2, abs=1e-4)  # nu: the share of rows outside


def test_poly_on_many_sparse_features(spark):
    """2,000 features, 12 stored a row: rows far from the others' span score higher; no array of the expansion's width."""
    X = wide(240, 2000, 12)
    X[:, 0] = 1.0
    X[:12, 0] = 0.0
    labels = [1.0] * 12 + [0.0] * 228
    df = frame(spark, X, labels, sparse=lambda i: True)
    scored = OneClassSVMScorer(kernel="poly", nu=0.1).fit(df).transform(df).select("label", "score").collect()
    by = {y: [r["score"] for r in scored if r["label"] == y] for y in (0.0, 1.0)}
    assert np.median(by[1.0]) > np.quantile(by[0.0], 0.9)


@pytest.mark.filterwarnings("ignore:one-class SVM stopped")
@pytest.mark.parametrize("name,scorer", [("one_class_svm", OneClassSVMScorer), ("kernel_svm", KernelSVMScorer)])
def test_drawn_parameters_fit_on_64_features(spark, name, scorer):
    """The parameter sets that the tuner draws (poly among them) are fitted for real."""
    rng = np.random.default_rng(42)
    X = np.random.default_rng(5).normal(size=(120, 64))
    X[:10] += 1.5
    df = frame(spark, X, [1.0] * 10 + [0.0] * 110).coalesce(1).persist()
    drawn = [draw(RANGES[name], rng) for _ in range(5)]
    assert "poly" in {p["kernel"] for p in drawn}
    if name == "kernel_svm":  # one set for each kernel: its solver is the machine library's
        drawn = list({p["kernel"]: p for p in drawn}.values())
    for p in drawn:
        scores = [r["score"] for r in scorer(**p, max_iter=60 if name == "one_class_svm" else 15).fit(df).transform(df).select("score").collect()]
        assert len(scores) == 120 and np.isfinite(scores).all()


def test_iterations_over_little_data_are_short_jobs(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from rareclass.scorers import KernelSVMScorer, LogitScorer

    df = spark.range(0, 400, 1, 24).select(
        "id", (F.col("id") % 5 == 0).cast("double").alias("label"),
        array_to_vector(F.array(F.sin("id"), F.cos(F.col("id") * 3), F.col("id") % 7.0)).alias("features"))
    tracker = spark.sparkContext.statusTracker()
    for name, scorer in (("logit", LogitScorer()), ("svm", KernelSVMScorer(kernel="linear"))):
        spark.sparkContext.setJobGroup(f"short-{name}", "")
        scorer.fit(df)
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"short-{name}") for s in tracker.getJobInfo(j).stageIds]
        tasks = [s.numTasks for s in stages if s and s.name.startswith("treeAggregate")]
        spark.sparkContext.setJobGroup("rest", "")
        assert len(tasks) > 5 and set(tasks) == {1}
