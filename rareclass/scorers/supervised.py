"""Supervised rare-class scorers (M1-M4), on MLlib but for the trees - fit and scoring run on executors.

Common contract: ``Scorer(**params).fit(train)`` -> model with
``transform(df) -> df + score`` (higher = more likely positive).  Input frames
carry ``label`` (0/1 double) and ``features`` (vector).  Balanced class
weights (A17) are attached as a ``weight`` column.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.metrics import counted_class_weights
from ..operators.order import broadcast_if_small
from .boosting import BoostedModel, fit_boosted
from .forest import ForestModel, fit_forest
from .rows import fewer_tasks, stored, vector_width
from .sketch import TensorSketch

SCORE = "score"


def weighted(df: DataFrame, class_weight: str | None, label: str = "label") -> tuple[DataFrame, float]:
    """Attach ``weight`` (balanced, or 1.0) and return the total weight."""
    if class_weight in ("balanced", "balanced_subsample"):
        w, k = counted_class_weights(df, label)
        out = df.join(broadcast_if_small(w.select(label, "weight"), k), on=label, how="left")  # k counted classes
    else:
        out = df.withColumn("weight", F.lit(1.0))
    total = out.agg(F.sum("weight").alias("w")).first()["w"] or 0.0
    return out, float(total)


def positive_probability(col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col))[1]


class _Fitted:
    """A fitted MLlib classifier whose positive-class probability is the score."""

    def __init__(self, model, score_fn=None, prepare=None):
        self.model = model
        self._score = score_fn or positive_probability
        self._prepare = prepare

    def history(self):
        """Objective per iteration when MLlib keeps it (logistic regression)."""
        return list(self.model.summary.objectiveHistory) if getattr(self.model, "hasSummary", False) else []

    def transform(self, df: DataFrame) -> DataFrame:
        x = self._prepare(df) if self._prepare else df
        out = self.model.transform(x)
        keep = [c for c in df.columns]
        return out.select(*keep, self._score().alias(SCORE))


class LogitScorer:
    """M1: logistic regression; sklearn ``C`` -> ``regParam = 1 / (C * sum(w))``.

    ``penalty``: l2 (``elasticNetParam`` 0), l1 (1) or elasticnet (``l1_ratio``).
    """

    def __init__(self, C: float = 1.0, penalty: str = "l2", class_weight: str | None = "balanced",
                 max_iter: int = 1000, l1_ratio: float = 0.5):
        self.C, self.penalty, self.class_weight, self.max_iter, self.l1_ratio = C, penalty, class_weight, max_iter, l1_ratio

    def fit(self, train: DataFrame) -> _Fitted:
        df, wsum = weighted(train, self.class_weight)
        size = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(stored("features")["values"])).alias("stored")).first()
        df = fewer_tasks(df, size["n"], 32 + 12 * max(0, size["stored"] or 0))  # every iteration is a job
        alpha = {"l2": 0.0, "l1": 1.0, "elasticnet": self.l1_ratio}.get(self.penalty, 0.0)
        lr = LogisticRegression(
            weightCol="weight", regParam=1.0 / (self.C * max(wsum, 1e-12)), elasticNetParam=alpha,
            standardization=False, maxIter=self.max_iter, family="binomial",
        )
        return _Fitted(lr.fit(df), positive_probability)


class ForestScorer:
    """M2: random forest (:mod:`forest`).  ``max_depth=None`` grows until leaves are pure; a node of fewer than
    ``min_samples_split`` rows is a leaf; ``class_weight`` is ``balanced`` (over the table), ``balanced_subsample`` (over each
    tree's sample) or None."""

    def __init__(self, n_estimators: int = 100, max_depth: int | None = None, min_samples_split: int = 2,
                 min_samples_leaf: int = 1, class_weight: str | None = "balanced", seed: int = 42, max_bins: int = 256):
        self.n, self.depth, self.split, self.leaf, self.cw, self.seed, self.max_bins = (
            n_estimators, max_depth, min_samples_split, min_samples_leaf, class_weight, seed, max_bins)

    def fit(self, train: DataFrame) -> ForestModel:
        return fit_forest(train, self.n, self.depth, self.split, self.leaf, self.cw, self.seed, self.max_bins)


class BoostedScorer:
    """M3: second-order boosted trees (:mod:`boosting`); positives weigh ``scale_pos_weight``, a child's Hessians add up to
    ``min_child_weight`` at least.  Every row and component takes part, so there is no draw: ``seed`` changes nothing."""

    def __init__(self, eta: float = 0.01, min_child_weight: float = 5, max_depth: int = 5, num_round: int = 250,
                 scale_pos_weight: float = 10, seed: int = 42, reg_lambda: float = 1.0, max_bins: int = 256):
        self.eta, self.mcw, self.depth, self.rounds, self.spw, self.seed, self.reg_lambda, self.max_bins = (
            eta, min_child_weight, max_depth, num_round, scale_pos_weight, seed, reg_lambda, max_bins)

    def fit(self, train: DataFrame) -> BoostedModel:
        return fit_boosted(train, self.eta, self.mcw, self.depth, self.rounds, self.spw, self.reg_lambda, self.max_bins)


def gamma_value(train: DataFrame, gamma: str | float, features: str = "features") -> tuple[float, int]:
    """sklearn's ``gamma='scale'`` = 1 / (d * var(X)) over all entries; ``'auto'`` = 1 / d."""
    values = stored(features)["values"]  # components that a sparse vector does not store are zero
    row = train.select(
        vector_width(features).alias("d"),
        F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("s"),
        F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x).alias("ss"),
    ).agg(F.max("d").alias("d"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.count(F.lit(1)).alias("n")).first()
    d = int(row["d"] or 1)
    if isinstance(gamma, (int, float)):
        return float(gamma), d
    if gamma == "auto":
        return 1.0 / d, d
    m = (row["n"] or 1) * d
    mean = (row["s"] or 0.0) / m
    var = (row["ss"] or 0.0) / m - mean * mean
    return (1.0 / (d * var) if var > 0 else 1.0), d


class FourierFeatures:
    """Random Fourier features for the RBF kernel (Rahimi & Recht 2007):
    ``z(x) = sqrt(2/D) cos(W x + b)``, ``W ~ N(0, 2 gamma)``, ``b ~ U(0, 2 pi)``.

    A vectorised Arrow UDF; ``W`` (``D x d``) travels in the closure.
    """

    def __init__(self, d: int, gamma: float, n_components: int = 256, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, d))
        self.b = rng.uniform(0.0, 2 * math.pi, size=n_components)
        self.D = n_components

    def transform(self, df: DataFrame, features: str = "features", out: str = "rff") -> DataFrame:
        W, b, D = self.W, self.b, self.D

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def rff(v: pd.Series) -> pd.Series:
            if len(v) == 0:
                return pd.Series([], dtype=object)
            X = np.stack([np.asarray(a, dtype=np.float64) for a in v.to_numpy()])
            Z = math.sqrt(2.0 / D) * np.cos(X @ W.T + b)
            return pd.Series(list(Z))

        return df.withColumn(out, array_to_vector(rff(vector_to_array(F.col(features)))))


class KernelMap:
    """Feature map for M4/M7: identity (linear), random Fourier features (rbf), TensorSketch (poly).  Fully described by
    :meth:`spec`, so a saved model rebuilds the same map (the draws come from the seed)."""

    def __init__(self, kernel: str, gamma: float | None = None, d: int | None = None, n_components: int = 256,
                 degree: int = 3, seed: int = 42, coef0: float = 0.0):
        self.kernel, self.gamma, self.d, self.D, self.degree, self.seed, self.coef0 = kernel, gamma, d, n_components, degree, seed, coef0
        self._map = None
        if kernel == "rbf":
            self._map = FourierFeatures(d, gamma, n_components, seed)
        elif kernel == "poly":
            self._map = TensorSketch(d, gamma, coef0, degree, n_components, seed)

    def __call__(self, df: DataFrame) -> DataFrame:
        if self._map is None:
            return df.withColumn("kfeat", F.col("features"))
        return self._map.transform(df, out="kfeat")

    def spec(self) -> dict:
        return {"kernel": self.kernel, "gamma": self.gamma, "d": self.d, "n_components": self.D,
                "degree": self.degree, "seed": self.seed, "coef0": self.coef0}

    @classmethod
    def from_spec(cls, spec: dict) -> "KernelMap":
        return cls(**spec)


def kernel_map(train: DataFrame, kernel: str, gamma: str | float, n_components: int, degree: int, seed: int, coef0: float = 0.0,
               sketch_size: int = 1024) -> KernelMap:
    """The map of a kernel, with gamma from the training rows.  ``n_components`` is the width for rbf, ``sketch_size``
    that for poly."""
    if kernel == "linear":
        return KernelMap(kernel, None, None, n_components, degree, seed)
    g, d = gamma_value(train, gamma)
    return KernelMap(kernel, g, d, sketch_size if kernel == "poly" else n_components, degree, seed, coef0)


class KernelSVMModel:
    """Fitted M4: linear SVM on the feature map + Platt coefficients."""

    def __init__(self, svc, fmap: KernelMap, coef: float, icpt: float):
        self.svc, self.fmap, self.coef, self.icpt = svc, fmap, coef, icpt

    def transform(self, df: DataFrame) -> DataFrame:
        m = vector_to_array("rawPrediction")[1]
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.coef) * m + F.lit(self.icpt))))
        return self.svc.transform(self.fmap(df)).select(*df.columns, p.alias(SCORE))


class KernelSVMScorer:
    """M4: kernel SVM as a linear SVM on an explicit feature map, with Platt
    scaling (a one-feature logistic fit on the margin) for probabilities."""

    def __init__(self, C: float = 1.0, kernel: str = "rbf", gamma: str | float = "scale", class_weight: str | None = "balanced",
                 n_components: int = 256, degree: int = 3, max_iter: int = 100, seed: int = 42, coef0: float = 0.0, sketch_size: int = 1024):
        self.C, self.kernel, self.gamma, self.cw, self.coef0, self.sketch = C, kernel, gamma, class_weight, coef0, sketch_size
        self.D, self.degree, self.max_iter, self.seed = n_components, degree, max_iter, seed

    def fit(self, train: DataFrame) -> _Fitted:
        fmap = kernel_map(train, self.kernel, self.gamma, self.D, self.degree, self.seed, self.coef0, self.sketch)
        df, wsum = weighted(train, self.cw)
        size = df.agg(F.count(F.lit(1)).alias("n"), F.max(vector_width("features")).alias("d")).first()
        width = {"rbf": self.D, "poly": self.sketch}.get(self.kernel, size["d"] or 0)
        mapped = fmap(fewer_tasks(df, size["n"], 32 + 8 * width))  # every iteration is a job
        svc = LinearSVC(featuresCol="kfeat", weightCol="weight", regParam=1.0 / (self.C * max(wsum, 1e-12)),
                        maxIter=self.max_iter, standardization=False).fit(mapped)
        margin = svc.transform(mapped).select("label", "weight", vector_to_array("rawPrediction")[1].alias("m"))
        platt_in = VectorAssembler(inputCols=["m"], outputCol="pf").transform(margin)
        platt = LogisticRegression(featuresCol="pf", weightCol="weight", regParam=0.0, maxIter=100).fit(platt_in)
        coef, icpt = float(platt.coefficients[0]), float(platt.intercept)
        return KernelSVMModel(svc, fmap, coef, icpt)
