"""Permutation importance against plain Python, and the search's objective."""

import hashlib
import statistics

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_kernels import frame

from rareclass.operators.importance import dealt_pairs, permutation_importance
from rareclass.operators.tune import Categorical, search


class Linear:
    """Scores by fixed weights."""

    def __init__(self, sign: float = 1.0):
        self.w = [sign, 0.5, 0.0]

    def fit(self, train):
        return self

    def transform(self, df):
        return df.withColumn("score", F.aggregate(F.zip_with(vector_to_array("features"), F.array(*map(F.lit, self.w)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))


def auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return float(((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None])).mean())


def table(n=80):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(n, 3)).round(1)
    return X, (X[:, 0] + 0.3 * rng.normal(size=n) > 0.5).astype(float)


def order(n, seed):
    return sorted(range(n), key=lambda i: hashlib.md5(f"{i}#{seed}".encode()).hexdigest())


@pytest.mark.parametrize("repeats", [1, 2])
def test_importance_against_plain_python(spark, repeats):
    X, y = table()
    model = Linear()
    got = {r["feature"]: r for r in permutation_importance(model, frame(spark, X, y).repartition(3), repeats=repeats, seed=7).collect()}
    assert sorted(got) == [0, 1, 2]
    for j, r in got.items():
        values = []
        for k in range(repeats):
            P = X.copy()
            P[order(80, 7 + 2 * k), j] = X[order(80, 8 + 2 * k), j]
            values.append(auc(P @ np.array(model.w), y))
        assert r["baseline"] == pytest.approx(auc(X @ np.array(model.w), y)) and r["permuted"] == pytest.approx(np.mean(values))
        assert r["std"] == (pytest.approx(statistics.stdev(values)) if repeats > 1 else None)
    assert got[2]["importance"] == 0 and got[0]["importance"] > got[1]["importance"]


def test_every_row_gives_its_vector_once(spark):
    X, y = table()
    base = frame(spark, X, y).select("id", "label", vector_to_array("features").alias("x"))
    rows = dealt_pairs(base, "id", 5).collect()
    assert sorted(tuple(r["donor"]) for r in rows) == sorted(map(tuple, X.tolist())) == sorted(tuple(r["x"]) for r in rows)
    assert sum(r["x"] != r["donor"] for r in rows) > 70


def test_chosen_features_and_no_rows(spark):
    X, y = table(20)
    df = frame(spark, X, y)
    assert [r["feature"] for r in permutation_importance(Linear(), df, features=[1]).collect()] == [1]
    assert permutation_importance(Linear(), df.where("id < 0")).count() == 0


def test_search_follows_its_objective(spark):
    X, y = table()
    df = frame(spark, X, y).coalesce(1).persist()
    for metric in ("roc_auc", "pr_auc", "f1"):
        trials, best = search(df, df, Linear, {"sign": Categorical((-1.0, 0.1, 1.0))}, n_trials=4, metric=metric, seed=1)
        rows = trials.collect()
        assert [r["is_best"] for r in rows].count(True) == 1
        assert max(r[metric] for r in rows) == next(r[metric] for r in rows if r["is_best"]) and best["sign"] != -1.0
