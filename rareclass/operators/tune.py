"""Trial search (M9), evaluation (M10) and comparison.

Trials are seeded random draws from the ranges; up to ``parallelism`` trials
run at once from driver threads (each trial is its own set of Spark jobs, so
the cluster interleaves them).  Scoring and metrics stay on the executors.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .metrics import best_model, curve_metrics


@dataclass(frozen=True)
class Continuous:
    lo: float
    hi: float


@dataclass(frozen=True)
class Integer:
    lo: int
    hi: int


@dataclass(frozen=True)
class Categorical:
    values: tuple


# ---------------------------------------------------------------------------
# The reference's search ranges per tuner (M9).
RANGES: dict[str, dict[str, object]] = {
    "boosted": {
        "eta": Continuous(0.01, 0.3),
        "min_child_weight": Integer(1, 5),
        "max_depth": Integer(3, 10),
        "num_round": Integer(50, 200),
        "scale_pos_weight": Continuous(1, 20),
    },
    "logit": {
        "C": Continuous(0.01, 10.0),
        "penalty": Categorical(("l1", "l2", "elasticnet")),
        "class_weight": Categorical(("balanced", "None")),
    },
    "forest": {
        "n_estimators": Integer(50, 300),
        "max_depth": Integer(3, 15),
        "min_samples_split": Integer(2, 20),
        "min_samples_leaf": Integer(1, 10),
        "class_weight": Categorical(("balanced", "balanced_subsample")),
    },
    "kernel_svm": {
        "C": Continuous(0.01, 100.0),
        "kernel": Categorical(("linear", "rbf", "poly")),
        "gamma": Categorical(("scale", "auto")),
        "class_weight": Categorical(("balanced", "None")),
    },
    "iforest": {
        "n_estimators": Integer(50, 300),
        "max_samples": Continuous(0.1, 1.0),
        "contamination": Continuous(0.01, 0.3),
        "max_features": Continuous(0.1, 1.0),
    },
    "one_class_svm": {
        "nu": Continuous(0.01, 0.5),
        "kernel": Categorical(("linear", "rbf", "poly")),
        "gamma": Categorical(("scale", "auto")),
    },
    "knn": {
        "n_neighbors": Integer(3, 20),
        "weights": Categorical(("uniform", "distance")),
        "p": Integer(1, 2),
        "metric": Categorical(("euclidean", "manhattan", "minkowski")),
    },
    "recon_error": {
        "encoding_dim": Integer(8, 64),
    },
}
# The second range set of the boosted trees, and what the tuners maximise on the validation rows.
OTHER_RANGES: dict[str, dict[str, object]] = {
    "boosted": {
        "eta": Continuous(0.01, 0.2),
        "min_child_weight": Integer(1, 3),
        "max_depth": Integer(3, 10),
        "num_round": Integer(50, 55),
        "scale_pos_weight": Continuous(20, 22),
    },
}
OBJECTIVES = {"boosted": "pr_auc", "logit": "roc_auc", "forest": "roc_auc", "kernel_svm": "roc_auc", "iforest": "roc_auc",
              "one_class_svm": "roc_auc", "knn": "roc_auc", "recon_error": "roc_auc"}
# The solver choice (liblinear/saga) and the network's learning rate, batch size,
# epochs and dropout have no counterpart in the Spark scorers and are not drawn.
# ---------------------------------------------------------------------------


def draw(ranges: Mapping[str, object], rng: np.random.Generator) -> dict:
    out = {}
    for name, r in ranges.items():
        if isinstance(r, Continuous):
            out[name] = float(rng.uniform(r.lo, r.hi))
        elif isinstance(r, Integer):
            out[name] = int(rng.integers(r.lo, r.hi + 1))
        elif isinstance(r, Categorical):
            v = r.values[int(rng.integers(0, len(r.values)))]
            out[name] = None if v == "None" else v
        else:
            out[name] = r
    return out


def score_frame(model, df: DataFrame, id_col: str) -> DataFrame:
    """Scores from any fitted model; scorers that need the row's id take it by name."""
    return model.transform(df, id_col) if _takes_id(model.transform) else model.transform(df)


def _takes_id(function) -> bool:
    return "id_col" in inspect.signature(function).parameters


def fit_scorer(scorer, train: DataFrame, id_col: str = "id"):
    """``scorer.fit(train)``, with the id column for scorers that need it."""
    return scorer.fit(train, id_col) if _takes_id(scorer.fit) else scorer.fit(train)


def search(
    train: DataFrame,
    valid: DataFrame,
    scorer: Callable[..., object],
    ranges: Mapping[str, object],
    n_trials: int = 5,
    parallelism: int = 2,
    metric: str = "roc_auc",
    seed: int = 42,
    id_col: str = "id",
) -> tuple[DataFrame, dict]:
    """M9: run ``n_trials`` seeded draws; returns ``(trials table, best params)``.

    The best trial has the largest ``metric`` (ties: the earlier one; a trial without it counts -1); ``OBJECTIVES`` names
    each tuner's.
    """
    rng = np.random.default_rng(seed)
    params = [draw(ranges, rng) for _ in range(n_trials)]

    def run(i: int):
        p = params[i]
        model = fit_scorer(scorer(**p), train, id_col)
        scored = score_frame(model, valid, id_col)
        m = curve_metrics(scored, "label", "score").first()
        return i, p, m["roc_auc"], m["pr_auc"], m["f1"]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(inheritable_thread_target(run), range(n_trials)))
    spark: SparkSession = train.sparkSession
    key = {"roc_auc": 2, "pr_auc": 3, "f1": 4}[metric]
    best = max(results, key=lambda r: (r[key] if r[key] is not None else -1.0, -r[0]))
    rows = [(i, json.dumps(p, sort_keys=True), roc, pr, f1, i == best[0]) for i, p, roc, pr, f1 in results]
    trials = spark.createDataFrame(rows, "trial int, params string, roc_auc double, pr_auc double, f1 double, is_best boolean")
    return trials, best[1]


def evaluate(models: Mapping[str, object], test: DataFrame, id_col: str = "id") -> DataFrame:
    """Score the test rows with every model and compute all metrics in one grouped pass."""
    parts = []
    for name, model in models.items():
        s = score_frame(model, test, id_col).select(F.lit(name).alias("model"), "label", "score")
        parts.append(s)
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    m = curve_metrics(stacked, "label", "score", by="model")
    return m.select("model", "roc_auc", "pr_auc", "precision", "recall", "f1", "threshold")


def compare(metrics: DataFrame, by: str = "f1") -> tuple[DataFrame, str | None]:
    """The metrics table plus the best model's name."""
    row = best_model(metrics, by).first()
    return metrics, (row["best_model"] if row else None)
