"""The reference's stages as Spark jobs, Parquet/JSON between them.

cleaning -> transformation -> preprocessing (exact split + features, written
partitioned by split) -> training (tune, refit, save, evaluate on test, metrics
per model) -> comparison (best model by F1).  Each stage reads what the previous
one wrote, so any stage can be re-run alone.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tune import OBJECTIVES, RANGES, compare, evaluate, fit_scorer, search
from ..scorers import SCORERS
from ..sources.io import read_metrics, read_table, write_metrics, write_table
from ..sources.models import save_model, write_comparison
from . import products as PD
from .training import fit_features


def cleaning_job(raw: DataFrame, out_path: str) -> PD.CleaningReport:
    """(a) raw listing -> cleaned Parquet (S3)."""
    cleaned, report = PD.clean_products(raw)
    write_table(cleaned, out_path)
    return report


def transformation_job(spark: SparkSession, cleaned_path: str, categories: DataFrame, out_path: str) -> None:
    """(b) cleaned Parquet + categories -> transformed Parquet."""
    write_table(PD.transform_products(read_table(spark, cleaned_path), categories), out_path)


def preprocessing_job(spark: SparkSession, transformed_path: str, out_path: str, seed: int = 13,
                      fit_on: str = "train", stratify: bool = False) -> None:
    """Exact split, features fitted on the training rows, written partitioned by split."""
    out, model = fit_features(read_table(spark, transformed_path), fit_on, seed, stratify)
    write_table(out, out_path, partition_by="split")
    save_model(model, os.path.join(out_path + "_features_model"), spark)


def training_job(spark: SparkSession, split_path: str, out_dir: str, scorers: Sequence[str] = tuple(SCORERS),
                 n_trials: int = 5, parallelism: int = 2, metric: str | None = None, seed: int = 42) -> dict[str, str]:
    """Per scorer: seeded search on train/validation (M9) for ``metric`` (by
    default the tuner's own objective), refit with the best draw, save (S11), evaluate on test (M10), write its metrics (S6).
    Returns ``{scorer: metrics path}``."""
    data = read_table(spark, split_path)
    train = data.where(F.col("split") == "train").persist()
    valid = data.where(F.col("split") == "validation").persist()
    test = data.where(F.col("split") == "test").persist()
    paths = {}
    for name in scorers:
        cls = SCORERS[name]
        trials, best = search(train, valid, cls, RANGES.get(name, {}), n_trials=n_trials, parallelism=parallelism,
                              metric=metric or OBJECTIVES.get(name, "roc_auc"), seed=seed)
        write_table(trials, os.path.join(out_dir, name, "trials"), fmt="json")
        model = fit_scorer(cls(**best), train)
        if name != "knn":  # the kNN "model" is its training table, already stored
            save_model(model, os.path.join(out_dir, name, "model"), spark)
        metrics = evaluate({name: model}, test)
        path = os.path.join(out_dir, name, "metrics")
        write_metrics(metrics, path)
        paths[name] = path
    for d in (train, valid, test):
        d.unpersist()
    return paths


def comparison_job(spark: SparkSession, metrics_paths: dict[str, str], out_path: str) -> str | None:
    """(c) read every model's metrics (missing ones are warned about and skipped),
    pick the best by F1 (M11), write ``{models, best_model}`` (S8)."""
    metrics = read_metrics(spark, metrics_paths)
    metrics, best = compare(metrics)
    write_comparison(metrics, best, out_path)
    return best


def run_all(spark: SparkSession, raw: DataFrame, categories: DataFrame, work_dir: str,
            scorers: Sequence[str] = tuple(SCORERS), n_trials: int = 5, parallelism: int = 2) -> str | None:
    """All stages in order; returns the best model's name."""
    p = lambda *a: os.path.join(work_dir, *a)
    cleaning_job(raw, p("cleaned"))
    transformation_job(spark, p("cleaned"), categories, p("transformed"))
    preprocessing_job(spark, p("transformed"), p("split"), stratify=True)
    paths = training_job(spark, p("split"), p("models"), scorers, n_trials, parallelism)
    return comparison_job(spark, paths, p("comparison"))
