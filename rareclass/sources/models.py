"""Fitted-model persistence (S11) and the comparison sink.

MLlib models use their own writers; the library's models are stored as a JSON
metadata row plus Parquet tables (the isolation forest's node tables), all
written by Spark so any shared file system or object store works.
"""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.ml.classification import (
    LinearSVCModel,
    LogisticRegressionModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import FeatureModel
from ..scorers.anomaly import IsolationForestModel, OneClassSVMModel, ReconstructionModel
from ..scorers.boosting import BoostedModel
from ..scorers.forest import ForestModel
from ..scorers.supervised import KernelMap, KernelSVMModel, _Fitted

_MLLIB = {
    "LogisticRegressionModel": LogisticRegressionModel,
}


def _write_meta(spark: SparkSession, path: str, meta: dict) -> None:
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "meta")
    )


def _read_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])


def save_model(model, path: str, spark: SparkSession | None = None) -> None:
    """Save any fitted model of the library (or a FeatureModel) under ``path``."""
    spark = spark or SparkSession.getActiveSession()
    if isinstance(model, FeatureModel):
        for i, (c, (table, _)) in enumerate(model.tables.items()):
            table.write.mode("overwrite").parquet(os.path.join(path, f"categories-{i}"))
        plain = {k: v for k, v in model.__dict__.items() if k != "tables"}
        _write_meta(spark, path, {"kind": "features", **plain, "wide": [[c, n] for c, (_, n) in model.tables.items()]})
    elif isinstance(model, _Fitted):
        model.model.write().overwrite().save(os.path.join(path, "mllib"))
        _write_meta(spark, path, {"kind": "mllib", "cls": type(model.model).__name__})
    elif isinstance(model, BoostedModel):
        model.frame(spark).write.mode("overwrite").parquet(os.path.join(path, "trees"))
        _write_meta(spark, path, {"kind": "boosted"})
    elif isinstance(model, ForestModel):
        model.frame(spark).write.mode("overwrite").parquet(os.path.join(path, "trees"))
        _write_meta(spark, path, {"kind": "forest"})
    elif isinstance(model, KernelSVMModel):
        model.svc.write().overwrite().save(os.path.join(path, "svc"))
        _write_meta(spark, path, {"kind": "kernel_svm", "map": model.fmap.spec(), "coef": model.coef, "icpt": model.icpt})
    elif isinstance(model, OneClassSVMModel):
        _write_meta(spark, path, {"kind": "one_class_svm", "map": model.fmap.spec(), "w": list(map(float, model.w)),
                                  "rho": model.rho, "objective": model.objective, "converged": model.converged})
    elif isinstance(model, ReconstructionModel):
        _write_meta(spark, path, {"kind": "recon", "mean": model.mean.tolist(), "scale": model.scale.tolist(),
                                  "P": model.P.tolist()})
    elif isinstance(model, IsolationForestModel):
        nodes = None
        for lvl, t in enumerate(model.levels):
            part = t.withColumn("level", F.lit(lvl))
            nodes = part if nodes is None else nodes.unionByName(part)
        nodes.write.mode("overwrite").partitionBy("level").parquet(os.path.join(path, "nodes"))
        _write_meta(spark, path, {"kind": "iforest", "level_rows": model.level_rows, "depth": model.depth,
                                  "psi": model.psi, "n_trees": model.n_trees, "threshold": model.threshold,
                                  "contamination": model.contamination})
    else:
        raise TypeError(f"cannot save {type(model).__name__}")


def load_model(spark: SparkSession, path: str):
    meta = _read_meta(spark, path)
    kind = meta.pop("kind")
    if kind == "features":
        wide = meta.pop("wide")
        tables = {c: (spark.read.parquet(os.path.join(path, f"categories-{i}")), n) for i, (c, n) in enumerate(wide)}
        return FeatureModel(**meta, tables=tables)
    if kind == "mllib":
        return _Fitted(_MLLIB[meta["cls"]].load(os.path.join(path, "mllib")))
    if kind == "boosted":
        return BoostedModel.from_frame(spark.read.parquet(os.path.join(path, "trees")))
    if kind == "forest":
        return ForestModel.from_frame(spark.read.parquet(os.path.join(path, "trees")))
    if kind == "kernel_svm":
        svc = LinearSVCModel.load(os.path.join(path, "svc"))
        return KernelSVMModel(svc, KernelMap.from_spec(meta["map"]), meta["coef"], meta["icpt"])
    if kind == "one_class_svm":
        return OneClassSVMModel(KernelMap.from_spec(meta["map"]), np.array(meta["w"]), meta["rho"], meta["objective"], meta["converged"])
    if kind == "recon":
        return ReconstructionModel(np.array(meta["mean"]), np.array(meta["scale"]), np.array(meta["P"]))
    if kind == "iforest":
        nodes = spark.read.parquet(os.path.join(path, "nodes"))
        levels = [nodes.where(F.col("level") == lvl).drop("level") for lvl in range(len(meta["level_rows"]))]
        m = IsolationForestModel(levels, meta["level_rows"], meta["depth"], meta["psi"], meta["n_trees"], None, "id",
                                 meta["contamination"])
        m._threshold = meta["threshold"]
        return m
    raise ValueError(f"unknown model kind {kind}")


def write_comparison(metrics: DataFrame, best_model: str | None, path: str) -> None:
    """``{models: {name: metrics...}, best_model}`` as one JSON document.

    The metrics table has one row per model, so the document is built by one
    aggregate (``map_from_entries``) and written by Spark.
    """
    cols = [c for c in metrics.columns if c != "model"]
    doc = metrics.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("model"), F.struct(*cols)))).alias("models")
    ).withColumn("best_model", F.lit(best_model))
    doc.coalesce(1).write.mode("overwrite").json(path)
