"""S1 CSV path, S8 comparison sink, S11 model persistence, O2 preview, A22 history, M9 ranges."""

import json
import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def _planted(spark, n=300, n_out=10, d=5, seed=2):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T

    rng = np.random.default_rng(seed)
    X = rng.normal(0, 1, size=(n, d))
    X[:n_out] += 5.0
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("label", T.DoubleType()),
                           T.StructField("features", VectorUDT())])
    return spark.createDataFrame([(i, 1.0 if i < n_out else 0.0, Vectors.dense(X[i].tolist())) for i in range(n)], schema)


def _scores(df):
    return {r["id"]: round(r["score"], 9) for r in df.select("id", "score").collect()}


def test_cleaning_from_csv_matches_parquet_path(spark):
    """The raw listing written as CSV and read back with inference cleans to the same table."""
    from rareclass.plans import products as PD
    from rareclass.sources.io import read_table

    raw = PD.products_raw(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="rc-csv-")
    raw.write.mode("overwrite").option("header", True).csv(os.path.join(d, "raw"))
    back = read_table(spark, os.path.join(d, "raw"), fmt="csv", header=True, infer_schema=True)
    a, _ = PD.clean_products(raw)
    b, _ = PD.clean_products(back)
    key = ["asin"]
    assert a.orderBy(*key).collect() == b.orderBy(*key).collect()


def test_model_roundtrip_all_kinds(spark):
    from rareclass.operators.features import FeatureBuilder
    from rareclass.scorers import (IsolationForestScorer, KernelSVMScorer, LogitScorer, OneClassSVMScorer,
                                   ReconstructionScorer)
    from rareclass.sources.models import load_model, save_model

    df = _planted(spark)
    base = tempfile.mkdtemp(prefix="rc-models-")
    fitted = {
        "logit": LogitScorer().fit(df),
        "svm": KernelSVMScorer(n_components=32, max_iter=20).fit(df),
        "ocsvm": OneClassSVMScorer(n_components=32, max_iter=10).fit(df),
        "recon": ReconstructionScorer(2).fit(df),
    }
    for name, m in fitted.items():
        save_model(m, os.path.join(base, name), spark)
        back = load_model(spark, os.path.join(base, name))
        assert _scores(m.transform(df)) == _scores(back.transform(df)), name
    forest = IsolationForestScorer(n_estimators=5, seed=1).fit(df, "id")
    save_model(forest, os.path.join(base, "iforest"), spark)
    back = load_model(spark, os.path.join(base, "iforest"))
    assert _scores(forest.transform(df, "id")) == _scores(back.transform(df, "id"))
    fm = FeatureBuilder(["x"], ["c"]).fit(spark.createDataFrame([(1.0, "a"), (3.0, None)], "x double, c string"))
    save_model(fm, os.path.join(base, "features"), spark)
    assert load_model(spark, os.path.join(base, "features")) == fm


def test_histories(spark):
    from rareclass.scorers import LogitScorer, OneClassSVMScorer

    df = _planted(spark)
    h = OneClassSVMScorer(n_components=32, max_iter=8).fit(df).history()
    assert len(h) == 8 and all(math.isfinite(x) for x in h)
    assert len(LogitScorer().fit(df).history()) >= 1


def test_write_comparison(spark):
    from rareclass.operators.tune import compare
    from rareclass.sources.models import write_comparison

    m = spark.createDataFrame([("a", 0.6, 0.2, 0.5, 0.4, 0.44, 0.3), ("b", 0.7, 0.3, 0.6, 0.5, 0.55, 0.2)],
                              "model string, roc_auc double, pr_auc double, precision double, recall double, f1 double, threshold double")
    metrics, best = compare(m)
    assert best == "b"
    d = os.path.join(tempfile.mkdtemp(prefix="rc-cmp-"), "cmp")
    write_comparison(metrics, best, d)
    files = [f for f in os.listdir(d) if f.endswith(".json")]
    doc = json.loads(open(os.path.join(d, files[0])).read())
    assert doc["best_model"] == "b" and set(doc["models"]) == {"a", "b"} and doc["models"]["b"]["f1"] == 0.55


def test_preview_is_ordered(spark):
    from rareclass.operators.profile import preview

    df = spark.range(100).select(((F.col("id") * 37) % 100).alias("x"))
    assert [r["x"] for r in preview(df, 5).collect()] == [0, 1, 2, 3, 4]


def test_every_tuner_accepts_its_ranges():
    import numpy as np

    from rareclass.operators.tune import RANGES, draw
    from rareclass.scorers import SCORERS

    rng = np.random.default_rng(42)
    for name, ranges in RANGES.items():
        SCORERS[name](**draw(ranges, rng))


def test_knn_scorer_contract(spark):
    from rareclass.operators.metrics import roc_auc
    from rareclass.scorers import KNNScorer

    df = _planted(spark)
    s = KNNScorer(n_neighbors=5).fit(df).transform(df)
    assert roc_auc(s, "label", "score") > 0.95
