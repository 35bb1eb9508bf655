import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rareclass.operators.features import FeatureBuilder


def test_feature_builder_median_std_onehot(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (5.0, "a"), (None, None)], "x double, c string")
    model = FeatureBuilder(["x"], ["c"]).fit(train)
    assert model.medians["x"] == 3.0
    assert model.categories["c"] == ["a", "b", "missing"]
    test = spark.createDataFrame([(3.0, "zz"), (None, "a")], "x double, c string")
    rows = [r["f"] for r in model.transform(test).select(vector_to_array("features").alias("f")).collect()]
    mean = 3.0
    std = math.sqrt(((1 - 3) ** 2 + 0 + (5 - 3) ** 2 + 0) / 4)  # population std of imputed {1,3,5,3}
    assert rows[0] == [(3.0 - mean) / std, 0.0, 0.0, 0.0]  # unseen category -> all zeros
    assert rows[1] == [(3.0 - mean) / std, 1.0, 0.0, 0.0]


def test_population_std_and_interpolated_median(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "x double")
    m = FeatureBuilder(["x"]).fit(df)
    assert math.isclose(m.scales["x"], math.sqrt(8 / 3))
    df2 = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert FeatureBuilder(["x"]).fit(df2).medians["x"] == 2.5


def knn_brute_force(train, queries, k, p, weights="uniform"):
    """Exact vote by all distances, on the driver, for small fixtures only."""
    tr = [(r["id"], np.array(r["vec"], float), r["label"]) for r in train.collect()]
    out = {}
    for r in queries.collect():
        q = np.array(r["vec"], float)
        near = sorted((float((np.abs(v - q) ** p).sum()), i, y) for i, v, y in tr)[:k]
        if weights == "distance":
            zero = [y == 1 for d, _, y in near if d == 0]
            w = [1 / d ** (1 / p) for d, _, _ in near] if not zero else []
            out[r["id"]] = sum(zero) / len(zero) if zero else sum(x for x, (_, _, y) in zip(w, near) if y == 1) / sum(w)
        else:
            out[r["id"]] = sum(y == 1 for *_, y in near) / len(near)
    return out


@pytest.mark.parametrize("p,weights,query_bytes", [(2, "uniform", 8 << 20), (1, "distance", 8 << 20), (2, "distance", 2_000), (3, "uniform", 8 << 20)])
def test_knn_vote_matches_brute_force(spark, p, weights, query_bytes):
    from rareclass.scorers.knn import knn_vote

    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    e = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), (F.col("label") == 0).cast("int").alias("label"))
    train = e.where(F.pmod(F.xxhash64("id"), F.lit(4)) != 0).repartition(5)
    qs = e.where(F.pmod(F.xxhash64("id"), F.lit(4)) != 1)  # some queries are training rows: distance zero
    got = {r["id"]: r["score"] for r in knn_vote(train, qs, k=5, p=p, weights=weights, query_bytes=query_bytes).collect()}
    want = knn_brute_force(train, qs, 5, p, weights)
    assert set(got) == set(want) and all(math.isclose(got[i], want[i]) for i in got)


def test_knn_manhattan_search_is_fast_and_exact():
    """Single precision only preselects: distances that differ in the tenth digit keep their order, a vector of NaN hides no other."""
    import time

    from rareclass.scorers.knn import NearestRows

    rng = np.random.default_rng(1)
    rows = 1000.0 + rng.normal(size=(8192, 64)).round(1)
    rows[:40] = rows[50] + np.arange(40)[:, None] * 1e-9
    rows[60] = np.nan
    queries = np.vstack([rows[:30], rows[100:2100]])
    best = NearestRows(queries, 5, 1)
    t = time.perf_counter()
    best.add(rows, np.arange(8192), np.ones(8192))
    assert time.perf_counter() - t < 6  # one pair took 531 ns when every tile was merged into all queries
    for q in (0, 7, 29, 30, 1500):
        d = np.abs(rows - queries[q]).sum(axis=1)
        d = np.where(np.isnan(d), np.inf, d)
        want = np.lexsort((np.arange(8192), d))[:5]
        assert np.allclose(best.dp[best.query == q], d[want], rtol=1e-9, atol=1e-12) and set(best.id[best.query == q]) == set(want.tolist())


def test_knn_memory_and_rows_are_bounded():
    """A task keeps k rows a query, and its matrices stay below a fixed number of cells; ties go to the smaller id."""
    import tracemalloc

    from rareclass.scorers.knn import MATRIX_CELLS, NearestRows

    rng = np.random.default_rng(0)
    best = NearestRows(rng.normal(size=(500, 16)), 5, 2)
    ids = np.arange(20_000)
    rows = rng.normal(size=(20_000, 16))
    rows[1000:1400] = rows[0]
    tracemalloc.start()
    for at in range(0, 20_000, 4000):
        best.add(rows[at:at + 4000], ids[at:at + 4000].astype(object), np.ones(4000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(best.query) == 500 * 5 and peak < 8 * 8 * MATRIX_CELLS
    for q in (0, 17):
        d = ((rows - best.queries[q]) ** 2).sum(axis=1)
        assert best.id[best.query == q].tolist() == np.lexsort((ids, d))[:5].tolist()


def _planted(spark, n=400, n_out=12, d=6, seed=1):
    rng = np.random.default_rng(seed)
    X = rng.normal(0, 1, size=(n, d))
    X[:n_out] += 6.0
    y = [1.0] * n_out + [0.0] * (n - n_out)
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("label", T.DoubleType()),
                           T.StructField("features", VectorUDT())])
    return spark.createDataFrame([(i, y[i], Vectors.dense(X[i].tolist())) for i in range(n)], schema)


def test_isolation_forest_finds_planted_outliers(spark):
    from rareclass.operators.metrics import roc_auc
    from rareclass.scorers import IsolationForestScorer

    df = _planted(spark)
    model = IsolationForestScorer(n_estimators=20, seed=3).fit(df, "id")
    scored = model.transform(df, "id")
    assert roc_auc(scored, "label", "score") > 0.95
    again = IsolationForestScorer(n_estimators=20, seed=3).fit(df, "id").transform(df, "id")
    a = {r["id"]: r["score"] for r in scored.collect()}
    b = {r["id"]: r["score"] for r in again.collect()}
    assert a == b  # same seed, same scores


def test_isolation_forest_finds_the_one_varying_feature(spark):
    """60 constant features and one that varies: every node still splits on it."""
    from pyspark.ml.linalg import Vectors

    from rareclass.scorers import IsolationForestScorer

    rng = np.random.default_rng(0)
    rows = [(i, 0.0, Vectors.dense([1.0] * 30 + [float(x)] + [0.0] * 30)) for i, x in enumerate(rng.normal(size=200))]
    rows.append((999, 0.0, Vectors.dense([1.0] * 30 + [50.0] + [0.0] * 30)))
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    model = IsolationForestScorer(n_estimators=10, seed=1).fit(df, "id")
    assert len(model.levels) > 4
    scored = sorted(model.transform(df, "id").collect(), key=lambda r: -r["score"])
    assert scored[0]["id"] == 999


def test_isolation_forest_in_steps_and_reloaded(spark, tmp_path):
    """Node tables cut into many steps score like one table; a stored model keeps threshold and contamination."""
    from rareclass.scorers import IsolationForestScorer
    from rareclass.sources.models import load_model, save_model

    df = _planted(spark, n=150)
    whole = IsolationForestScorer(n_estimators=8, max_samples=0.7, contamination=0.2, seed=3).fit(df, "id")
    parts = IsolationForestScorer(n_estimators=8, max_samples=0.7, contamination=0.2, seed=3, node_chunk=40).fit(df, "id")
    a = {r["id"]: r["score"] for r in whole.transform(df, "id").collect()}
    b = {r["id"]: r["score"] for r in parts.transform(df, "id").collect()}
    assert set(a) == set(b) and all(math.isclose(a[i], b[i]) for i in a)
    save_model(whole, str(tmp_path / "forest"), spark)
    again = load_model(spark, str(tmp_path / "forest"))
    assert again.threshold == whole.threshold is not None and again.contamination == 0.2
    assert {r["id"]: r["score"] for r in again.transform(df, "id").collect()} == a


def test_node_tables_wider_than_a_step_stay_off_the_driver(spark, monkeypatch):
    """Levels wider than a step are joined, whatever ids repeat; the driver reads one step at most, and scores stay equal."""
    from rareclass.scorers import IsolationForestScorer, anomaly

    df = _planted(spark, n=150).withColumn("id", F.col("id") % 40)
    df = df.withColumn("row", F.monotonically_increasing_id()).persist()
    whole = IsolationForestScorer(n_estimators=8, seed=3).fit(df, "row")
    a = {r["row"]: r["score"] for r in whole.transform(df, "id").collect()}
    read, plain = [], anomaly._read_tables

    def counted(*args):
        out = plain(*args)
        read.append(sum(len(t[1]) for t in out))
        return out

    monkeypatch.setattr(anomaly, "_read_tables", counted)
    parts = IsolationForestScorer(n_estimators=8, seed=3, node_chunk=100).fit(df, "row")
    b = {r["row"]: r["score"] for r in parts.transform(df, "id").collect()}
    assert max(parts.level_rows) > 100 and sum(read) < sum(parts.level_rows) and max(read) <= 100
    assert set(a) == set(b) and all(math.isclose(a[i], b[i]) for i in a)


def test_recon_and_ocsvm_find_planted_outliers(spark):
    from rareclass.operators.metrics import roc_auc
    from rareclass.scorers import OneClassSVMScorer, ReconstructionScorer

    df = _planted(spark)
    assert roc_auc(ReconstructionScorer(2).fit(df).transform(df), "label", "score") > 0.9
    model = OneClassSVMScorer(kernel="rbf", n_components=64).fit(df)
    assert roc_auc(model.transform(df), "label", "score") > 0.9
    # settled: the objective falls throughout and hardly moves at the end
    h = model.history()
    assert model.converged and all(y <= x + 1e-12 for x, y in zip(h, h[1:]))
    assert abs(h[-1] - h[-2]) < 1e-3 * max(1e-3, abs(h[-1])) + 1e-5
    # nu bounds the share of normal rows outside
    outside = model.transform(df).where("label = 0 and score > 0").count() / df.where("label = 0").count()
    assert 0.03 < outside < 0.2


def test_logit_learns(spark):
    from rareclass.operators.metrics import roc_auc
    from rareclass.scorers import LogitScorer

    df = _planted(spark)
    assert roc_auc(LogitScorer().fit(df).transform(df), "label", "score") > 0.95


def test_categories_beyond_any_literal(spark):
    """120,000 categories go through the joined index table and a sparse block; a small limit gives the same vectors."""
    wide = spark.range(120_000).select(F.col("id"), F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"), (F.col("id") % 7).cast("string").alias("d"))
    model = FeatureBuilder([], ["c", "d"]).fit(wide)
    assert model.width("c") == 120_000 and "c" in model.tables and model.categories["d"] == [str(i) for i in range(7)]
    probe = spark.createDataFrame([(1, "v000123", "3"), (2, "unseen", None), (3, "v119999", "6")], "id long, c string, d string")
    rows = {r["id"]: r["features"] for r in model.transform(probe, keep=["id"]).collect()}
    assert rows[1].size == 120_007 and rows[1].indices.tolist() == [123, 120_003]
    assert rows[2].numNonzeros() == 0 and rows[3].indices.tolist() == [119_999, 120_006]
    few = wide.where("id < 300")
    a = FeatureBuilder([], ["c", "d"]).fit(few).transform(few, keep=["id"])
    b = FeatureBuilder([], ["c", "d"], inline=5).fit(few).transform(few, keep=["id"])
    assert sorted(a.collect()) == sorted(b.collect())


def test_batched_embedding_with_a_model(spark):
    """A model handed over as a factory runs batched on the executors."""
    from rareclass.operators.textops import embed

    def make():
        def predict(texts):
            return np.array([[len(t), t.count("a")] for t in texts], dtype="float32")

        return predict

    df = spark.createDataFrame([(1, "banana"), (2, ""), (3, "xyz")], "id long, t string")
    got = {r["id"]: list(r["embedding"]) for r in embed(df, "t", "id", make_predict_fn=make, batch_size=2).collect()}
    assert got == {1: [6.0, 3.0], 2: [0.0, 0.0], 3: [3.0, 0.0]}


def test_errors_of_a_scorer_are_not_hidden(spark):
    from rareclass.operators.tune import score_frame

    class Broken:
        def transform(self, df, id_col):
            raise TypeError("inside the scorer")

    with pytest.raises(TypeError, match="inside the scorer"):
        score_frame(Broken(), spark.range(1), "id")


def test_isolation_forest_takes_one_job_a_level(spark):
    """Large nodes are ranged by one aggregate a level, and records walk in slices of a bounded size."""
    import pandas as pd
    from pyspark.ml.functions import array_to_vector
    from rareclass.scorers import IsolationForestScorer, anomaly

    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=6)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, v array<double>").select("id", F.lit(0.0).alias("label"), array_to_vector("v").alias("features")).repartition(3)
    sc = spark.sparkContext
    sc.setJobGroup("levels", "fit by levels")
    try:
        model = IsolationForestScorer(8, local_rows=1).fit(df)
        jobs = len(sc.statusTracker().getJobIdsForGroup("levels"))
    finally:
        sc.setJobGroup("rest", "rest")
    assert model.depth == 10 and jobs <= 4 * (model.depth + 1)
    whole = {r["id"]: r["score"] for r in IsolationForestScorer(8).fit(df).transform(df).collect()}
    assert {r["id"]: r["score"] for r in model.transform(df).collect()} == pytest.approx(whole)
    parts = list(anomaly._slices(pd.Series([np.zeros(64)] * 10_000), pd.Series([np.zeros(300)] * 10_000)))
    assert parts[-1].stop == 10_000 and max(p.stop - p.start for p in parts) * 300 <= anomaly.WALK_CELLS
