"""Isolation forest: subtrees finished in tasks equal the ones grown level by level."""

import functools

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareclass.scorers import IsolationForestScorer
from rareclass.scorers.subtrees import Draws, grow, node_hash


def test_arrays_draw_what_columns_draw(spark):
    draws = Draws(5, 7, 4, 42)
    df = spark.range(200).select((F.col("id") % 5).cast("int").alias("t"), (F.col("id") * 7919 + 1).alias("node"))
    got = df.select("t", "node", F.xxhash64(F.lit(42), "t", "node").alias("h"), draws.candidate(3).alias("c"), draws.point().alias("u")).toPandas()
    t, node = got["t"].to_numpy().astype(np.int64), got["node"].to_numpy()
    assert (node_hash(42, t, node) == got["h"]).all()
    assert (draws.candidates(3, t, node) == got["c"]).all() and (draws.points(t, node) == got["u"]).all()
    every = np.stack([draws.candidates(k, t, node) for k in range(4)])
    assert all(len(set(c)) == 4 for c in every.T)  # all features of the tree come up


def nodes_of(model):
    every = functools.reduce(DataFrame.unionByName, [x.withColumn("level", F.lit(i)) for i, x in enumerate(model.levels)])
    return sorted((r["level"], r["t"], r["node"], r["n"], -1 if r["f"] is None else r["f"], r["v"] or 0.0) for r in every.collect())


@pytest.mark.parametrize("max_samples,max_features", [(1.0, 1.0), (0.6, 0.5)])
def test_where_the_two_ways_meet_does_not_matter(spark, max_samples, max_features):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(160, 6)).round(1)
    X[:60] = X[0]  # a third of the rows are one
    X[:, 5] = 1.0
    df = spark.createDataFrame([(i, 0.0, Vectors.dense(x.tolist())) for i, x in enumerate(X)], ["id", "label", "features"]).coalesce(2).persist()

    def fit(local_rows):
        return IsolationForestScorer(4, max_samples, max_features=max_features, seed=3, local_rows=local_rows).fit(df, "id")

    whole, levels, both = fit(None), fit(1), fit(20)
    want = nodes_of(whole)
    assert nodes_of(levels) == want and nodes_of(both) == want
    assert max(r[3] for r in want if r[0] == 0) <= 160 and min(r[3] for r in want) == 1
    a = {r["id"]: r["score"] for r in whole.transform(df, "id").collect()}
    assert {r["id"]: r["score"] for r in both.transform(df, "id").collect()} == a and len(a) == 160


def test_children_share_a_node_s_rows():
    rng = np.random.default_rng(1)
    X = rng.normal(size=(300, 4))
    X[:50] = 0.0
    draws = Draws(2, 4, 4, 7)
    tree, node = np.repeat([0, 1], 300), np.repeat([1, 1], 300)
    levels = grow(X, np.tile(np.arange(300), 2), tree, node, draws, 8)
    size = {(t, k): n for level in levels for t, k, n, *_ in zip(*level)}
    for level in levels:
        for t, k, n, f, v in zip(*level):
            inside = f >= 0
            assert inside == ((t, 2 * k) in size) == ((t, 2 * k + 1) in size)
            assert not inside or size[t, 2 * k] + size[t, 2 * k + 1] == n
    assert len(levels) == 9 and size[0, 1] == 300


def test_no_rows_and_one_row(spark):
    df = spark.createDataFrame([(1, 0.0, Vectors.dense([1.0, 2.0]))], ["id", "label", "features"])
    assert IsolationForestScorer(3).fit(df, "id").transform(df, "id").first()["score"] > 0
    assert IsolationForestScorer(3).fit(df.where("id > 5"), "id").transform(df, "id").count() == 1
