"""Random forest: equal to trees grown by trying every cut, the same wherever its subtrees are grown."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rareclass.scorers import ForestScorer, forest
from rareclass.scorers.boosting import find_bins
from rareclass.sources import models

NAN = float("nan")
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])


def data(n, width, seed, copies=True):
    rng = random.Random(seed)
    rows = [[rng.choice([0.0, 0.0, 1.0, 2.0, 5.0, NAN]) if f % 2 else float(rng.randrange(12)) for f in range(width)] for _ in range(n)]
    if copies:
        rows += rows[: n // 4]
    labels = [float((r[0] > 6) != (rng.random() < 0.15)) for r in rows]
    return rows, labels


def frame(spark, rows, labels, sparse=False):
    def vector(r):
        return Vectors.sparse(len(r), [(i, v) for i, v in enumerate(r) if v != 0]) if sparse else Vectors.dense(r)

    return spark.createDataFrame([(i, y, vector(r)) for i, (r, y) in enumerate(zip(rows, labels))], SCHEMA)


def scores(model, df):
    return {r["id"]: r["score"] for r in model.transform(df).collect()}


def plain_forest(bins, drawn_rows, rule, seed, n_trees, queries):
    """Each tree by trying every cut of the components that its node draws; ``drawn_rows[t]`` lists (row, label, times, copies)."""

    def below(row, f, cut, missing_left):
        return missing_left if math.isnan(row[f]) else row[f] < cut

    def grow(rows, node_seed, depth, weights):
        def counts(rs):
            return [sum(w for _, y, w, _ in rs if y == c) for c in (0, 1)]

        def purity(rs):
            c = [w * k for w, k in zip(weights, counts(rs))]
            return sum(x * x for x in c) / sum(c)

        n0, n1 = counts(rows)
        distinct = sum(d for *_, d in rows)
        value = weights[1] * n1 / (weights[0] * n0 + weights[1] * n1)
        if depth >= rule.depth or distinct < rule.split or distinct < 2 * rule.leaf or not n0 or not n1:
            return value
        order = np.random.default_rng(node_seed).permutation(rule.width)
        varied = [f for f in order if len({"nan" if math.isnan(r[f]) else int(bins.cell(np.array([f]), np.array([r[f]]))[0]) for r, *_ in rows}) > 1]
        first = [f for f in order[:rule.features] if f in varied]
        best = None
        for f in first or varied[:1]:
            edges = list(bins.edge[bins.start[f]:bins.missing[f]])
            for cut in edges:
                for missing_left in (False, True):
                    if missing_left and (cut == math.inf or not any(math.isnan(r[f]) for r, *_ in rows)):
                        continue
                    a = [x for x in rows if below(x[0], f, cut, missing_left)]
                    b = [x for x in rows if not below(x[0], f, cut, missing_left)]
                    if min(sum(d for *_, d in s) for s in (a, b)) < rule.leaf:
                        continue
                    p = purity(a) + purity(b)
                    if best is None or p > best[0]:
                        best = (p, f, cut, missing_left, a, b)
        if best is None:
            return value
        _, f, cut, missing_left, a, b = best
        return (f, cut, missing_left, grow(a, forest._seed(node_seed, 0), depth + 1, weights), grow(b, forest._seed(node_seed, 1), depth + 1, weights))

    out = np.zeros(len(queries))
    for t in range(n_trees):
        rows = drawn_rows[t]
        total = np.array([sum(w for _, y, w, _ in rows if y == c) for c in (0, 1)], float)
        tree = grow(rows, forest._seed(seed, t), 0, rule.weights(total))
        for i, q in enumerate(queries):
            at = tree
            while isinstance(at, tuple):
                at = at[3] if below(q, *at[:3]) else at[4]
            out[i] += at / n_trees
    return out


@pytest.mark.parametrize("settings", [
    dict(max_depth=None, min_samples_split=2, min_samples_leaf=1, class_weight=None),
    dict(max_depth=4, min_samples_split=9, min_samples_leaf=3, class_weight="balanced"),
    dict(max_depth=None, min_samples_split=5, min_samples_leaf=2, class_weight="balanced_subsample")])
def test_equals_trying_every_cut(spark, settings):
    rows, labels = data(60, 5, 3)
    df = frame(spark, rows, labels)
    seen = {}
    cells_of = find_bins(df, 5, len(rows))
    # equal rows are one row with copies; how often each is drawn is an input of the plain trees
    groups = {}
    for r, y in zip(rows, labels):
        cell = cells_of.cell(np.arange(5), np.array(r))
        key = (int(y), tuple(int(c) for c, z in zip(cell, cells_of.zero) if c != z))
        groups.setdefault(key, [r, 0])[1] += 1
    keys = list(groups)
    hashed = spark.createDataFrame([(k[0], list(k[1])) for k in keys], "y tinyint, cells array<int>").select(F.xxhash64("y", "cells", F.lit(7)).alias("h")).collect()
    h, copies = np.array([r["h"] for r in hashed], np.int64), np.array([groups[k][1] for k in keys])
    n_trees = 4
    for t in range(n_trees):
        w, d = forest.draws(h, copies, forest._seed(t))
        seen[t] = [(groups[k][0], k[0], int(a), int(b)) for k, a, b in zip(keys, w, d) if a]
    ones = sum(labels)
    fixed = {"balanced": tuple(forest.balanced(len(labels) - ones, ones)), None: (1.0, 1.0)}.get(settings["class_weight"])
    rule = forest.Rule(5, settings["max_depth"], settings["min_samples_split"], settings["min_samples_leaf"], fixed)
    expected = plain_forest(cells_of, seen, rule, 7, n_trees, rows)
    got = scores(ForestScorer(n_trees, seed=7, **settings).fit(df), df)
    assert np.allclose([got[i] for i in range(len(rows))], expected, atol=1e-12)


def test_same_forest_by_levels_and_in_tasks(spark, tmp_path):
    rows, labels = data(300, 6, 5)
    df = frame(spark, rows, labels, sparse=True).repartition(3)
    args = (5, None, 2, 1, "balanced_subsample", 11, 256)
    whole = forest.fit_forest(df, *args)
    small = forest.fit_forest(df, *args, task_bytes=1500)
    levels = forest.fit_forest(df, 2, None, 2, 1, "balanced", 11, 256, task_bytes=0)
    assert max(len(t["left"]) for t in small.tops) > 3 and len(small.sizes) > 5 and not levels.sizes
    expected = scores(whole, df)
    assert scores(small, df) == pytest.approx(expected)
    assert scores(levels, df) == pytest.approx(scores(forest.fit_forest(df, 2, None, 2, 1, "balanced", 11, 256), df))
    # scored in several passes, and after a round trip through files
    small.model_nodes = 20
    assert len(list(small.steps())) > 3
    assert scores(small, df) == pytest.approx(expected)
    models.save_model(small, str(tmp_path / "forest"), spark)
    assert scores(models.load_model(spark, str(tmp_path / "forest")), df) == pytest.approx(expected)


def test_parameters_bound_the_trees(spark):
    rows, labels = data(200, 5, 9, copies=False)
    df = frame(spark, rows, labels)

    def nodes(**settings):
        return sum(s[2] for s in ForestScorer(3, seed=1, **settings).fit(df).sizes)

    free = nodes()
    assert nodes(max_depth=1) == 9  # one split a tree
    assert nodes(min_samples_split=30) < free and nodes(min_samples_leaf=10) < free


def test_draws_are_poisson_for_any_number_of_copies():
    h = np.arange(40_000, dtype=np.int64) * 7919
    w, d = forest.draws(h, np.ones(len(h), np.int64), 5)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.04 and abs((w > 0).mean() - (1 - math.exp(-1))) < 0.01 and (d == (w > 0)).all()
    for copies in (5, 1000):
        w, d = forest.draws(h[:3000], np.full(3000, copies), 5)
        assert abs(w.mean() / copies - 1) < 0.03 and abs(w.var() / copies - 1) < 0.15 and abs(d.mean() / copies - (1 - math.exp(-1))) < 0.02


def test_rows_that_repeat_and_edge_tables(spark):
    # a third of all rows is one row: it is one row of the fit
    rows, labels = data(60, 4, 2, copies=False)
    df = frame(spark, rows + [rows[0]] * 500, labels + [1.0] * 500)
    model = ForestScorer(10, seed=2).fit(df)
    assert scores(model, df)[0] > 0.5
    empty = ForestScorer(3).fit(df.where("id < 0"))
    assert set(scores(empty, df.limit(3)).values()) == {0.5}
    one_class = ForestScorer(3).fit(df.where("label = 1"))
    assert set(scores(one_class, df.limit(3)).values()) == {1.0}
    gap = spark.createDataFrame([(1, 1.0, None), (2, None, Vectors.dense([1.0] * 4)), (3, 0.0, Vectors.dense([NAN] * 4))], SCHEMA)
    found = scores(ForestScorer(3).fit(df.unionByName(gap)), gap)
    assert found[1] is None and 0 <= found[3] <= 1


def test_wide_sparse_rows_find_the_column_that_varies(spark):
    vectors = [Vectors.sparse(50_000, [(31_234, 1.0)] if i % 4 == 0 else []) for i in range(120)]
    df = spark.createDataFrame([(i, float(i % 4 == 0), v) for i, v in enumerate(vectors)], SCHEMA)
    found = scores(ForestScorer(5, seed=4).fit(df), df)
    assert all(abs(s - (i % 4 == 0)) < 1e-9 for i, s in found.items())


def test_closed_nodes_are_walked_and_added_no_more():
    """Rows of pure nodes leave a subtree's sample, and a table of cells gives the sums that the listed cells give."""
    rng = np.random.default_rng(3)
    n, width = 4000, 6
    X = rng.integers(0, 20, (n, width)).astype(float)
    y = ((X[:, 0] > 16) & (rng.random(n) < 0.3)).astype(np.int8)
    bins = forest.Bins([np.arange(20.0)] * width)
    cells = bins.cell(np.tile(np.arange(width), n), X.ravel()).reshape(n, width)
    stored = cells != bins.zero
    sample = forest.Sample(y, np.ones(n, np.int64), np.ones(n, np.int64), stored.sum(axis=1), cells[stored], bins)
    rule, tree = forest.Rule(width, None, 2, 1, (1.0, 1.0)), forest.Growing(0, 11)
    source, sizes = forest.Local(sample), []
    add = forest.Sample.add_sums

    def counted(self, out, parts):
        sizes.append(len(self.y))
        listed = np.zeros_like(out)
        add(self, out, parts)
        if hasattr(self, "row"):  # the listed cells, without zero's
            table, self.table = self.table, None
            add(self, listed, parts)
            self.table = table
            some = listed > 0
            assert (out[some] == listed[some]).all()

    with pytest.MonkeyPatch.context() as m:
        m.setattr(forest.Sample, "add_sums", counted)
        forest.grow(source, bins, [tree], rule)
    assert len(sizes) > 8 and sizes[0] == n and sizes[-1] < n // 8 and sum(sizes) < n * len(sizes) / 2
