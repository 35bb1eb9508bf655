import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from rareclass.scorers import BoostedScorer, boosting
from rareclass.sources import models

NAN = float("nan")


def plain_boosting(rows, labels, rounds, depth, eta, reg, mcw, positive):
    """Second-order boosting by trying every cut between two values, rows in lists."""
    margin, trees, losses = [0.0] * len(rows), [], []
    weight = [positive if y else 1.0 for y in labels]

    def loss():
        each = [w * math.log1p(math.exp(-m if y else m)) for w, m, y in zip(weight, margin, labels)]
        return sum(each) / sum(weight)

    def grow(ids, g, h, left_depth):
        sg, sh = sum(g[i] for i in ids), sum(h[i] for i in ids)
        best = (1e-6, None)
        for f in range(len(rows[0])) if left_depth else ():
            there = sorted({rows[i][f] for i in ids if not math.isnan(rows[i][f])})
            every = sorted({r[f] for r in rows if not math.isnan(r[f])})  # cuts stand between the values of all rows
            cuts = [(a + b) / 2 for a, b in zip(every, every[1:])] + [math.inf]
            for cut in cuts if there else ():
                for gone_left in (False, True):
                    lefts = [i for i in ids if (gone_left if math.isnan(rows[i][f]) else rows[i][f] < cut)]
                    if not lefts or len(lefts) == len(ids):
                        continue
                    lg, lh = sum(g[i] for i in lefts), sum(h[i] for i in lefts)
                    if lh < mcw or sh - lh < mcw:
                        continue
                    gain = lg ** 2 / (lh + reg) + (sg - lg) ** 2 / (sh - lh + reg) - sg ** 2 / (sh + reg)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut, gone_left))
        if best[1] is None:
            return -eta * sg / (sh + reg)
        f, cut, gone_left = best[1]
        lefts = [i for i in ids if (gone_left if math.isnan(rows[i][f]) else rows[i][f] < cut)]
        rest = [i for i in ids if i not in set(lefts)]
        return f, cut, gone_left, grow(lefts, g, h, left_depth - 1), grow(rest, g, h, left_depth - 1)

    def leaf(tree, row):
        while isinstance(tree, tuple):
            f, cut, gone_left, a, b = tree
            tree = a if (gone_left if math.isnan(row[f]) else row[f] < cut) else b
        return tree

    for _ in range(rounds):
        losses.append(loss())
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [w * (q - y) for w, q, y in zip(weight, p, labels)]
        h = [w * q * (1 - q) for w, q in zip(weight, p)]
        trees.append(grow(list(range(len(rows))), g, h, depth))
        margin = [m + leaf(trees[-1], r) for m, r in zip(margin, rows)]
    return [1 / (1 + math.exp(-m)) for m in margin], losses + [loss()]


def small(n=90, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for _ in range(n):
        r = [rng.choice([0.0, 0.0, 1.0, 2.5]), rng.gauss(0, 1), float(rng.randint(-3, 3)), 0.0]
        if rng.random() < 0.2:
            r[1] = NAN
        rows.append(r)
        labels.append(int(r[0] + (2.0 if math.isnan(r[1]) else r[1]) + rng.gauss(0, 0.5) > 1.5))
    return rows, labels


def frame(spark, rows, labels, sparse=True):
    made = []
    for i, (r, y) in enumerate(zip(rows, labels)):
        v = Vectors.sparse(len(r), {k: x for k, x in enumerate(r) if x != 0}) if sparse and i % 2 else Vectors.dense(r)
        made.append((i, float(y), v))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    return spark.createDataFrame(made, schema).repartition(3)


def scores(model, df):
    return [r["score"] for r in model.transform(df).orderBy("id").collect()]


@pytest.mark.parametrize("mcw,depth", [(1, 3), (4, 4), (0, 2)])
def test_equals_plain_boosting(spark, monkeypatch, mcw, depth):
    rows, labels = small()
    want, losses = plain_boosting(rows, labels, 6, depth, 0.3, 1.0, mcw, 5.0)
    df = frame(spark, rows, labels)
    scorer = BoostedScorer(0.3, mcw, depth, 6, 5.0)
    one = scorer.fit(df)
    assert np.allclose(scores(one, df), want, atol=1e-8)
    assert np.allclose(one.history(), losses, atol=1e-8) and one.history() == sorted(one.history(), reverse=True)
    # the same trees by jobs over a frame: one node a job, margins written every second round
    monkeypatch.setattr(boosting, "TASK_BYTES", -1)
    monkeypatch.setattr(boosting, "HISTOGRAM_NUMBERS", 1)
    monkeypatch.setattr(boosting, "ROUNDS_A_WRITE", 2)
    monkeypatch.setattr(boosting, "fewer_tasks", lambda df, *_: df)
    spread = scorer.fit(df)
    assert np.allclose(scores(spread, df), want, atol=1e-8)
    assert np.allclose(spread.history(), losses, atol=1e-8)


def test_min_child_weight_bounds_the_hessians(spark):
    rows, labels = small()
    df = frame(spark, rows, labels)
    all_of_it = sum(0.25 * (5.0 if y else 1.0) for y in labels)
    stump = BoostedScorer(0.3, all_of_it / 2 + 0.01, 4, 1, 5.0).fit(df)
    assert stump.trees[0]["feature"] == [-1]  # no two children can both reach it
    assert len(BoostedScorer(0.3, 0.5, 4, 1, 5.0).fit(df).trees[0]["feature"]) > 5


def test_missing_values_go_to_the_learned_side(spark):
    rows = [[x] for x in (1.0, 2.0, 3.0, 4.0)] * 10 + [[NAN]] * 10
    for sign, y in ((1, 1), (-1, 0)):  # label 1 stands at large values; missing ones are like these, or like the small ones
        labels = [int(r[0] > 2.5) for r in rows[:40]] + [y] * 10
        model = BoostedScorer(0.5, 1, 1, 5, 1.0).fit(frame(spark, rows, labels))
        got = scores(model, frame(spark, [[NAN], [1.0], [4.0]], [0, 0, 0]))
        assert sign * (got[0] - 0.5) > 0 and got[1] < 0.5 < got[2]
    only = [[NAN], [0.0]] * 20  # nothing but missing or not
    model = BoostedScorer(0.5, 1, 1, 5, 1.0).fit(frame(spark, only, [1, 0] * 20))
    got = scores(model, frame(spark, [[NAN], [0.0], [7.0]], [0, 0, 0]))
    assert got[0] > 0.6 and got[1] < 0.4 and got[1] == got[2]


def test_many_values_are_cut_at_quantiles(spark):
    rng = random.Random(4)
    rows = [[rng.random(), rng.random()] for _ in range(3000)]
    df = frame(spark, rows, [int(r[0] > 0.7) for r in rows])
    bins = boosting.find_bins(df, 2, len(rows), max_bins=16)
    assert all(14 <= b <= 18 for b in bins.bins)
    model = BoostedScorer(0.5, 1, 2, 10, 1.0, max_bins=64).fit(df)
    assert np.mean([(s > 0.5) == (r[0] > 0.7) for s, r in zip(scores(model, df), rows)]) > 0.97


def test_cells_of_values():
    bins = boosting.Bins([np.array([-1.0, 0.0, 2.0]), np.array([0.0]), np.array([1.0, np.nextafter(1.0, 2.0)])])
    index = np.array([0, 0, 0, 0, 0, 0, 1, 1, 2, 2, 0])
    value = np.array([-9.0, -0.5, 0.0, 1.0, 2.0, math.inf, 5.0, NAN, 1.0, np.nextafter(1.0, 2.0), NAN])
    assert bins.cell(index, value).tolist() == [0, 1, 1, 2, 2, 2, 4, 5, 6, 7, 3]


def test_awkward_tables(spark, tmp_path):
    rows, labels = small(40)
    df = frame(spark, rows, labels)
    model = BoostedScorer(0.3, 1, 3, 4).fit(df)
    models.save_model(model, str(tmp_path / "m"), spark)
    again = models.load_model(spark, str(tmp_path / "m"))
    assert scores(again, df) == scores(model, df) and again.history() == model.history()
    empty = BoostedScorer(0.3, 1, 3, 4).fit(df.limit(0))
    models.save_model(empty, str(tmp_path / "e"), spark)
    assert set(scores(models.load_model(spark, str(tmp_path / "e")), df)) == {0.5}
    assert model.transform(df.limit(0)).count() == 0
    gaps = df.selectExpr("id", "label", "if(id < 5, null, features) as features", "'x' as score_kind")
    assert [s is None for s in scores(model, gaps)[:6]] == [True] * 5 + [False]
    assert BoostedScorer(0.3, 1, 3, 4).fit(gaps).trees
    one_class = BoostedScorer(0.3, 1, 3, 4).fit(frame(spark, rows, [0] * 40))
    assert max(scores(one_class, df)) < 0.5


def test_rows_are_walked_by_a_table_or_by_their_cells(spark, monkeypatch):
    rows, labels = small()
    df = frame(spark, rows, labels)
    scorer = BoostedScorer(0.3, 1, 4, 5, 5.0)
    found = []
    for share in (10**9, 0):
        monkeypatch.setattr(boosting, "TABLE_SHARE", share)
        found.append(scorer.fit(df).trees)
    assert found[0] == found[1]


def test_large_histograms_are_added_up_in_slices(spark, monkeypatch):
    from rareclass.scorers import rows as R

    parts = spark.range(0, 6, 1, 3).selectExpr("transform(sequence(0, 9), i -> id * 100.5 + i) as s")
    want = sum(np.arange(10) + i * 100.5 for i in range(6))
    assert np.allclose(R.summed_arrays(parts, 3, 10), want)
    monkeypatch.setattr(R, "COLLECT_NUMBERS", 0)
    for numbers in (4, 10, 64):  # a row of the shuffle is a slice, not a number
        monkeypatch.setattr(R, "SLICE_NUMBERS", numbers)
        assert np.allclose(R.summed_arrays(parts, 3, 10), want)
    assert (R.summed_arrays(parts.where("false"), 3, 10) == 0).all()


def wide(n=240, seed=7):
    """Rows of which some components are rarely stored."""
    rng = random.Random(seed)
    rows = [[rng.gauss(0, 1), float(rng.randint(1, 9)), *[rng.choice([0.0] * 5 + [1.0, NAN, -2.0]) for _ in range(4)]] for _ in range(n)]
    return rows, [int((r[0] > 0) != (r[2] == 1.0) or rng.random() < 0.1) for r in rows]


def test_some_tasks_bytes_are_boosted_in_one_task(spark, monkeypatch):
    rows, labels = wide()
    df = frame(spark, rows, labels)
    scorer = BoostedScorer(0.3, 1, 5, 7, 5.0)
    want, _ = plain_boosting(rows, labels, 7, 5, 0.3, 1.0, 1, 5.0)
    monkeypatch.setattr(boosting, "TASK_BYTES", 2000)  # of some 7,000

    def jobs(*_):
        raise AssertionError("a job for every level")

    monkeypatch.setattr(boosting, "Cluster", jobs)
    assert np.allclose(scores(scorer.fit(df), df), want, atol=1e-8)


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    rows, labels = wide()
    df = frame(spark, rows, labels)
    scorer = BoostedScorer(0.3, 1, 5, 7, 5.0)
    want, losses = plain_boosting(rows, labels, 7, 5, 0.3, 1.0, 1, 5.0)
    monkeypatch.setattr(boosting, "TASK_BYTES", 2000)
    one = scorer.fit(df)
    assert np.allclose(scores(one, df), want, atol=1e-8) and np.allclose(one.history(), losses, atol=1e-8)
    monkeypatch.setattr(boosting, "TASK_BYTES", -1)
    monkeypatch.setattr(boosting, "ROUNDS_A_WRITE", 4)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 30)
    spread = scorer.fit(df)
    # to the last bit, although siblings are differences of sums from other parts of the rows
    assert [t["threshold"] for t in spread.trees] == [t["threshold"] for t in one.trees]
    assert [t["value"] for t in spread.trees] == [t["value"] for t in one.trees]


def test_only_smaller_children_are_read(monkeypatch):
    rng = np.random.default_rng(2)
    x, bins = rng.integers(0, 16, (4, 4000)), boosting.Bins([np.arange(16.0)] * 4)
    y = ((x[0] > 7) ^ (x[1] > 3)).astype(float)
    packed = boosting.Packed(y, np.zeros(4000), list(x.astype(np.uint8)), np.zeros(0, np.int32), np.zeros(0, np.int32))
    block = boosting.Block(packed, bins, 1.0, 2.0 ** -40)
    read = []

    class Source:
        add = block.add

        def sums(self, tree, nodes):
            read.append(sum(len(block.below(tree)[k]) for k in nodes))
            return block.sums(tree, nodes)

    trees = [t for t, _ in boosting.boost(Source(), bins, 1, 4, 0.3, 1.0, 1)]
    assert read[0] == 4000 and len(read) > 3 and max(read[1:-1]) <= 2000 and len(trees[0].left) == 7
    monkeypatch.setattr(boosting, "KEPT", 0)
    again = boosting.Block(packed, bins, 1.0, 2.0 ** -40)
    assert [t and t.value for t, _ in boosting.boost(boosting.Whole(again), bins, 1, 4, 0.3, 1.0, 1)] == [t and t.value for t in trees]
