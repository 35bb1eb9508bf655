"""Poisson bootstrap and DeLong's test against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from rareclass.operators import uncertainty as U

SCHEMA = "id long, y int, s double, t double"


def table(n=150, seed=2):
    rng = random.Random(seed)
    rows = [(i, int(rng.random() < 0.2), float(rng.randint(0, 12)), rng.random()) for i in range(n)]
    rows += [(n + i, 1, 5.0, 0.5) for i in range(n // 3)]  # one score holds a third of all rows
    return rows + [(1000, 1, None, 0.1), (1001, None, 3.0, 0.2), (1002, 0, 4.0, None), (None, 1, 7.0, 0.9), (5, 0, 5.0, 0.5), (5, 0, 5.0, 0.5)]


def weight(key, r, seed):
    digits = hashlib.md5(f"{'' if key is None else key}#{seed}#{r // 4}".encode()).hexdigest()
    u = int(digits[8 * (r % 4):8 * (r % 4) + 8], 16)
    return sum(u >= c for c in U.POISSON_CUTS)


def curve(rows):
    """ROC-AUC over all weighted pairs and PR-AUC by the trapezoid."""
    pos, neg = [(s, w) for s, y, w in rows if y], [(s, w) for s, y, w in rows if not y]
    P, N = sum(w for _, w in pos), sum(w for _, w in neg)
    if not P:
        return None, None
    roc = sum(a * b * (1 if s > t else 0.5 if s == t else 0) for s, a in pos for t, b in neg) / (P * N) if N else None
    tp = fp = pr = 0
    before = 1.0
    for s in sorted({s for s, *_ in rows}, reverse=True):
        p, q = sum(w for x, w in pos if x == s), sum(w for x, w in neg if x == s)
        tp, fp = tp + p, fp + q
        if tp + fp:
            pr += p / P * (tp / (tp + fp) + before) / 2
            before = tp / (tp + fp)
    return roc, pr


@pytest.mark.parametrize("bucket_bytes", [U.BUCKET_BYTES, 400])
def test_replicates_against_weighted_rows(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(U, "BUCKET_BYTES", bucket_bytes)
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for r in U.bootstrap_replicates(df, "y", "s", ["id"], 7, 42).collect():
        want = curve([(s, y == 1, w) for i, y, s, _ in rows if s is not None for w in [weight(i, r["replicate"], 42)] if w])
        assert (r["roc_auc"], r["pr_auc"]) == pytest.approx(want)


def test_weights_are_poisson(spark):
    w = np.array([r["w"] for r in spark.range(4000).select(U.poisson_weights(["id"], 10).alias("w")).collect()])
    assert w.shape == (4000, 10) and abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.04
    assert abs(np.corrcoef(w.T) - np.eye(10)).max() < 0.06
    again = spark.range(4000).select(U.poisson_weights(["id"], 3).alias("w")).collect()
    assert (np.array([r["w"] for r in again]) == w[:, :3]).all()  # a replicate does not depend on how many there are


def test_no_rows_and_one_class(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in U.bootstrap_replicates(none, "y", "s", ["id"], 2).collect()] == [(0, None, None), (1, None, None)]
    ones = spark.createDataFrame([(i, 1, 1.0, 1.0) for i in range(30)], SCHEMA)
    assert {r["roc_auc"] for r in U.bootstrap_replicates(ones, "y", "s", ["id"], 3).collect()} == {None}
    assert U.delong_test(none, "y", "s", "t").count() == 0
    assert U.delong_test(ones, "y", "s", "t").first()["auc_a"] is None


def test_delong_against_all_pairs(spark):
    rows = table()
    got = U.delong_test(spark.createDataFrame(rows, SCHEMA).repartition(3), "y", "s", "t").first()
    kept = [(y == 1, s, t) for _, y, s, t in rows if s is not None and t is not None]
    pos, neg = [r for r in kept if r[0]], [r for r in kept if not r[0]]
    psi = np.array([[[1.0 if p[m] > n[m] else 0.5 if p[m] == n[m] else 0.0 for n in neg] for p in pos] for m in (1, 2)])
    auc = psi.mean(axis=(1, 2))
    s10, s01 = np.cov(psi.mean(axis=2)), np.cov(psi.mean(axis=1))
    variance = sum((c[0, 0] + c[1, 1] - 2 * c[0, 1]) / n for c, n in ((s10, len(pos)), (s01, len(neg))))
    z = (auc[0] - auc[1]) / math.sqrt(variance)
    assert (got["auc_a"], got["auc_b"], got["variance"], got["z"]) == pytest.approx((*auc, variance, z))
    assert got["p_value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-6)


def test_equal_models_have_no_test(spark):
    got = U.delong_test(spark.createDataFrame(table(), SCHEMA), "y", "s", "s").first()
    assert got["difference"] == 0 and got["z"] is None and got["p_value"] is None
