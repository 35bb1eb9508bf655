import itertools
import math
import random

from pyspark.sql import functions as F

from rareclass.operators import metrics as M


def brute_roc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y != 1]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def sk_pr_auc(rows):
    """PR-AUC as scikit-learn computes it (distinct thresholds descending, start (0, 1), trapezoid)."""
    P = sum(1 for y, _ in rows if y == 1)
    pts = [(0.0, 1.0)]
    tp = fp = 0
    for s in sorted({s for _, s in rows}, reverse=True):
        tp += sum(1 for y, x in rows if x == s and y == 1)
        fp += sum(1 for y, x in rows if x == s and y != 1)
        pts.append((tp / P, tp / (tp + fp)))
    return sum((r1 - r0) * (p1 + p0) / 2 for (r0, p0), (r1, p1) in zip(pts, pts[1:]))


def make(spark, rows):
    return spark.createDataFrame(rows, "y int, s double")


def test_roc_pr_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(int(rnd.random() < 0.1), float(rnd.randint(0, 40))) for _ in range(600)]
    m = M.curve_metrics(make(spark, rows), "y", "s").first()
    assert math.isclose(m["roc_auc"], brute_roc(rows), abs_tol=1e-12)
    assert math.isclose(m["pr_auc"], sk_pr_auc(rows), abs_tol=1e-12)


def test_roc_invariant_under_monotone_map(spark):
    rnd = random.Random(5)
    rows = [(int(rnd.random() < 0.2), rnd.random()) for _ in range(500)]
    df = make(spark, rows)
    a = M.roc_auc(df, "y", "s")
    b = M.roc_auc(df.withColumn("s", F.exp(F.col("s") * 3) + 7), "y", "s")
    assert math.isclose(a, b, abs_tol=1e-12)


def test_all_tied_and_one_class(spark):
    tied = make(spark, [(1, 0.5), (0, 0.5), (0, 0.5), (1, 0.5)])
    m = M.curve_metrics(tied, "y", "s").first()
    assert m["roc_auc"] == 0.5
    one = make(spark, [(0, 0.1), (0, 0.2)])
    assert M.curve_metrics(one, "y", "s").first()["roc_auc"] is None


def test_confusion_and_best_model(spark):
    df = make(spark, [(1, 0.9), (0, 0.8), (1, 0.4), (0, 0.1)])
    c = M.confusion(df, "y", "s", 0.5).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (1, 1, 1, 1)
    assert c["f1"] == 0.5
    metrics = spark.createDataFrame([("a", 0.5), ("b", 0.7), ("c", 0.7)], "model string, f1 double")
    assert M.best_model(metrics).first()["best_model"] == "b"


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    w = {r["y"]: r["weight"] for r in M.class_weights(df, "y").collect()}
    assert math.isclose(w[0], 10 / (2 * 9)) and math.isclose(w[1], 5.0)


def test_many_pairs_of_classes_do_not_overflow(spark):
    from rareclass.operators.metrics import curve_metrics

    # 60,000 x 60,000 pairs are more than an int holds
    df = spark.range(0, 120_000, 1, 4).selectExpr("cast(id % 2 as int) as label", "cast(id % 1000 as double) as score", "'a' as model")
    for by in (None, "model"):
        m = curve_metrics(df, "label", "score", by=by).first()
        assert m["positives"] == m["negatives"] == 60_000 and abs(m["roc_auc"] - 0.501) < 1e-9
