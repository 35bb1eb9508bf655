"""One key holding a third of all rows: results stay exact and whole."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from rareclass.operators import metrics as M
from rareclass.operators import order as O


def _skewed(spark, n=30_000):
    # a third of the rows share the value 7; the rest are nearly distinct
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 100_003).cast("double")).alias("x"),
        (F.col("id") % 50 == 0).cast("int").alias("y"),
    )


def test_percent_rank_with_hot_key(spark):
    df = _skewed(spark)
    got = O.percent_rank_global(df, "x").select("id", "percent_rank")
    want = df.select("id", F.percent_rank().over(Window.orderBy("x")).alias("w"))
    bad = got.join(want, "id").where(F.abs(F.col("percent_rank") - F.col("w")) > 1e-12).count()
    assert bad == 0 and got.count() == df.count()


def test_quantiles_with_hot_key(spark):
    df = _skewed(spark)
    qs = [0.1, 0.33, 0.5, 0.9]
    assert O.exact_quantile_values(df, "x", qs) == df.approxQuantile("x", qs, 0.0)
    assert O.exact_quantile(df, "x", 0.5) == df.approxQuantile("x", [0.5], 0.0)[0]


def test_metrics_with_hot_score(spark):
    df = _skewed(spark)
    rows = [(r["y"], r["x"]) for r in df.select("y", "x").collect()]
    pos = sorted(s for y, s in rows if y == 1)
    neg = sorted(s for y, s in rows if y != 1)
    import bisect

    # pairs (positive, negative) won by the positive; ties count one half
    wins = sum((len(pos) - bisect.bisect_right(pos, s)) + 0.5 * (bisect.bisect_right(pos, s) - bisect.bisect_left(pos, s)) for s in neg)
    assert math.isclose(M.roc_auc(df, "y", "x"), wins / (len(pos) * len(neg)), abs_tol=1e-12)
