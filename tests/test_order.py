import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from rareclass.operators import order as O


def test_percent_rank_matches_window_with_nulls(spark):
    vals = [None, 1, 2, 2, 3] + [5] * 7 + [None] + list(range(10, 40))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x int")
    got = {r["id"]: r["percent_rank"] for r in O.percent_rank_global(df, "x").collect()}
    want = {r["id"]: r["pr"] for r in df.select("id", F.percent_rank().over(Window.orderBy(F.col("x").asc_nulls_first())).alias("pr")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert math.isclose(got[k], want[k], abs_tol=1e-12)


def test_percent_rank_small_table(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (2,), (3,)], "x int")
    got = sorted(r["percent_rank"] for r in O.percent_rank_global(df, "x").collect())
    assert got == [0.0, 0.25, 0.5, 0.5, 1.0]
    one = spark.createDataFrame([(7,)], "x int")
    assert O.percent_rank_global(one, "x").first()["percent_rank"] == 0.0


def test_percent_rank_plan_has_no_single_partition_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("x"))
    plan = O.percent_rank_global(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_exact_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert O.exact_quantile_values(df, "x", [0.5]) == [2.0]
    assert O.exact_quantile_values(df, "x", [0.5], interpolate=True) == [2.5]


def test_exact_quantile_matches_approx_quantile_zero_error(spark):
    import random

    rnd = random.Random(7)
    df = spark.createDataFrame([(float(rnd.randint(0, 500)),) for _ in range(3000)], "x double")
    qs = [0.1, 0.25, 0.5, 0.9]
    assert O.exact_quantile_values(df, "x", qs) == df.approxQuantile("x", qs, 0.0)


def test_prefix_sum_matches_window(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), ((F.col("id") * 7919) % 13).alias("v"))
    got = O.running_total(df, "k", "v").select("k", "v_cum")
    want = df.select("k", F.sum("v").over(Window.orderBy("k")).alias("w"))
    diff = got.join(want, "k").where(F.col("v_cum") != F.col("w")).count()
    assert diff == 0 and got.count() == 5000


def test_split_exact_sizes_disjoint_complete(spark):
    n = 10_000
    df = spark.range(n).withColumnRenamed("id", "key")
    s = O.split_exact(df, "key", (0.7, 0.15, 0.15), seed=13)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": int(0.7 * n), "validation": int(0.85 * n) - int(0.7 * n), "test": n - int(0.85 * n)}
    assert s.select("key").distinct().count() == n


def test_split_stratified_keeps_rare_class(spark):
    df = spark.range(2000).select(F.col("id").alias("key"), (F.col("id") % 100 == 0).cast("int").alias("y"))
    s = O.split_exact(df, "key", stratify="y")
    pos = {r["split"]: r["count"] for r in s.where("y = 1").groupBy("split").count().collect()}
    assert pos == {"train": 14, "validation": 3, "test": 3}


def test_quantiles_by_column_small_and_wide(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 17).cast("double").alias("few"),
        ((F.col("id") * 7919) % 60_013).cast("double").alias("wide"),  # > 25k distinct: selection fallback
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 101).alias("nulls"),
    )
    qs = [0.1, 0.5, 0.9]
    got = O.exact_quantiles_by_column(df, ["few", "wide", "nulls"], qs)
    for c in ["few", "wide", "nulls"]:
        assert got[c] == df.approxQuantile(c, qs, 0.0), c
    interp = O.exact_quantiles_by_column(df, ["few", "nulls"], [0.5], interpolate=True)
    want = df.select(F.percentile("few", 0.5).alias("a"), F.percentile("nulls", 0.5).alias("b")).first()
    assert interp["few"][0] == want["a"] and interp["nulls"][0] == want["b"]
