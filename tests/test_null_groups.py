"""NULL groups and classes keep their rows; the input of grouped operators is evaluated once."""

from pyspark.sql import functions as F

from rareclass.operators import metrics as M
from rareclass.operators import order as O
from rareclass.operators import profile as PR


def table_with_null_group(spark):
    return spark.range(1000).select(
        "id", F.when(F.col("id") % 4 > 0, F.concat(F.lit("g"), (F.col("id") % 4).cast("string"))).alias("g"),
        (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") % 5 == 0).cast("int").alias("y"))


def test_box_stats_keeps_the_null_group(spark):
    got = {r["g"]: r for r in PR.box_stats(table_with_null_group(spark), "x", by="g").collect()}
    assert set(got) == {None, "g1", "g2", "g3"} and sum(r["n"] for r in got.values()) == 1000
    import numpy as np

    x = np.array([i * 37 % 101 for i in range(0, 1000, 4)], float)
    q1, q2, q3 = np.percentile(x, [25, 50, 75])
    r = got[None]
    assert (r["q1"], r["median"], r["q3"]) == (q1, q2, q3)
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (r["lower_whisker"], r["upper_whisker"], r["n_outliers"]) == (inside.min(), inside.max(), len(x) - len(inside))


def test_stratified_split_keeps_the_null_class(spark):
    got = O.split_exact(table_with_null_group(spark), "id", stratify="g")
    assert got.count() == 1000
    null = {r["split"]: r["count"] for r in got.where("g is null").groupBy("split").count().collect()}
    assert null == {"train": 175, "validation": 37, "test": 38}


def test_grouped_metrics_and_quantiles_keep_the_null_group(spark):
    df = table_with_null_group(spark)
    m = M.curve_metrics(df, "y", "x", by="g").collect()
    assert sum(r["positives"] + r["negatives"] for r in m) == 1000 and None in {r["g"] for r in m}
    assert O.exact_quantiles(df, "x", [0.5], partition_by="g").count() == 4
    assert O.prefix_sum(df, [F.col("id")], F.col("id"), ["y"], partition_by="g").count() == 1000


def counted(spark, df):
    """``df`` through a Python function that counts the rows it is asked for."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return df.mapInPandas(run, df.schema), seen


def test_input_is_evaluated_once(spark):
    df, seen = counted(spark, table_with_null_group(spark))
    PR.box_stats(df, "x", by="g").collect()
    assert seen.value == 1000
    df, seen = counted(spark, table_with_null_group(spark))
    M.curve_metrics(df, "y", "x", by="g").collect()
    assert seen.value == 1000
    df, seen = counted(spark, table_with_null_group(spark))
    M.curve_metrics(df, "y", "x").collect()
    assert seen.value == 1000


def test_pair_sample_takes_all_parts_of_the_table(spark):
    df = spark.range(100_000).withColumn("v", F.col("id") * 2)
    got = sorted(r["id"] for r in PR.pair_sample(df, ["id", "v"], 1000, 7, "id").collect())
    assert len(set(got)) == 1000 and got[-1] > 99_000 and got[0] < 1_000
    assert got == sorted(r["id"] for r in PR.pair_sample(df.repartition(5), ["id", "v"], 1000, 7, "id").collect())
    assert PR.pair_sample(df.limit(3), ["id"], 1000).count() == 3


def test_broadcast_hint_respects_the_switch(spark):
    df = spark.range(5)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hint" not in O.broadcast_if_small(df, 5)._jdf.queryExecution().logical().toString().lower()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hint" in O.broadcast_if_small(df, 5)._jdf.queryExecution().logical().toString().lower()


def test_row_index(spark):
    words = [(f"w{i * 7919 % 1000:04d}",) for i in range(1000)]
    got = O.row_index(spark.createDataFrame(words, "w string").repartition(7), ["w"]).collect()
    assert sorted((r["index"], r["w"]) for r in got) == [(i, f"w{i:04d}") for i in range(1000)]
    assert O.row_index(spark.createDataFrame([], "w string"), ["w"]).count() == 0
