import os
import tempfile

import pytest

from pyspark.ml.linalg import Vectors

from rareclass.sources import io


def test_label_first_roundtrip_and_missing_dir(spark):
    d = tempfile.mkdtemp(prefix="rc-io-")
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
    df = spark.createDataFrame([(1.0, Vectors.dense([0.5, 2.0])), (0.0, Vectors.dense([1.5, -1.0]))], schema)
    io.write_label_first(df, os.path.join(d, "train"))
    back = io.read_label_first(spark, os.path.join(d, "train"), 2)
    assert sorted((r["label"], tuple(r["features"])) for r in back.collect()) == [(0.0, (1.5, -1.0)), (1.0, (0.5, 2.0))]
    os.makedirs(os.path.join(d, "empty"))
    with pytest.raises(ValueError, match="No CSV files"):
        io.read_label_first(spark, os.path.join(d, "empty"), 2)


def test_metrics_roundtrip_skips_missing(spark):
    d = tempfile.mkdtemp(prefix="rc-met-")
    m = spark.createDataFrame([("x", 0.7, 0.2, 0.5, 0.4, 0.44, 0.3)], io.METRICS_SCHEMA)
    io.write_metrics(m, os.path.join(d, "knn"))
    import warnings

    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        got = io.read_metrics(spark, {"knn": os.path.join(d, "knn"), "svm": os.path.join(d, "nope")})
        assert any("svm" in str(x.message) for x in w)
    assert [r["model"] for r in got.collect()] == ["knn"]


def test_partitioned_split_sink(spark):
    d = tempfile.mkdtemp(prefix="rc-split-")
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "validation")], "id int, split string")
    io.write_table(df, os.path.join(d, "s"), partition_by="split")
    parts = sorted(x for x in os.listdir(os.path.join(d, "s")) if x.startswith("split="))
    assert parts == ["split=test", "split=train", "split=validation"]


def test_spread_only_when_scan_is_narrower_than_the_cores(spark):
    from pyspark.sql import functions as F

    cores = spark.sparkContext.defaultParallelism
    narrow = spark.range(0, 1000, numPartitions=1).select(F.col("id"), (F.col("id") * 3).alias("x"))
    out = io.spread(narrow, "id")
    if cores > 1:
        assert out.rdd.getNumPartitions() == cores
    assert sorted(r["x"] for r in out.collect()) == [3 * i for i in range(1000)]
    wide = spark.range(0, 1000, numPartitions=max(cores, 2))
    assert io.spread(wide, "id") is wide  # enough scan tasks already: no extra shuffle


def test_ship_package_once(spark):
    from rareclass.session import ship_package

    ship_package(spark)
    ship_package(spark)  # a second call is a no-op
    assert getattr(spark.sparkContext, "_rareclass_shipped", False)
