import math

from pyspark.sql import functions as F

from rareclass.operators import clean as C


def test_try_cast_text_to_int(spark):
    df = spark.createDataFrame([("abc",), ("12.0",), ("1e3",), (None,)], "s string")
    got = [r["s"] for r in C.cast_columns(df, {"s": "int"}).collect()]
    assert got == [None, 12, 1000, None]


def test_range_to_null_inclusive_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (4.9,), (float("nan"),), (None,), (-1.0,)], "x double")
    got = [r["x"] for r in C.range_to_null(df, "x", 0, 5).collect()]
    assert got == [None, None, 4.9, None, None, None]
    kept = [r["x"] for r in C.range_to_null(df, "x", 0, 5, inclusive=False).collect()]
    assert kept[0] == 0.0 and kept[1] == 5.0


def test_domain_and_presence(spark):
    df = spark.createDataFrame([("True", 0.0), ("False", None), ("junk", 3.0), (None, 1.0)], "b string, lp double")
    assert C.domain_violations(df, "b", ["True", "False"]).count() == 1  # NULL is not a violation
    nulled = [r["b"] for r in C.domain_to_null(df, "b", ["True", "False"]).collect()]
    assert nulled == ["True", "False", None, None]
    flags = [r["f"] for r in C.presence_flag(df, "lp", "f").collect()]
    assert flags == ["False", "True", "True", "True"]


def test_sentinel_to_median_includes_sentinel_by_default(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (0.0,), (10.0,), (20.0,)], "p double")
    # median element including zeros is 0.0 (reference code); excluding zeros it is 10.0 (its note)
    assert [r["p"] for r in C.sentinel_to_median(df, "p").collect()] == [0.0, 0.0, 0.0, 10.0, 20.0]
    got = [r["p"] for r in C.sentinel_to_median(df, "p", exclude_sentinel=True, flag="imp").collect()]
    assert got == [10.0, 10.0, 10.0, 10.0, 20.0]


def test_fill_median_element(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert [r["x"] for r in C.fill_median(df, ["x"]).collect()][-1] == 2.0
    assert math.isclose([r["x"] for r in C.fill_median(df, ["x"], interpolate=True).collect()][-1], 2.5)


def test_drop_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "i int, s string, x double")
    assert C.drop_columns(df, ["s", "not there"]).columns == ["i", "x"]
