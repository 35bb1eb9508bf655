"""Profiling operators.

Every profile is one or two aggregation passes; only the (small) aggregate
rows ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .order import broadcast_if_small, exact_quantile_values, grouped_value_counts, join_null_safe, quantiles_from_counts

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def counts(df: DataFrame, conditions: dict[str, object]) -> DataFrame:
    """A1: total and filtered counts in one pass: ``rows`` + one column per condition."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(cond).alias(name) for name, cond in conditions.items()],
    )


def null_percent(df: DataFrame, total: int | DataFrame | None = None) -> DataFrame:
    """A4: percent of NULLs per column (one row, one column per input column).

    ``total`` defaults to this table's row count; pass the pre-drop total (an
    int) to reproduce the reference's post-cleaning profile, which divides by
    the row count before rows were dropped.  NaN is not NULL (trap T14).
    """
    if total is None:
        denom = F.count(F.lit(1))
    else:
        denom = F.lit(int(total))
    return df.agg(
        *[(F.sum(F.col(c).isNull().cast("long")) / denom * 100).alias(c) for c in df.columns]
    )


def nan_counts(df: DataFrame) -> DataFrame:
    """NaN per floating column (counted separately from NULL, trap T14)."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.agg(*[F.count_if(F.isnan(F.col(c))).alias(c) for c in fl])


def sentinel_percent(df: DataFrame, col: str, value: float = 0) -> DataFrame:
    """A2: share of rows equal to a sentinel, numerator and denominator kept.

    Rows where the column is NULL count in the denominator, as in the reference.
    """
    return df.agg(
        F.count_if(F.col(col) == F.lit(value)).alias("sentinel_rows"),
        F.count(F.lit(1)).alias("rows"),
    ).withColumn("percent", F.col("sentinel_rows") / F.col("rows") * 100)


def describe_typed(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: count, mean, sample stddev, min, max per numeric column, typed (long form)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"c{i}"),
            F.avg(x).alias(f"m{i}"),
            F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', c{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column, count, mean, stddev, min, max)")


def describe(df: DataFrame) -> DataFrame:
    """A3 as the reference prints it (``DataFrame.describe``: strings included, values as text)."""
    return df.describe()


def summary_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean_/min_/max_ of each column in one aggregate row."""
    return df.agg(
        *[F.avg(F.col(c)).alias(f"mean_{c}") for c in cols],
        *[F.min(F.col(c)).cast("double").alias(f"min_{c}") for c in cols],
        *[F.max(F.col(c)).cast("double").alias(f"max_{c}") for c in cols],
    )


def summary_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A6+A7: the wide summary unpivoted to ``(Statistic, Value)`` - on Spark, not in pandas."""
    wide = summary_wide(df, cols)
    return wide.unpivot([], wide.columns, "Statistic", "Value")


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Rows per value (NULL is its own group)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """A10: equal-width histogram over [min, max]; the last bin is closed on the right.

    Two passes: min/max (one aggregate row), then counts per bin.  All bins are
    returned, empty ones with count 0.
    """
    x = F.col(col).cast("double")
    clean = df.select(x.alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    mm = clean.agg(F.min("__x").alias("lo"), F.max("__x").alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, count long")
    span = hi - lo
    if span == 0:
        b = F.lit(0)
    else:
        b = F.least(F.floor((F.col("__x") - F.lit(lo)) * F.lit(float(bins)) / F.lit(span)).cast("int"), F.lit(bins - 1))
    counted = clean.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = span / bins
    # the bin table has exactly `bins` rows: a proven broadcast bound
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("bin_lo"),
        F.when(F.col("id") == bins - 1, F.lit(hi)).otherwise(F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("bin_hi"),
    )
    return (
        F.broadcast(edges)
        .join(counted, "bin", "left")
        .select("bin", "bin_lo", "bin_hi", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
    )


def box_stats(df: DataFrame, col: str, by: str | None = None, whisker: float = 1.5) -> DataFrame:
    """Quartiles (linear interpolation), whiskers at 1.5 IQR, outlier count.

    Ungrouped: quartiles by distributed selection (three scalars), then one
    aggregate pass.  Grouped: one table of value counts per group (the input is
    read once); quartiles, whiskers and outliers all come from it.  A NULL
    group is a group.
    """
    x = F.col(col).cast("double")
    if by is None:
        q1, q2, q3 = exact_quantile_values(df, col, [0.25, 0.5, 0.75], interpolate=True)
        if q1 is None:
            return df.sparkSession.createDataFrame(
                [], "n long, q1 double, median double, q3 double, lower_whisker double, upper_whisker double, n_outliers long"
            )
        iqr = q3 - q1
        lo_f, hi_f = q1 - whisker * iqr, q3 + whisker * iqr
        inside = (x >= F.lit(lo_f)) & (x <= F.lit(hi_f))
        return df.where(x.isNotNull() & ~F.isnan(x)).agg(
            F.count(F.lit(1)).alias("n"),
            F.lit(q1).alias("q1"),
            F.lit(q2).alias("median"),
            F.lit(q3).alias("q3"),
            F.min(F.when(inside, x)).alias("lower_whisker"),
            F.max(F.when(inside, x)).alias("upper_whisker"),
            F.count_if(~inside).alias("n_outliers"),
        )
    counts_ = grouped_value_counts(df, col, by)
    qs = quantiles_from_counts(counts_, [0.25, 0.5, 0.75], interpolate=True, partition_by=by)
    qs = cut_lineage(qs.select(by, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")))
    j = join_null_safe(counts_, broadcast_if_small(qs, qs.count()), by)
    v, iqr = F.col("__v"), F.col("q3") - F.col("q1")
    inside = (v >= F.col("q1") - whisker * iqr) & (v <= F.col("q3") + whisker * iqr)
    return j.groupBy(by).agg(
        F.sum("n").alias("n"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("lower_whisker"),
        F.max(F.when(inside, v)).alias("upper_whisker"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"),
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form ``(col_a, col_b, corr)``.

    All pairs in one aggregate pass (``corr`` skips rows where either side is NULL).
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(
        *[
            (F.lit(1.0) if a == b else F.corr(F.col(a).cast("double"), F.col(b).cast("double"))).alias(f"p{k}")
            for k, (a, b) in enumerate(pairs)
        ]
    )
    stack = ", ".join(f"'{a}', '{b}', p{k}" for k, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (col_a, col_b, corr)")


def pair_sample(df: DataFrame, cols: Sequence[str], n: int = 1000, seed: int = 42, key: str | Sequence[str] | None = None) -> DataFrame:
    """A seeded sample of ``n`` rows of ``cols`` (data under a scatter matrix); sampling is the feature.

    The ``n`` rows with the smallest ``md5(key || '#' || seed)``: every row of
    the table is as likely as any other, the size is exact, and the result does
    not depend on the layout.  ``key`` identifies a row (default: all columns).
    """
    keys = [key] if isinstance(key, str) else list(key or df.columns)
    h = F.md5(F.concat_ws("#", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.select(*cols, h.alias("__h"), *[F.col(k).alias(f"__k_{k}") for k in keys]).orderBy(
        "__h", *[f"__k_{k}" for k in keys]).limit(n).select(*cols)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """O2: the first ``n`` rows under a total order (``TakeOrderedAndProject``:
    each task keeps its own ``n`` rows), so the preview is deterministic."""
    keys = list(order_by) if order_by else list(df.columns)
    return df.orderBy(*[F.col(k).asc_nulls_first() if isinstance(k, str) else k for k in keys]).limit(n)
