"""Enrichment operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import BROADCAST_ROWS, broadcast_if_small


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    drop_keys: bool = True,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join fact -> dimension, then drop both keys.

    The dimension is broadcast only after its row count is checked; a large
    dimension falls back to the sort-merge join Catalyst picks.
    """
    n = dim.count()
    d = broadcast_if_small(dim, n, max_broadcast_rows)
    out = fact.join(d, fact[fact_key] == d[dim_key], "left")
    if drop_keys:
        out = out.drop(fact[fact_key]).drop(d[dim_key])
    return out


def category_counts(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str = "category_id",
    dim_key: str = "id",
    name_col: str = "category_name",
    count_col: str = "asin",
    out: str = "product_count",
) -> DataFrame:
    """Products per category, zero for categories without products.

    Fact rows are pre-aggregated by key before the join (one row per key), so a
    category holding a third of all products costs one partial-aggregate row
    per task instead of a skewed join partition.
    """
    per_key = fact.groupBy(fact_key).agg(F.count(F.col(count_col)).alias("__n"))
    joined = dim.join(per_key, dim[dim_key] == per_key[fact_key], "left")
    return (
        joined.groupBy(dim[name_col].alias(name_col))
        .agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias(out))
        .orderBy(F.col(out).desc(), F.col(name_col))
    )


def bool_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``'True'`` -> 1, anything else (incl. NULL) -> 0.

    The reference compares the string with boolean ``True``; Spark casts the
    string to boolean for that comparison, so ``'true'``/``'t'``/``'1'`` also
    count as true (``try_cast`` keeps junk from raising).
    """
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(F.col(c).try_cast("boolean") == F.lit(True), F.lit(1)).otherwise(F.lit(0)))
    return out


def product_of(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """P12."""
    return df.withColumn(out, F.col(a) * F.col(b))


def above(df: DataFrame, col: str, threshold: float, out: str) -> DataFrame:
    """``(col > t)`` as int (NULL stays NULL)."""
    return df.withColumn(out, (F.col(col) > F.lit(threshold)).cast("int"))


def log1p_of(df: DataFrame, col: str, out: str) -> DataFrame:
    """``log1p``; NULL for x <= -1."""
    return df.withColumn(out, F.log1p(F.col(col)))


def length_of(df: DataFrame, col: str, out: str) -> DataFrame:
    """length in code points."""
    return df.withColumn(out, F.length(F.col(col)))
