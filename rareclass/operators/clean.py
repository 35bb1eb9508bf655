"""Cleaning operators.

Each takes a DataFrame and returns a DataFrame; the medians they need come from
:mod:`rareclass.operators.order` (distributed exact quantiles).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .order import exact_quantile_values, exact_quantiles_by_column

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_type(t: T.DataType | str) -> T.DataType:
    if isinstance(t, T.DataType):
        return t
    return T._parse_datatype_string(t)


def try_cast(c: Column, t: T.DataType | str) -> Column:
    """Cast that yields NULL for unparsable input (trap T1).

    Integral targets go through double first, so the text ``'12.0'`` becomes 12
    as in a non-ANSI cast; ``'abc'`` becomes NULL instead of raising.
    """
    dt = _as_type(t)
    if isinstance(dt, _INTEGRAL):
        return c.try_cast(T.DoubleType()).try_cast(dt)
    return c.try_cast(dt)


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Typed projection from a cast map, in the map's order."""
    return df.select(*[try_cast(F.col(c), t).alias(c) for c, t in types.items()])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P1."""
    return df.drop(*cols)


def outside_domain(col: str, domain: Sequence[str]) -> Column:
    """True where the value is outside ``domain``; NULL stays NULL (3-valued logic)."""
    return ~F.col(col).isin(*domain)


def domain_violations(df: DataFrame, col: str, domain: Sequence[str]) -> DataFrame:
    """Rows whose value is outside ``domain`` (NULL is not a violation)."""
    return df.filter(outside_domain(col, domain))


def domain_to_null(df: DataFrame, col: str, domain: Sequence[str]) -> DataFrame:
    """Values outside ``domain`` become NULL."""
    c = F.col(col)
    return df.withColumn(col, F.when(outside_domain(col, domain), F.lit(None)).otherwise(c))


def range_condition(col: str, lo: float, hi: float, inclusive: bool = True) -> Column:
    c = F.col(col)
    if inclusive:
        return (c <= F.lit(lo)) | (c >= F.lit(hi))
    return (c < F.lit(lo)) | (c > F.lit(hi))


def range_violations(df: DataFrame, col: str, lo: float, hi: float, inclusive: bool = True) -> DataFrame:
    """P5: rows outside the valid range (bounds are violations when inclusive, trap T3)."""
    return df.filter(range_condition(col, lo, hi, inclusive))


def range_to_null(df: DataFrame, col: str, lo: float, hi: float, inclusive: bool = True) -> DataFrame:
    """Out-of-range values become NULL; NaN too (``NaN >= hi`` is true in Spark, trap T14)."""
    c = F.col(col)
    return df.withColumn(col, F.when(range_condition(col, lo, hi, inclusive) | F.isnan(c), F.lit(None)).otherwise(c))


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P7."""
    return df.na.drop(subset=list(cols))


def median_of(df: DataFrame, col: str, interpolate: bool = False, exclude: float | None = None) -> float | None:
    """A5: exact median; the element (``approxQuantile(c, [.5], 0)``) by default."""
    src = df if exclude is None else df.filter(F.col(col) != F.lit(exclude))
    return exact_quantile_values(src, col, [0.5], interpolate)[0]


def fill_median(df: DataFrame, cols: Sequence[str], interpolate: bool = False, exclude_sentinel: float | None = None) -> DataFrame:
    """Fill NULLs of each column with its exact median (all medians share one plan)."""
    src = df
    if exclude_sentinel is not None:
        fills = {c: median_of(df, c, interpolate, exclude_sentinel) for c in cols}
    else:
        meds = exact_quantiles_by_column(src, list(cols), [0.5], interpolate)
        fills = {c: meds[c][0] for c in cols}
    fills = {c: v for c, v in fills.items() if v is not None}
    return df.na.fill(fills) if fills else df


def sentinel_to_median(
    df: DataFrame,
    col: str,
    sentinel: float = 0,
    flag: str | None = None,
    exclude_sentinel: bool = False,
    median: float | None = None,
) -> DataFrame:
    """Replace a sentinel (price 0 = missing) with the median.

    The median includes sentinel rows by default, as the reference code does
    (trap T4); ``exclude_sentinel=True`` follows its note.  ``flag`` adds an int
    column marking replaced rows (documented, never coded, in the reference).
    """
    c = F.col(col)
    m = median if median is not None else median_of(df, col, exclude=sentinel if exclude_sentinel else None)
    out = df
    if flag:
        out = out.withColumn(flag, F.coalesce((c == F.lit(sentinel)).cast("int"), F.lit(0)))
    return out.withColumn(col, F.when(c == F.lit(sentinel), F.lit(m)).otherwise(c))


def presence_flag(df: DataFrame, col: str, out: str, sentinel: float = 0) -> DataFrame:
    """P10: ``'False'`` when the value equals the sentinel, else ``'True'`` (NULL -> 'True', trap T5)."""
    return df.withColumn(out, F.when(F.col(col) == F.lit(sentinel), F.lit("False")).otherwise(F.lit("True")))
