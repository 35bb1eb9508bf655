"""The product-listing jobs: cleaning (a) and enrichment/transformation (b).

``products_raw`` builds the stand-in listing table from ``part`` and
``lineitem`` (see FIXTURES.md); every later step is the library's operators.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean as C
from ..operators import enrich as E
from ..operators.order import exact_quantiles_by_column, percent_rank_global
from ..sources.io import table

# Cast map of the raw listing.
PRODUCT_TYPES: dict[str, T.DataType] = {
    "asin": T.StringType(),
    "title": T.StringType(),
    "stars": T.FloatType(),
    "reviews": T.IntegerType(),
    "price": T.FloatType(),
    "listPrice": T.FloatType(),
    "category_id": T.IntegerType(),
    "isBestSeller": T.StringType(),
    "boughtInLastMonth": T.IntegerType(),
}
LABEL_DOMAIN = ("True", "False")
STARS_RANGE = (0.0, 5.0)

# Stand-in listing table, the same text for Spark and the SQL oracle.
PRODUCTS_SQL = """
WITH li AS (SELECT l_partkey, COUNT(*) AS n, SUM(l_quantity) AS q FROM lineitem GROUP BY l_partkey)
SELECT CONCAT('P', CAST(p.p_partkey AS VARCHAR(20))) AS asin,
  p.p_name AS title,
  CASE WHEN p.p_partkey % 41 = 0 THEN 'bad' ELSE CAST(CAST((p.p_partkey * 7) % 56 AS INT) AS VARCHAR(20)) END AS stars10,
  COALESCE(li.n, 0) AS reviews,
  CASE WHEN p.p_partkey % 43 = 0 THEN 0.0 ELSE p.p_retailprice END AS price,
  CASE WHEN p.p_partkey % 4 <> 0 THEN 0.0 WHEN p.p_partkey % 8 = 0 THEN NULL ELSE p.p_retailprice * 1.2 END AS listPrice,
  CAST(p.p_size % 20 AS INT) AS category_id,
  CASE WHEN p.p_partkey % 27 = 0 THEN 'N/A' WHEN p.p_partkey % 53 = 0 THEN NULL WHEN p.p_partkey % 167 = 1 THEN 'True' ELSE 'False' END AS isBestSeller,
  CAST(COALESCE(li.q, 0) AS INT) AS boughtInLastMonth
FROM part p LEFT JOIN li ON p.p_partkey = li.l_partkey
"""


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in listing table (DataFrame form of ``PRODUCTS_SQL``).

    ``stars`` is the text ``stars10`` read as tenths; the text ``'bad'`` gives
    NULL - the dirty values the cleaning job must survive.
    """
    part = table(spark, sf_dir, "part")
    li = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q")
    )
    k = F.col("p_partkey")
    stars10 = F.when(k % 41 == 0, F.lit("bad")).otherwise(((k * 7) % 56).cast("int").cast("string"))
    j = part.join(li, part.p_partkey == li.l_partkey, "left")
    return j.select(
        F.concat(F.lit("P"), k.cast("string")).alias("asin"),
        F.col("p_name").alias("title"),
        (stars10.try_cast("double") / 10).try_cast("float").cast("string").alias("stars"),
        F.coalesce(F.col("n"), F.lit(0)).alias("reviews"),
        F.when(k % 43 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice")).alias("price"),
        F.when(k % 4 != 0, F.lit(0.0)).when(k % 8 == 0, F.lit(None)).otherwise(F.col("p_retailprice") * 1.2).alias("listPrice"),
        (F.col("p_size") % 20).cast("int").alias("category_id"),
        F.when(k % 27 == 0, F.lit("N/A"))
        .when(k % 53 == 0, F.lit(None))
        .when(k % 167 == 1, F.lit("True"))
        .otherwise(F.lit("False"))
        .alias("isBestSeller"),
        F.coalesce(F.col("q"), F.lit(0)).cast("int").alias("boughtInLastMonth"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category dimension stand-in: ``nation`` as ``id, category_name``."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("category_name")
    )


@dataclass
class CleaningReport:
    total_rows: int
    invalid_label_rows: int
    invalid_stars_rows: int
    median_stars: float | None
    median_price: float | None


def clean_products(raw: DataFrame, persist: bool = True) -> tuple[DataFrame, CleaningReport]:
    """Cleaning job (a): P2 -> P3/P4 -> P5/P6 -> P7 -> A5+P8 -> A5+P9 -> P10.

    The two medians are exact elements (``approxQuantile(c, [.5], 0)``, T2)
    computed by distributed selection; the typed table is persisted because
    the medians and counts re-read it.
    """
    typed = C.cast_columns(raw, PRODUCT_TYPES)
    if persist:
        typed = typed.persist()
    stats = typed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(C.outside_domain("isBestSeller", LABEL_DOMAIN)).alias("bad_label"),
        F.count_if(C.range_condition("stars", *STARS_RANGE)).alias("bad_stars"),
    ).first()
    df = C.domain_to_null(typed, "isBestSeller", LABEL_DOMAIN)
    df = C.range_to_null(df, "stars", *STARS_RANGE)
    df = C.drop_null_rows(df, ["isBestSeller"])
    # both medians come from the same rows (the star fill does not touch
    # prices), so they share one plan
    meds = exact_quantiles_by_column(df, ["stars", "price"], [0.5])
    med_stars, med_price = meds["stars"][0], meds["price"][0]
    df = df.na.fill({"stars": med_stars}) if med_stars is not None else df
    df = C.sentinel_to_median(df, "price", 0, median=med_price)
    df = C.presence_flag(df, "listPrice", "has_listPrice")
    report = CleaningReport(int(stats["total"]), int(stats["bad_label"]), int(stats["bad_stars"]), med_stars, med_price)
    return df, report


NUMERIC_SUMMARY = [
    "stars",
    "reviews",
    "price",
    "listPrice",
    "rating_weighted_reviews",
    "percent_rank",
    "price_log",
    "title_length",
]


def transform_products(cleaned: DataFrame, cats: DataFrame) -> DataFrame:
    """Transformation job (b): J1 -> P11 -> P12 -> W1 -> P13 -> F3 -> F2."""
    df = E.join_dimension(cleaned, cats, "category_id", "id")
    df = E.bool_to_int(df, ["has_listPrice", "isBestSeller"])
    df = E.product_of(df, "stars", "reviews", "rating_weighted_reviews")
    df = percent_rank_global(df, "reviews", "percent_rank")
    df = E.above(df, "percent_rank", 0.75, "isPopular")
    df = E.log1p_of(df, "price", "price_log")
    df = E.length_of(df, "title", "title_length")
    return df
