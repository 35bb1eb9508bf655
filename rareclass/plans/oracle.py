"""SQL texts (DuckDB dialect) that compute the same results as the Spark queries.

They are written independently of the Spark code - plain window functions and
aggregates over the registered tables - and serve as the correctness oracle.
"""

from __future__ import annotations

from .products import PRODUCTS_SQL


def products_ctes() -> str:
    """CTE chain: raw -> typed -> nulled -> kept -> filled -> cleaned -> transformed."""
    return f"""
raw AS ({PRODUCTS_SQL}),
typed AS (
  SELECT asin, title,
    CAST(TRY_CAST(stars10 AS DOUBLE) / 10 AS FLOAT) AS stars,
    CAST(reviews AS INTEGER) AS reviews,
    CAST(price AS FLOAT) AS price,
    CAST(listPrice AS FLOAT) AS listPrice,
    category_id, isBestSeller, boughtInLastMonth
  FROM raw),
nulled AS (
  SELECT asin, title,
    CASE WHEN stars <= 0 OR stars >= 5 OR isnan(stars) THEN NULL ELSE stars END AS stars,
    reviews, price, listPrice, category_id,
    CASE WHEN isBestSeller IN ('True', 'False') THEN isBestSeller END AS isBestSeller,
    boughtInLastMonth
  FROM typed),
kept AS (SELECT * FROM nulled WHERE isBestSeller IS NOT NULL),
med_stars AS (
  SELECT stars AS m FROM (
    SELECT stars, ROW_NUMBER() OVER (ORDER BY stars) AS rn, COUNT(*) OVER () AS n
    FROM kept WHERE stars IS NOT NULL AND NOT isnan(stars)) s
  WHERE rn = GREATEST(1, CEIL(0.5 * n))),
filled AS (
  SELECT asin, title, COALESCE(stars, (SELECT m FROM med_stars)) AS stars, reviews, price, listPrice,
    category_id, isBestSeller, boughtInLastMonth
  FROM kept),
med_price AS (
  SELECT price AS m FROM (
    SELECT price, ROW_NUMBER() OVER (ORDER BY price) AS rn, COUNT(*) OVER () AS n
    FROM filled WHERE price IS NOT NULL AND NOT isnan(price)) s
  WHERE rn = GREATEST(1, CEIL(0.5 * n))),
cleaned AS (
  SELECT asin, title, stars, reviews,
    CASE WHEN price = 0 THEN (SELECT CAST(m AS DOUBLE) FROM med_price) ELSE CAST(price AS DOUBLE) END AS price,
    listPrice, category_id, isBestSeller, boughtInLastMonth,
    CASE WHEN listPrice = 0 THEN 'False' ELSE 'True' END AS has_listPrice
  FROM filled),
categories AS (SELECT n_nationkey AS id, n_name AS category_name FROM nation),
transformed AS (
  SELECT p.asin, p.title, p.stars, p.reviews, p.price, p.listPrice,
    CASE WHEN p.isBestSeller = 'True' THEN 1 ELSE 0 END AS isBestSeller,
    p.boughtInLastMonth,
    CASE WHEN p.has_listPrice = 'True' THEN 1 ELSE 0 END AS has_listPrice,
    c.category_name,
    CAST(p.stars AS DOUBLE) * p.reviews AS rating_weighted_reviews,
    PERCENT_RANK() OVER (ORDER BY p.reviews NULLS FIRST) AS percent_rank,
    CAST(PERCENT_RANK() OVER (ORDER BY p.reviews NULLS FIRST) > 0.75 AS INTEGER) AS isPopular,
    LN(1 + p.price) AS price_log,
    CAST(LENGTH(p.title) AS INTEGER) AS title_length
  FROM cleaned p LEFT JOIN categories c ON p.category_id = c.id)"""


def r6(expr: str, alias: str | None = None) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6) AS {alias or expr}"
