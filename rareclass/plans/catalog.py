"""Registered queries: one Spark job per operator group, each paired with an
independent SQL oracle text (or none, for rows-only checks).

Every query reads the given tables (or data Spark derives from them) in full.
Doubles are rounded to 6 digits on both sides so value hashes compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import enrich as E
from ..operators import order as O
from ..operators import profile as PR
from ..sources.io import spread, table
from . import products as PD
from .oracle import products_ctes, r6

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def rnd(c: str | Column, alias: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6).alias(alias or (c if isinstance(c, str) else "value"))


def _with(sql_body: str) -> str:
    return f"WITH {products_ctes()}\n{sql_body}"


# ---------------------------------------------------------------- products --

_CLEANED_OUT = ["asin", "title", "stars", "reviews", "price", "listPrice", "category_id", "isBestSeller", "boughtInLastMonth", "has_listPrice"]


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, _ = PD.clean_products(PD.products_raw(spark, sf_dir))
    return cleaned


def _transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PD.transform_products(_cleaned(spark, sf_dir), PD.categories(spark, sf_dir))


@query(
    "clean_products",
    _with(
        "SELECT asin, title, "
        + r6("stars")
        + ", reviews, "
        + r6("price")
        + ", "
        + r6("listPrice")
        + ", category_id, isBestSeller, boughtInLastMonth, has_listPrice FROM cleaned"
    ),
)
def q_clean_products(spark, sf_dir):
    """The whole cleaning job."""
    df = _cleaned(spark, sf_dir)
    return df.select(
        "asin", "title", rnd("stars"), "reviews", rnd("price"), rnd("listPrice"),
        "category_id", "isBestSeller", "boughtInLastMonth", "has_listPrice",
    )


_TRANSFORMED_DOUBLES = ["stars", "price", "listPrice", "rating_weighted_reviews", "percent_rank", "price_log"]
_TRANSFORMED_OTHER = ["asin", "title", "reviews", "isBestSeller", "boughtInLastMonth", "has_listPrice", "category_name", "isPopular", "title_length"]


@query(
    "transform_products",
    _with(
        "SELECT "
        + ", ".join(_TRANSFORMED_OTHER)
        + ", "
        + ", ".join(r6(c) for c in _TRANSFORMED_DOUBLES)
        + " FROM transformed"
    ),
)
def q_transform_products(spark, sf_dir):
    """The whole transformation job."""
    df = _transformed(spark, sf_dir)
    return df.select(*_TRANSFORMED_OTHER, *[rnd(c) for c in _TRANSFORMED_DOUBLES])


@query(
    "null_profile",
    _with(
        "SELECT "
        + ", ".join(
            f"ROUND(CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100, 6) AS {c}"
            for c in PD.PRODUCT_TYPES
        )
        + " FROM nulled"
    ),
)
def q_null_profile(spark, sf_dir):
    """A4: NULL percent per column after domain/range nulling (before the drop)."""
    from ..operators import clean as C

    typed = C.cast_columns(PD.products_raw(spark, sf_dir), PD.PRODUCT_TYPES)
    df = C.range_to_null(C.domain_to_null(typed, "isBestSeller", PD.LABEL_DOMAIN), "stars", *PD.STARS_RANGE)
    prof = PR.null_percent(df)
    return prof.select(*[rnd(c) for c in prof.columns])


@query(
    "violation_counts",
    _with(
        "SELECT COUNT(*) AS rows, "
        "COUNT(*) FILTER (WHERE isBestSeller <> 'True' AND isBestSeller <> 'False') AS invalid_label, "
        "COUNT(*) FILTER (WHERE stars <= 0 OR stars >= 5) AS invalid_stars FROM typed"
    ),
)
def q_violation_counts(spark, sf_dir):
    """Total and violation counts in one pass."""
    from ..operators import clean as C

    typed = C.cast_columns(PD.products_raw(spark, sf_dir), PD.PRODUCT_TYPES)
    return PR.counts(
        typed,
        {
            "invalid_label": C.outside_domain("isBestSeller", PD.LABEL_DOMAIN),
            "invalid_stars": C.range_condition("stars", *PD.STARS_RANGE),
        },
    )


@query(
    "label_counts",
    _with("SELECT isBestSeller, COUNT(*) AS count FROM nulled GROUP BY isBestSeller"),
)
def q_label_counts(spark, sf_dir):
    """Value counts of the label after nulling invalid values."""
    from ..operators import clean as C

    typed = C.cast_columns(PD.products_raw(spark, sf_dir), PD.PRODUCT_TYPES)
    return PR.value_counts(C.domain_to_null(typed, "isBestSeller", PD.LABEL_DOMAIN), "isBestSeller")


@query(
    "zero_price_share",
    _with(
        "SELECT COUNT(*) FILTER (WHERE price = 0) AS sentinel_rows, COUNT(*) AS rows, "
        "ROUND(CAST(COUNT(*) FILTER (WHERE price = 0) AS DOUBLE) / COUNT(*) * 100, 6) AS percent FROM filled"
    ),
)
def q_zero_price_share(spark, sf_dir):
    """A2: share of zero prices among labelled rows (before the median replace)."""
    from ..operators import clean as C

    typed = C.cast_columns(PD.products_raw(spark, sf_dir), PD.PRODUCT_TYPES)
    kept = C.drop_null_rows(C.domain_to_null(typed, "isBestSeller", PD.LABEL_DOMAIN), ["isBestSeller"])
    res = PR.sentinel_percent(kept, "price", 0)
    return res.select("sentinel_rows", "rows", rnd("percent"))


@query(
    "category_counts",
    _with(
        "SELECT c.category_name, COUNT(p.asin) AS product_count FROM categories c "
        "LEFT JOIN cleaned p ON c.id = p.category_id GROUP BY c.category_name"
    ),
)
def q_category_counts(spark, sf_dir):
    """Products per category incl. empty categories, by count descending."""
    return E.category_counts(_cleaned(spark, sf_dir), PD.categories(spark, sf_dir))


@query(
    "melt_summary",
    _with(
        "SELECT Statistic, ROUND(CAST(Value AS DOUBLE), 6) AS Value FROM (UNPIVOT (SELECT "
        + ", ".join(
            [f"AVG({c}) AS mean_{c}" for c in PD.NUMERIC_SUMMARY]
            + [f"CAST(MIN({c}) AS DOUBLE) AS min_{c}" for c in PD.NUMERIC_SUMMARY]
            + [f"CAST(MAX({c}) AS DOUBLE) AS max_{c}" for c in PD.NUMERIC_SUMMARY]
        )
        + " FROM transformed) ON COLUMNS(*) INTO NAME Statistic VALUE Value)"
    ),
)
def q_melt_summary(spark, sf_dir):
    """mean/min/max of the numeric columns, unpivoted to (Statistic, Value)."""
    long = PR.summary_long(_transformed(spark, sf_dir), PD.NUMERIC_SUMMARY)
    return long.select("Statistic", rnd("Value"))


# ---------------------------------------------------------------- profiles --

_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_typed",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS stddev, "
        f"ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max FROM lineitem"
        for c in _LI_NUM
    ),
)
def q_describe_typed(spark, sf_dir):
    """A3: typed describe of the numeric lineitem columns."""
    d = PR.describe_typed(table(spark, sf_dir, "lineitem"), _LI_NUM)
    return d.select("column", "count", rnd("mean"), rnd("stddev"), rnd("min"), rnd("max"))


@query(
    "histogram",
    """
WITH mm AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem),
b AS (
  SELECT LEAST(CAST(FLOOR((l_extendedprice - lo) * 30.0 / (hi - lo)) AS INTEGER), 29) AS bin
  FROM lineitem, mm WHERE l_extendedprice IS NOT NULL),
c AS (SELECT bin, COUNT(*) AS cnt FROM b GROUP BY bin),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT bins.bin,
  ROUND(lo + bins.bin * ((hi - lo) / 30), 6) AS bin_lo,
  ROUND(CASE WHEN bins.bin = 29 THEN hi ELSE lo + (bins.bin + 1) * ((hi - lo) / 30) END, 6) AS bin_hi,
  COALESCE(c.cnt, 0) AS count
FROM bins CROSS JOIN mm LEFT JOIN c ON bins.bin = c.bin
""",
)
def q_histogram(spark, sf_dir):
    """A10: 30 equal-width bins of l_extendedprice."""
    h = PR.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 30)
    return h.select("bin", rnd("bin_lo"), rnd("bin_hi"), "count")


_BOX_SQL = """
WITH q AS (
  SELECT {g_sel} QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.5) AS med, QUANTILE_CONT({c}, 0.75) AS q3
  FROM lineitem WHERE {c} IS NOT NULL {g_by}),
j AS (SELECT l.{c} AS x, q.* FROM lineitem l JOIN q ON {g_on} WHERE l.{c} IS NOT NULL)
SELECT {g_sel} COUNT(*) AS n, ROUND(FIRST(q1), 6) AS q1, ROUND(FIRST(med), 6) AS median, ROUND(FIRST(q3), 6) AS q3,
  ROUND(MIN(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS lower_whisker,
  ROUND(MAX(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker,
  COUNT(*) FILTER (WHERE NOT (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1))) AS n_outliers
FROM j {g_by}
"""


@query("box_stats", _BOX_SQL.format(c="l_extendedprice", g_sel="", g_by="", g_on="TRUE"))
def q_box_stats(spark, sf_dir):
    """Box-plot statistics of l_extendedprice."""
    b = PR.box_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return b.select("n", *[rnd(c) for c in ["q1", "median", "q3", "lower_whisker", "upper_whisker"]], "n_outliers")


@query(
    "box_stats_by",
    _BOX_SQL.format(c="l_quantity", g_sel="l_returnflag,", g_by="GROUP BY l_returnflag", g_on="l.l_returnflag = q.l_returnflag").replace(
        "SELECT l_returnflag, COUNT(*) AS n", "SELECT j.l_returnflag, COUNT(*) AS n"
    ).replace("FROM j GROUP BY l_returnflag", "FROM j GROUP BY j.l_returnflag"),
)
def q_box_stats_by(spark, sf_dir):
    """Box-plot statistics of l_quantity per l_returnflag."""
    b = PR.box_stats(table(spark, sf_dir, "lineitem"), "l_quantity", by="l_returnflag")
    return b.select("l_returnflag", "n", *[rnd(c) for c in ["q1", "median", "q3", "lower_whisker", "upper_whisker"]], "n_outliers")


_CORR_PAIRS = [(a, b) for i, a in enumerate(_LI_NUM) for b in _LI_NUM[i:]]


@query(
    "corr_matrix",
    " UNION ALL ".join(
        (f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(1.0 AS DOUBLE) AS corr" if a == b
         else f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(CORR({a}, {b}), 6) AS corr FROM lineitem")
        for a, b in _CORR_PAIRS
    ),
)
def q_corr_matrix(spark, sf_dir):
    """Pearson correlation of the numeric lineitem columns."""
    c = PR.corr_matrix(table(spark, sf_dir, "lineitem"), _LI_NUM)
    return c.select("col_a", "col_b", rnd("corr"))


@query(
    "exact_median",
    "SELECT "
    + ", ".join(
        f"ROUND((SELECT x FROM (SELECT {c} AS x, ROW_NUMBER() OVER (ORDER BY {c}) AS rn, COUNT(*) OVER () AS n FROM lineitem WHERE {c} IS NOT NULL) s WHERE rn = GREATEST(1, CEIL(0.5 * n))), 6) AS {c}"
        for c in _LI_NUM
    ),
)
def q_exact_median(spark, sf_dir):
    """A5: exact median element (``approxQuantile(c, [.5], 0)``) of each numeric lineitem column."""
    li = table(spark, sf_dir, "lineitem")
    vals = [O.exact_quantile_values(li, c, [0.5])[0] for c in _LI_NUM]
    # one-row result built from the scalars (each a distributed selection over lineitem; NULL where there is no value)
    return spark.range(1).select(*[F.round(F.lit(v).cast("double"), 6).alias(c) for v, c in zip(vals, _LI_NUM)])


# ------------------------------------------------------------------ order --


@query(
    "percent_rank_dist",
    "SELECT o_orderkey, ROUND(PERCENT_RANK() OVER (ORDER BY o_totalprice NULLS FIRST), 6) AS percent_rank FROM orders",
)
def q_percent_rank_dist(spark, sf_dir):
    """Global percent_rank over nearly distinct keys, without a single-partition window."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return O.percent_rank_global(orders, "o_totalprice").select("o_orderkey", rnd("percent_rank"))


@query(
    "exact_split",
    """
WITH s AS (
  SELECT o_orderkey,
    ROW_NUMBER() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '#13'), o_orderkey) AS pos,
    COUNT(*) OVER () AS n
  FROM orders)
SELECT o_orderkey,
  CASE WHEN pos <= FLOOR(CAST(0.7 AS DOUBLE) * n) THEN 'train'
       WHEN pos <= FLOOR(CAST(0.85 AS DOUBLE) * n) THEN 'validation'
       ELSE 'test' END AS split
FROM s
""",
)
def q_exact_split(spark, sf_dir):
    """Seeded shuffle and exact 70/15/15 split of orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return O.split_exact(orders, "o_orderkey", (0.7, 0.15, 0.15), seed=13).select("o_orderkey", "split")


@query(
    "running_total",
    "SELECT o_custkey, ROUND(SUM(t) OVER (ORDER BY o_custkey), 2) AS total_cum FROM "
    "(SELECT o_custkey, SUM(o_totalprice) AS t FROM orders GROUP BY o_custkey)",
)
def q_running_total(spark, sf_dir):
    """Prefix sum (the operator under W1/O5/A18): running revenue by customer key."""
    orders = table(spark, sf_dir, "orders")
    rt = O.running_total(orders.select("o_custkey", F.col("o_totalprice").alias("total")), "o_custkey", "total")
    # sums of 1e9 magnitude: compare at cents (summation order differs by engine)
    return rt.select("o_custkey", F.round(F.col("total_cum"), 2).alias("total_cum"))


# ------------------------------------------------------------------- text --


def _ws() -> str:
    return r"[\t\n\x{0B}\f\r ]"


# the oracle's own spelling of the ranges (merged and in order), written apart from the query's pattern builders
_TEXT_CLEAN_SQL = r"""
SELECT doc_id, regexp_replace(
  regexp_replace(
    regexp_replace(text, '[\x{200D}\x{231A}\x{23CF}\x{23E9}\x{24C2}-\x{1F251}\x{2500}-\x{2BEF}\x{3030}\x{FE0F}\x{10000}-\x{10FFFF}]', '', 'g'),
    '[^_\p{L}\p{N}\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\p{Z}!,.:;?|-]', '', 'g'),
  '[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\p{Z}]+', ' ', 'g') AS clean
FROM documents"""


@query("text_clean", _TEXT_CLEAN_SQL)
def q_text_clean(spark, sf_dir):
    """text cleaning of every document, whole texts."""
    return documents_text(spark, sf_dir).select("doc_id", TX.clean_text("text").alias("clean"))


def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text`` of every document, spread over the cores when the scan is
    narrower than the cluster (regex cleaning and tokenising are CPU-bound)."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def _tokens_sql() -> str:
    return f"""
toks AS (
  SELECT doc_id, UNNEST(l) AS tok, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split_regex(lower(text), '{_ws()}') AS l FROM documents)),
last AS (SELECT doc_id, MAX(pos) FILTER (WHERE tok <> '') AS lastpos FROM toks GROUP BY doc_id),
kept AS (
  SELECT t.doc_id, t.tok FROM toks t JOIN last USING (doc_id)
  WHERE t.pos <= last.lastpos AND t.tok NOT IN (SELECT UNNEST({TX.sql_string_list(TX.stop_words())})))"""


@query(
    "top_tokens",
    "WITH "
    + _tokens_sql()
    + """,
tf AS (SELECT tok AS token, COUNT(*) AS count, COUNT(DISTINCT doc_id) AS docs FROM kept GROUP BY tok),
vocab AS (SELECT token, count FROM tf WHERE docs >= 5 ORDER BY count DESC, token LIMIT 100)
SELECT token, count FROM vocab ORDER BY count DESC, token LIMIT 50""",
)
def q_top_tokens(spark, sf_dir):
    """Vocabulary of 100 (minDF 5), top 50 by count."""
    from ..operators.textops import top_tokens

    return top_tokens(documents_text(spark, sf_dir), "text", "doc_id", vocab_size=100, min_df=5, top=50)


@query(
    "token_counts",
    "WITH "
    + _tokens_sql()
    + " SELECT d.doc_id, CAST(COUNT(k.tok) AS BIGINT) AS n_tokens FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id GROUP BY d.doc_id",
)
def q_token_counts(spark, sf_dir):
    """tokens per document after stop-word removal."""
    from ..operators.textops import filtered_tokens

    toks = filtered_tokens(documents_text(spark, sf_dir), "text", "doc_id")
    return toks.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"))


def queries() -> dict[str, QueryFn]:
    from . import catalog_ml  # noqa: F401  (registers the feature/metric/scorer queries)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalog_ml  # noqa: F401

    return dict(SQL)


@query(
    "null_profile_post_clean",
    _with(
        "SELECT "
        + ", ".join(
            f"ROUND(CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / (SELECT COUNT(*) FROM nulled) * 100, 6) AS {c}"
            for c in _CLEANED_OUT
        )
        + " FROM cleaned"
    ),
)
def q_null_profile_post_clean(spark, sf_dir):
    """A4: NULL percent of the cleaned table against the pre-drop row count (as the reference divides)."""
    cleaned, report = PD.clean_products(PD.products_raw(spark, sf_dir))
    prof = PR.null_percent(cleaned.select(*_CLEANED_OUT), total=report.total_rows)
    return prof.select(*[rnd(c) for c in prof.columns])


_CLEAN_NUM = ["stars", "reviews", "price", "listPrice", "boughtInLastMonth"]


@query(
    "describe_products",
    _with(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS stddev, "
            f"ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS min, ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS max FROM cleaned"
            for c in _CLEAN_NUM
        )
    ),
)
def q_describe_products(spark, sf_dir):
    """A3: typed describe of the cleaned listing's numeric columns."""
    d = PR.describe_typed(_cleaned(spark, sf_dir), _CLEAN_NUM)
    return d.select("column", "count", rnd("mean"), rnd("stddev"), rnd("min"), rnd("max"))


@query(
    "preview_orders",
    "SELECT o_orderkey, o_custkey, o_orderstatus, ROUND(o_totalprice, 6) AS o_totalprice FROM orders "
    "ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def q_preview_orders(spark, sf_dir):
    """O2: first rows under a total order (a top-10 report - the limit is the feature)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    top = PR.preview(o, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return top.select("o_orderkey", "o_custkey", "o_orderstatus", rnd("o_totalprice"))
