"""Training inputs: exact split first, features fitted on the training rows
(the reference fits before splitting - trap T9 - available as ``fit_on="all"``).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import order as O
from ..operators.features import FeatureBuilder
from ..sources.io import table
from .catalog import _transformed

# The feature lists and target of the product listing.
NUMERIC_FEATURES = ["stars", "reviews", "price", "listPrice", "boughtInLastMonth", "rating_weighted_reviews",
                    "percent_rank", "price_log", "title_length"]
CATEGORICAL_FEATURES = ["has_listPrice", "category_name", "isPopular"]
TARGET = "isBestSeller"
POSITIVE_CLASS = 0


def fit_features(t: DataFrame, fit_on: str = "train", seed: int = 13, stratify: bool = False):
    """Exact split of the transformed listing, features fitted on its training rows (or on ``"all"``): ``(rows, model)``
    with ``id, split, label, features``."""
    keyed = t.select("asin", F.col(TARGET).alias("__y")) if stratify else t.select("asin")
    sp = O.split_exact(keyed, "asin", seed=seed, stratify="__y" if stratify else None).select("asin", "split")
    joined = t.join(sp, "asin").persist()
    fit_rows = joined.where(F.col("split") == "train") if fit_on == "train" else joined
    model = FeatureBuilder(NUMERIC_FEATURES, CATEGORICAL_FEATURES).fit(fit_rows)
    return model.transform(joined, label=TARGET, keep=["asin", "split"]).withColumnRenamed("asin", "id"), model


def product_features_and_model(spark: SparkSession, sf_dir: str, fit_on: str = "train", seed: int = 13, stratify: bool = False):
    """:func:`fit_features` of the product listing."""
    return fit_features(_transformed(spark, sf_dir).persist(), fit_on, seed, stratify)


def product_features(spark: SparkSession, sf_dir: str, fit_on: str = "train", seed: int = 13, stratify: bool = False) -> DataFrame:
    """``id, split, label, features`` for the product listing.

    ``stratify=True`` splits each class separately so a <1 % class reaches
    every part; the default is the reference's plain shuffle.
    """
    return product_features_and_model(spark, sf_dir, fit_on, seed, stratify)[0]


def embedding_features(spark: SparkSession, sf_dir: str, seed: int = 13) -> DataFrame:
    """``id, split, label, features`` for the embeddings (class 0 = rare positive)."""
    e = table(spark, sf_dir, "embeddings")
    sp = O.split_exact(e.select("vec_id"), "vec_id", seed=seed)
    return e.join(sp, "vec_id").select(
        F.col("vec_id").alias("id"),
        "split",
        (F.col("label") == POSITIVE_CLASS).cast("double").alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
    )
