"""Permutation importance: how much a metric falls when one feature's values are dealt out anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .metrics import curve_metrics
from .order import shuffle_position
from .tune import score_frame


def dealt_pairs(base: DataFrame, key: str, seed: int) -> DataFrame:
    """``base(key, label, x)`` with ``donor``: the vector of another row, a seeded permutation of all rows.

    Every row has a position in two seeded shuffles (O4); the row at a place of the first takes the vector of the row at
    that place of the second.  Both are distributed prefix sums, and places are unique, so the joins have no hot key.
    """
    first = shuffle_position(base.select(key), key, seed, "place")
    second = shuffle_position(base.select(key), key, seed + 1, "place")
    donors = base.join(second, key).select("place", F.col("x").alias("donor"))
    return base.join(first, key).join(donors, "place").drop("place")


def permutation_importance(model, df: DataFrame, key: str = "id", features: Sequence[int] | None = None, metric: str = "roc_auc",
                           repeats: int = 1, seed: int = 42) -> DataFrame:
    """``feature, baseline, permuted, std, importance`` for each feature of ``df(key, label, features)``.

    ``permuted`` is the mean metric over ``repeats`` permutations of that feature alone (``std``: its sample deviation,
    NULL for one), ``importance`` the fall from ``baseline``.  All features of a permutation are scored in one pass, as
    rows of their own that are counted by (feature, score) without a shuffle of vectors.  ``key`` identifies a row.  With
    one class only the metrics are NULL; an empty table gives no row.
    """
    base = cut_lineage(df.select(F.col(key), F.col("label"), vector_to_array("features").alias("x")))
    width = base.agg(F.max(F.size("x"))).first()[0]
    spark = df.sparkSession
    if width is None:
        return spark.createDataFrame([], "feature int, baseline double, permuted double, std double, importance double")
    chosen = list(range(width)) if features is None else list(features)
    baseline = curve_metrics(score_frame(model, df, key), "label", "score").first()[metric]
    found = None
    for r in range(repeats):
        pairs = cut_lineage(dealt_pairs(base, key, seed + 2 * r))
        each = pairs.select(key, "label", "x", "donor", F.explode(F.array(*map(F.lit, chosen))).alias("feature"))
        vector = F.transform("x", lambda v, i: F.when(i == F.col("feature"), F.element_at("donor", i + 1)).otherwise(v))
        rows = each.select(F.concat_ws("#", F.col(key).cast("string"), "feature").alias(key), "label", "feature", array_to_vector(vector).alias("features"))
        part = curve_metrics(score_frame(model, rows, key), "label", "score", by="feature").select("feature", F.col(metric).alias("value"))
        found = part if found is None else found.unionByName(part)
    whole = F.lit(baseline).cast("double")
    out = found.groupBy("feature").agg(F.avg("value").alias("permuted"), F.stddev_samp("value").alias("std"))
    return out.select("feature", whole.alias("baseline"), "permuted", "std", (whole - F.col("permuted")).alias("importance"))
