"""Exact ranking metrics (A16-A20) as grouped prefix sums.

MLlib's ``BinaryClassificationMetrics`` bins scores (1000 bins by default) and
starts its PR curve at (0, p0); the reference's metrics are exact and
tie-aware, so these are built from per-score counts (trap T7):

* group rows by distinct score -> positives ``p`` and negatives ``q``
  (map-side combined: a score shared by a third of all rows is one row);
* descending prefix sums -> ``tp``, ``fp`` at each threshold
  (:func:`rareclass.operators.order.prefix_sum`, no single-partition window);
* ROC-AUC = sum(q * (tp - p/2)) / (P * N) (ties count one half);
* PR-AUC = trapezoid from (recall 0, precision 1) over thresholds; the
  previous point is the exclusive prefix, so no ``lag`` is needed.

An optional ``by`` column (e.g. ``model``) evaluates many scorers in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import _cols, broadcast_if_small, join_null_safe, prefix_sum


def score_counts(df: DataFrame, label: str, score: str, by: str | Sequence[str] | None = None, positive=1) -> DataFrame:
    parts = _cols(by)
    pos = (F.col(label) == F.lit(positive)).cast("long")
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*parts, F.col(score).cast("double").alias("score"))
        .agg(F.sum(pos).alias("p"), F.sum(F.lit(1) - pos).alias("q"))
    )


def curve_table(df: DataFrame, label: str, score: str, by: str | Sequence[str] | None = None, positive=1) -> DataFrame:
    """Per distinct score (descending): ``p, q, tp, fp, n_pos, n_neg`` (+ ``by`` columns)."""
    parts = _cols(by)
    # written once: the scored frame behind it (a model, a kNN join) is evaluated a single time
    sc = cut_lineage(score_counts(df, label, score, parts, positive))
    grand: dict = {}
    cum = prefix_sum(sc, [F.col("score").desc()], F.col("score"), ["p", "q"], partition_by=parts, descending=True,
                     grand=grand)
    cum = cum.withColumnRenamed("p_cum", "tp").withColumnRenamed("q_cum", "fp")
    if parts:
        totals = sc.groupBy(*parts).agg(F.sum("p").alias("n_pos"), F.sum("q").alias("n_neg"))
        totals = broadcast_if_small(totals, totals.count())
        return join_null_safe(cum, totals, parts)
    # class totals come with the prefix sums' bucket totals (no extra job)
    return cum.withColumn("n_pos", F.lit(int(grand.get("p") or 0)).cast("long")).withColumn("n_neg", F.lit(int(grand.get("q") or 0)).cast("long"))


def _points(ct: DataFrame) -> DataFrame:
    tp, fp, p, q = F.col("tp"), F.col("fp"), F.col("p"), F.col("q")
    prev_tp, prev_fp = tp - p, fp - q
    precision = F.try_divide(tp, tp + fp)
    prev_precision = F.when(prev_tp + prev_fp == 0, F.lit(1.0)).otherwise(F.try_divide(prev_tp, prev_tp + prev_fp))
    recall = F.try_divide(tp, F.col("n_pos"))
    return ct.select(
        "*",
        precision.alias("precision"),
        recall.alias("recall"),
        prev_precision.alias("prev_precision"),
        F.try_divide(2 * tp, tp + fp + F.col("n_pos")).alias("f1"),
    )


def curve_metrics(df: DataFrame, label: str, score: str, by: str | Sequence[str] | None = None, positive=1) -> DataFrame:
    """``roc_auc, pr_auc`` and the best-F1 operating point per group.

    One class only gives NULL ROC-AUC (undefined, the reference raises).
    The best threshold maximises F1 (ties: the higher threshold); predictions
    are ``score >= threshold``.
    """
    parts = _cols(by)
    pts = _points(curve_table(df, label, score, parts, positive))
    P, N = F.first("n_pos"), F.first("n_neg")
    best = F.max(F.struct(F.col("f1"), F.col("score"), F.col("precision"), F.col("recall")))
    agg = pts.groupBy(*parts).agg(
        F.try_divide(F.sum(F.col("q") * (F.col("tp") - F.col("p") / 2)), P.cast("double") * N).alias("roc_auc"),
        F.sum(F.try_divide(F.col("p"), F.col("n_pos")) * (F.col("precision") + F.col("prev_precision")) / 2).alias("pr_auc"),
        best.alias("__best"),
        P.alias("positives"),
        N.alias("negatives"),
    )
    return agg.select(
        *parts,
        F.when((F.col("positives") > 0) & (F.col("negatives") > 0), F.col("roc_auc")).alias("roc_auc"),
        F.when(F.col("positives") > 0, F.col("pr_auc")).alias("pr_auc"),
        F.col("__best.precision").alias("precision"),
        F.col("__best.recall").alias("recall"),
        F.col("__best.f1").alias("f1"),
        F.col("__best.score").alias("threshold"),
        F.col("positives").cast("long").alias("positives"),
        F.col("negatives").cast("long").alias("negatives"),
    )


def roc_auc(df: DataFrame, label: str, score: str, positive=1) -> float | None:
    """A18 scalar."""
    return curve_metrics(df, label, score, positive=positive).first()["roc_auc"]


def pr_auc(df: DataFrame, label: str, score: str, positive=1) -> float | None:
    """A19 scalar."""
    return curve_metrics(df, label, score, positive=positive).first()["pr_auc"]


def pr_curve(df: DataFrame, label: str, score: str, by: str | Sequence[str] | None = None, positive=1) -> DataFrame:
    """PR points per distinct threshold (the (0, 1) start point is implicit)."""
    parts = _cols(by)
    pts = _points(curve_table(df, label, score, parts, positive))
    return pts.select(*parts, F.col("score").alias("threshold"), "precision", "recall")


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: str | Sequence[str] | None = None,
              positive=1) -> DataFrame:
    """Confusion counts, precision, recall and F1 at a fixed threshold (``score >= t``)."""
    parts = _cols(by)
    y = F.col(label) == F.lit(positive)
    yhat = F.col(score) >= F.lit(threshold)
    agg = df.groupBy(*parts).agg(
        F.count_if(y & yhat).alias("tp"),
        F.count_if(~y & yhat).alias("fp"),
        F.count_if(y & ~yhat).alias("fn"),
        F.count_if(~y & ~yhat).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return agg.select(
        "*",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0)).alias("f1"),
        F.lit(float(threshold)).alias("threshold"),
    )


def counted_class_weights(df: DataFrame, label: str, out: str = "weight") -> tuple[DataFrame, int]:
    """A17 with its size: ``(label, count, weight)`` rows and the counted number of classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    tot = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("k")).first()
    n, k = int(tot["n"] or 0), int(tot["k"] or 0)
    return counts.withColumn(out, F.lit(float(n)) / (F.lit(float(k)) * F.col("count"))), k


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced class weights ``n / (n_classes * n_c)`` per class."""
    return counted_class_weights(df, label, out)[0]


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach balanced weights as a column; the class table is broadcast behind its counted size."""
    w, k = counted_class_weights(df, label, out)
    return df.join(broadcast_if_small(w.select(label, out), k), on=label, how="left")


def best_model(metrics: DataFrame, by: str = "f1", model: str = "model") -> DataFrame:
    """The model with the highest metric (ties: the smaller name).

    One aggregate: the minimum of ``(-metric, name)`` - an argmax without a sort.
    """
    m = metrics.where(F.col(by).isNotNull())
    top = m.agg(F.min(F.struct((-F.col(by)).alias("k"), F.col(model).alias("name"))).alias("__t"))
    return top.select(F.col("__t.name").alias("best_model"), (-F.col("__t.k")).alias(by))
