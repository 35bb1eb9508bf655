"""How sure a ranking metric is: Poisson bootstrap bounds, and DeLong's paired test of two models."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import broadcast_if_small, prefix_sum, range_boundaries, with_range_bucket

# A row's weight in a replicate is the number of these that its 32-bit hash reaches: the distribution function of a
# Poisson(1) variable at 0, 1, ..., 12, times 2^32.
POISSON_CUTS = [int(2 ** 32 * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(13)]

# Distinct scores that a task holds before it passes them on, and bytes of weights of a range bucket on average.
TASK_SCORES = 20_000
BUCKET_BYTES = 64 << 20

# The error function by Abramowitz and Stegun 7.1.26 (off by 1.5e-7 at most).
ERF_P = 0.3275911
ERF_A = [0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429]


def poisson_weights(key: Sequence[str], replicates: int, seed: int = 42) -> Column:
    """The weights of a row in all replicates, an array of ints; one digest gives four.

    The weight of replicate r comes from hex digits 8 * (r mod 4) to 8 * (r mod 4) + 7 of ``md5(key#seed#(r div 4))``,
    key columns as text joined by ``#`` (null: empty), so a row weighs alike wherever and however often it is read.
    """
    name = F.concat_ws("#", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key], F.lit(str(seed)))
    cuts = F.array(*[F.lit(c).cast("long") for c in POISSON_CUTS])

    def four(block: Column) -> Column:
        digest = F.md5(F.concat(name, F.lit("#"), block.cast("string")))
        parts = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
        return F.transform(F.array(*parts), lambda u: F.size(F.filter(cuts, lambda c: u >= c)))

    blocks = F.sequence(F.lit(0), F.lit((replicates - 1) // 4))
    return F.slice(F.flatten(F.transform(blocks, four)), 1, replicates)


def _collapsed(score: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct scores, ascending (NaN last), and their summed rows of weights."""
    by = np.argsort(score, kind="stable")
    score = score[by]
    start = np.flatnonzero(np.r_[True, (score[1:] != score[:-1]) & ~(np.isnan(score[1:]) & np.isnan(score[:-1]))])
    return score[start], np.add.reduceat(p[by], start, axis=0), np.add.reduceat(q[by], start, axis=0)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(matrix).ravel()))


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _score_weights(replicates: int):
    """Per task: ``score, p, q``, the weights of a score's positives and negatives in every replicate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array(found[0]), _lists(found[1]), _lists(found[2])], names=["score", "p", "q"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            w, y = _matrix(batch.column("w"), replicates).astype(np.int64), batch.column("y").to_numpy(zero_copy_only=False)[:, None]
            own = (batch.column("score").to_numpy(zero_copy_only=False), w * y, w * (1 - y))
            held = _collapsed(*(own if held is None else [np.concatenate(x) for x in zip(held, own)]))
            if len(held[0]) > TASK_SCORES:
                yield batch_of(held)
                held = None
        if held is not None:
            yield batch_of(held)

    return run


def _curve_sums(replicates: int, ahead: dict[int, np.ndarray], totals: np.ndarray):
    """A bucket's share of every replicate's ROC-AUC and PR-AUC; ``ahead`` holds the weights of all higher scores."""

    def run(table: pa.Table) -> pa.Table:
        _, p, q = _collapsed(table.column("score").to_numpy(), _matrix(table.column("p"), replicates), _matrix(table.column("q"), replicates))
        p, q = p[::-1], q[::-1]
        start = ahead[table.column("__bucket")[0].as_py()]
        tp, fp = start[0] + np.cumsum(p, axis=0), start[1] + np.cumsum(q, axis=0)
        before, seen = tp - p + fp - q, np.maximum(tp + fp, 1)
        precision = np.where(before > 0, (tp - p) / np.maximum(before, 1), 1.0) + tp / seen
        with np.errstate(invalid="ignore", divide="ignore"):
            roc = (q * (tp - p / 2)).sum(axis=0) / (totals[0].astype(float) * totals[1])
            pr = (p * precision / 2).sum(axis=0) / totals[0]
        return pa.table({"roc": _lists(roc[None]), "pr": _lists(pr[None])})

    return run


def bootstrap_replicates(df: DataFrame, label: str, score: str, key: Sequence[str], replicates: int = 100, seed: int = 42,
                         positive=1) -> DataFrame:
    """``replicate, roc_auc, pr_auc``: the exact curve metrics of every replicate (A18, A19 with weighted rows).

    Rows are not copied: a row carries its weights as one array, and each task sums them by distinct score (a score of
    many rows is a few sums).  Scores meet in range buckets of a bounded size, whose totals give each bucket the weights
    of all higher scores; a bucket returns two numbers a replicate, and buckets x replicates numbers reach the driver.
    Rows without a score take no part; a replicate that misses a class has no ROC-AUC, without positives no PR-AUC.
    """
    if replicates < 1:
        raise ValueError("at least one replicate")
    y = (F.col(label) == F.lit(positive)).cast("int")
    rows = df.where(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("score"), F.coalesce(y, F.lit(0)).alias("y"),
                                                     poisson_weights(key, replicates, seed).alias("w"))
    counts = cut_lineage(rows.mapInArrow(_score_weights(replicates), "score double, p array<long>, q array<long>"))
    n = counts.count()
    bounds = range_boundaries(counts, F.col("score"), max(1, -(-n * replicates * 16 // BUCKET_BYTES)))
    bucketed = with_range_bucket(counts, F.col("score"), bounds, descending=True)

    def total(table: pa.Table) -> pa.Table:
        sums = [_lists(_matrix(table.column(c), replicates).sum(axis=0)[None]) for c in "pq"]
        return pa.table({"b": table.column("__bucket")[:1].cast(pa.int32()), "p": sums[0], "q": sums[1]})

    found = bucketed.groupBy("__bucket").applyInArrow(total, "b int, p array<long>, q array<long>").collect()
    ahead, totals = {}, np.zeros((2, replicates), np.int64)
    for r in sorted(found, key=lambda r: r["b"]):
        ahead[r["b"]] = totals.copy()
        totals += np.array([r["p"], r["q"]])
    sums = np.zeros((2, replicates))
    for r in bucketed.groupBy("__bucket").applyInArrow(_curve_sums(replicates, ahead, totals), "roc array<double>, pr array<double>").collect():
        sums += np.nan_to_num(np.array([r["roc"], r["pr"]]))
    values = [(r, float(sums[0, r]) if totals[:, r].all() else None, float(sums[1, r]) if totals[0, r] else None) for r in range(replicates)]
    return df.sparkSession.createDataFrame(values, "replicate int, roc_auc double, pr_auc double")


def bootstrap_bounds(df: DataFrame, label: str, score: str, key: Sequence[str], replicates: int = 100, seed: int = 42, level: float = 0.95,
                     positive=1) -> DataFrame:
    """``metric, mean, std_error, lower, upper, replicates``: percentile bounds of ROC-AUC and PR-AUC over the replicates
    in which they exist (interpolated quantiles)."""
    found = bootstrap_replicates(df, label, score, key, replicates, seed, positive)
    long = found.unpivot(["replicate"], ["roc_auc", "pr_auc"], "metric", "value")
    tail = (1 - level) / 2
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std_error"), F.percentile("value", F.lit(tail)).alias("lower"),
        F.percentile("value", F.lit(1 - tail)).alias("upper"), F.count("value").alias("replicates"))


def normal_tails(z: Column) -> Column:
    """Two-sided p value of a standard normal ``z``."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + ERF_P * x)
    series = F.lit(0.0)
    for a in reversed(ERF_A):
        series = (series + a) * t
    return series * F.exp(-x * x)


def delong_test(df: DataFrame, label: str, score_a: str, score_b: str, positive=1) -> DataFrame:
    """One row ``auc_a, auc_b, difference, variance, z, p_value``: are two models' ROC-AUCs on the same rows different
    (DeLong, DeLong & Clarke-Pearson 1988)?

    A positive's structural component is the share of negatives that its score beats, a negative's the share of
    positives that beat it, ties one half: both are mid-ranks, read off the distributed prefix sums of each model's score
    counts.  Rows are counted by (class, both scores) before they meet the two tables, and the covariances of the
    components are one aggregate.  Rows without one of the scores take no part.  Without both classes everything is
    NULL; with one row of a class its covariance counts 0, and without any variance z and the p value are NULL.
    """
    y = F.coalesce((F.col(label) == F.lit(positive)).cast("int"), F.lit(0))
    paired = df.where(F.col(score_a).isNotNull() & F.col(score_b).isNotNull()).select(
        y.alias("y"), F.col(score_a).cast("double").alias("a"), F.col(score_b).cast("double").alias("b"))
    rows = cut_lineage(paired.groupBy("y", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    for side in "ab":
        counts = rows.groupBy(F.col(side).alias("score")).agg(F.sum(F.col("n") * F.col("y")).alias("p"), F.sum(F.col("n") * (1 - F.col("y"))).alias("q"))
        ranks = _components(counts).select(F.col("score").alias(side), F.col("v10").alias(f"v10_{side}"), F.col("v01").alias(f"v01_{side}"))
        ranks = cut_lineage(ranks)
        rows = rows.join(broadcast_if_small(ranks, ranks.count()), side)
    sums = []
    for cls, v in ((1, "v10"), (0, "v01")):
        n = F.when(F.col("y") == cls, F.col("n")).otherwise(0)
        a, b = F.col(f"{v}_a"), F.col(f"{v}_b")
        sums += [F.sum(n).alias(f"n{cls}"), F.sum(n * a).alias(f"a{cls}"), F.sum(n * b).alias(f"b{cls}"), F.sum(n * (a - b) * (a - b)).alias(f"d{cls}")]
    s = rows.agg(*sums)

    def variance(cls: int) -> Column:
        """Sample variance of the differences of a class's components, over its size."""
        n, gap = F.col(f"n{cls}"), F.col(f"a{cls}") - F.col(f"b{cls}")
        return F.when(n > 1, F.try_divide(F.col(f"d{cls}") - gap * F.try_divide(gap, n), n - 1) / n).otherwise(F.when(n == 1, F.lit(0.0)))

    auc = s.select(F.try_divide("a1", "n1").alias("auc_a"), F.try_divide("b1", "n1").alias("auc_b"), "n0", "n1", (variance(1) + variance(0)).alias("variance"))
    auc = auc.where("n0 is not null").select(*[F.when((F.col("n0") > 0) & (F.col("n1") > 0), F.col(c)).alias(c) for c in ("auc_a", "auc_b", "variance")])
    auc = auc.withColumn("difference", F.col("auc_a") - F.col("auc_b"))
    z = F.when(F.col("variance") > 1e-18, F.try_divide("difference", F.sqrt("variance")))
    return auc.withColumn("z", z).withColumn("p_value", normal_tails(F.col("z"))).select("auc_a", "auc_b", "difference", "variance", "z", "p_value")


def _components(counts: DataFrame) -> DataFrame:
    """``score, v10, v01`` from ``counts(score, p, q)``."""
    grand: dict = {}
    cum = prefix_sum(cut_lineage(counts), [F.col("score").desc()], F.col("score"), ["p", "q"], descending=True, grand=grand)
    n_pos, n_neg = (F.lit(float(grand.get(c) or 0)) for c in "pq")
    return cum.select("score", F.try_divide(n_neg - F.col("q_cum") + F.col("q") / 2, n_neg).alias("v10"),
                      F.try_divide(F.col("p_cum") - F.col("p") / 2, n_pos).alias("v01"))
