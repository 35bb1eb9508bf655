"""Mixing sources to target weights by systematic sampling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, hinted, rename_clashes, shuffle_partitions, word_count

# Expected copies are fixed-point numbers with this many fraction bits, so prefix sums are exact longs.
FRACTION_BITS = 24


def source_targets(sizes: DataFrame, weights: list[float], share: float, max_repeat: float) -> DataFrame:
    """``source, source_size, target`` from ``sizes(source, size)``.

    Sources in code-point order (null last) take ``weights`` in turn and share ``share`` x the size of all; a target
    stops at ``max_repeat`` x its source's size and the excess goes to the others by weight.  That fixed point is
    ``target = least(cap, level * weight)``; with sources in order of cap / weight the level follows from two running
    sums.  The windows run over one row per source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = by.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    by = by.withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    by = by.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(whole).cast("double"))
    by = by.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    by = by.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    by = by.withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(whole))
    return by.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def mix_plan(docs: DataFrame, weights: list[float], share: float = 1.0, max_repeat: float = 2.0, seed: int = 42,
             key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies``.

    Every document of a source expects ``target / source_size`` copies.  Documents of a source stand in order of size
    (ties by id), the expected copies are prefix-summed, one seeded offset per source is added, and a document is
    taken once for every integer boundary its stretch crosses.  The order by size makes the words taken come near the
    target.  The prefix sum is distributed: rows are range-partitioned by (source, size, id), so a source that holds a
    third of all rows spreads over many partitions, and only one count per (partition, source) is summed up.

    A null or blank text has size 0; a null source is a source of its own; repeated rows are documents of their own;
    an empty table gives an empty plan; columns other than the three named are not read.
    """
    spark = docs.sparkSession
    base = rename_clashes(docs, [key, source, text]).toDF("doc_id", "source", "text")
    sizes = cut_lineage(base.select("doc_id", "source", word_count("text").alias("size")))
    targets = cut_lineage(source_targets(sizes, weights, share, max_repeat))
    n_sources = targets.count()
    order = ["source", "size", "doc_id"]
    # spark_partition_id and the running row id are read off a frame that is then written, so they never change
    ranked = cut_lineage(
        sizes.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("line"))
    )
    counts = ranked.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("first_line"))
    parts = cut_lineage(
        counts.withColumn("ahead", F.coalesce(F.sum("n").over(
            Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(hinted(targets, n_sources, 96).withColumnRenamed("source", "target_source"), F.col("source").eqNullSafe(F.col("target_source")))
        .select(F.col("source").alias("part_source"), F.col("part").alias("part_id"), "first_line", "ahead", "source_size", "target")
    )
    out = ranked.join(hinted(parts, parts.count(), 128), (F.col("part") == F.col("part_id")) & F.col("source").eqNullSafe(F.col("part_source")))
    one = 1 << FRACTION_BITS
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * one)).otherwise(F.lit(0)).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}#"), F.coalesce(F.col("source"), F.lit("<null>")))), 1, 6), 16, 10).cast("long")
    rank = F.col("ahead") + F.col("line") - F.col("first_line")
    crossed = lambda n: F.shiftright(offset + rate * n, FRACTION_BITS)
    return out.select("doc_id", "source", "size", "source_size", "target", (crossed(rank + 1) - crossed(rank)).alias("copies"))


def mix(docs: DataFrame, weights: list[float], share: float = 1.0, max_repeat: float = 2.0, seed: int = 42,
        key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: every column of ``docs``, a document as often as :func:`mix_plan` takes it.

    Rows that agree in id, source and size share their copies evenly, in order of the text's hash.
    """
    plan = mix_plan(docs, weights, share, max_repeat, seed, key, source, text)
    plan = cut_lineage(plan.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies")))
    plan = plan.select(*[F.col(c).alias(f"__mix_{c}") for c in plan.columns])
    ids = [F.col(f"`{key}`").eqNullSafe(F.col("__mix_doc_id")), F.col(f"`{source}`").eqNullSafe(F.col("__mix_source")), word_count(text) == F.col("__mix_size")]
    joined = docs.join(plan.where("__mix_copies > 0"), ids[0] & ids[1] & ids[2])
    times = F.col("__mix_copies")
    if plan.where("__mix_rows > 1").limit(1).count():
        turn = Window.partitionBy("__mix_doc_id", "__mix_source", "__mix_size").orderBy(F.xxhash64(F.col(f"`{text}`")))
        joined = joined.withColumn("__mix_turn", F.row_number().over(turn))
        times = F.floor(F.col("__mix_copies") / F.col("__mix_rows")) + (F.col("__mix_turn") <= F.col("__mix_copies") % F.col("__mix_rows")).cast("long")
    return (
        joined.withColumn("__mix_times", times.cast("int")).where("__mix_times > 0")
        .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_times"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def mix_digest(docs: DataFrame, weights: list[float], share: float, max_repeat: float, seed: int = 42) -> DataFrame:
    """The contract's columns, and ``copies``."""
    plan = mix_plan(docs, weights, share, max_repeat, seed)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
