"""Helpers shared by the operators: inputs, checked broadcasts, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage, ship_package, shuffle_partitions
from ..sources.io import table

__all__ = [
    "BROADCAST_BYTES", "checkpoint_dir", "connected_components", "cut_lineage", "drop_columns", "hinted", "rename_clashes",
    "ship_package", "shuffle_partitions", "table", "word_count", "SPACE_CHARS",
]

# Most bytes (counted rows x stated width) that is ever broadcast by a hint.
BROADCAST_BYTES = 16 << 20

# ASCII white space of the word rule: space and U+0009 to U+000D.
SPACE_CHARS = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> F.Column:
    """Number of words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(SPACE_CHARS)), F.lit(0)).cast("long")


def hinted(df: DataFrame, rows: int, width: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is within the bound; otherwise Spark's shuffled join is left."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add (names compare as Spark does, without case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def rename_clashes(df: DataFrame, keep: list[str]) -> DataFrame:
    """Only the columns ``keep`` of ``df``: other columns, whatever their names, cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in keep])


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: ``links(a, b)`` long -> ``node, root`` for every linked node.

    ``root`` is the smallest node of the component.  Alternates two rounds of joins (large star, small star): each
    node's smallest neighbour is a grouped minimum (combined map-side, so a hub is cheap), and every neighbour is
    re-linked to it, until the links stop changing.  Links never reach the driver; each round is cut with a checkpoint.
    """
    def summary(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")).first()

    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = summary(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = cut_lineage(
            small.select(F.col("a"), F.col("m").alias("b"))
            .unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        now = summary(edges)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
