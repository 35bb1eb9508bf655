"""Sharding by a two-pass external shuffle (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, drop_columns, hinted, rename_clashes

# Payload bytes of one bucket: what one task holds in memory while it shuffles.
BUCKET_BYTES = 16 << 20


def shard_of(key: Column, n_shards: int, seed: int) -> Column:
    """Rendezvous hashing: the shard whose seeded hash of the key is largest.  One more shard takes only the keys whose
    new hash beats all others, so no row moves between old shards."""
    best = F.array_max(F.array(*[F.struct(F.xxhash64(key, F.lit(seed), F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(n_shards)]))
    return best["i"]


def _numbered(rows: DataFrame, most_bytes: int) -> DataFrame:
    """``rows(row, id, hash, size)`` with ``copy``: 0, or for equal rows of more than ``most_bytes`` together their number
    among the equal ones, whatever the partitions.

    Only those rows are moved.  They are numbered inside their partition of a checkpoint, after the counts of
    the partitions before it, so no task sees more of a group than one partition held.
    """
    groups = cut_lineage(rows.groupBy("id", "hash").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
                         .where((F.col("n") > 1) & (F.col("b") > most_bytes)).select(F.col("id").alias("g_id"), F.col("hash").alias("g_hash")))
    n_groups = groups.count()
    if not n_groups:
        return rows.withColumn("copy", F.lit(0).cast("long"))
    known = hinted(groups, n_groups, 64)
    same = F.col("id").eqNullSafe(F.col("g_id")) & (F.col("hash") == F.col("g_hash"))
    part = cut_lineage(rows.join(known, same, "left_semi")).withColumn("part", F.spark_partition_id())
    at = F.row_number().over(Window.partitionBy("id", "hash", "part").orderBy(F.lit(0)))
    before = F.sum("n").over(Window.partitionBy("id", "hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ahead = part.groupBy("id", "hash", "part").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("id").alias("g_id"), F.col("hash").alias("g_hash"), F.col("part").alias("g_part"), F.coalesce(before, F.lit(0)).alias("ahead"))
    equal = part.withColumn("at", at).join(ahead, same & (F.col("part") == F.col("g_part"))).select("row", "id", "hash", "size", (F.col("ahead") + F.col("at") - 1).alias("copy"))
    return rows.join(known, same, "left_anti").withColumn("copy", F.lit(0).cast("long")).unionByName(equal)


def shuffle_into_shards(df: DataFrame, n_shards: int, bytes_col: str, key: str = "doc_id", seed: int = 42,
                        bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``df`` with ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard`` (the shard under one shard more).

    Pass 1 scatters every record by seeded hashes: to its shard by the key alone, and within the shard to one of the
    buckets by key, contents and - for equal rows of a large part of a bucket - their number among the equal ones, so a
    key of many rows splits over the buckets.  Their number follows from the counted bytes of each shard so that a
    bucket fits in memory.  Pass 2 holds one bucket at a time, puts it in a fixed order, permutes it (``shuffle`` is a Fisher-Yates walk, seeded) and numbers it after the
    buckets before it.  The number of partitions is set by the buckets, so a lost task gives the same order again.

    Columns that hold maps go by the hash of their JSON instead of their values.  Bytes may be null (count 0).  A null key is a key like any other.  Repeated rows are dealt as rows.  Existing
    columns named ``shard``, ``slot`` or ``grown_shard`` are replaced.  An empty table gives an empty result.
    """
    df = drop_columns(df, ["shard", "slot", "grown_shard"])
    cols = [F.col(f"`{c}`") for c in df.columns]
    id_, size = F.col(f"`{key}`"), F.coalesce(F.col(f"`{bytes_col}`"), F.lit(0)).cast("long")
    shard = shard_of(id_, n_shards, seed)
    totals = {r["s"]: r["b"] for r in df.select(shard.alias("s"), (size + 64).alias("b")).groupBy("s").agg(F.sum("b").alias("b")).collect()}
    per_shard = [max(1, -(-totals.get(s, 0) // bucket_bytes)) for s in range(n_shards)]
    loose = [f.name for f in df.schema if "map<" in f.dataType.simpleString()]  # neither hashed nor ordered by Spark
    hashed = [F.to_json(F.struct(c)) if name in loose else c for name, c in zip(df.columns, cols)]
    rows = _numbered(df.select(F.struct(*cols).alias("row"), id_.alias("id"), F.xxhash64(*hashed).alias("hash"), (size + 64).alias("size")), bucket_bytes // 16)
    placed = rows.select(
        "row", "id", "hash", "copy", shard_of(F.col("id"), n_shards, seed).alias("shard"), shard_of(F.col("id"), n_shards + 1, seed).alias("grown_shard"),
        F.xxhash64("id", "hash", "copy", F.lit(seed + 1)).alias("place"),
    ).withColumn("bucket", F.pmod("place", F.element_at(F.array(*[F.lit(n) for n in per_shard]), F.col("shard") + 1)).cast("int")).drop("place")
    n_buckets = sum(per_shard)
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = cut_lineage(counts.select(
        F.col("shard").alias("s"), F.col("bucket").alias("b"),
        F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"),
    ))
    if loose:
        def order(a, b):
            left, right = (F.struct(x["id"], x["hash"], x["copy"]) for x in (a, b))
            return F.when(left < right, -1).when(left > right, 1).otherwise(0)

        fixed = F.array_sort(F.collect_list(F.struct("id", "grown_shard", "row", "hash", "copy")), order)
    else:
        fixed = F.sort_array(F.collect_list(F.struct("id", "grown_shard", "row")))
    buckets = (
        placed.repartition(n_buckets, "shard", "bucket")
        .groupBy("shard", "bucket").agg(fixed.alias("rows"))
        .sortWithinPartitions("shard", "bucket")
        .select("shard", "bucket", F.shuffle("rows", seed).alias("rows"))
        .select("shard", "bucket", F.posexplode("rows").alias("at", "rec"))
    )
    out = buckets.join(hinted(ahead, n_buckets, 32), (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
    return out.select(
        *[F.col("rec.row").getField(c).alias(c) for c in df.columns], "shard",
        (F.col("ahead") + F.col("at")).cast("long").alias("slot"), F.col("rec.grown_shard").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, n_shards: int = 24, seed: int = 42) -> DataFrame:
    """The contract's columns under the law ``key``; only ids, sizes and checksums are moved."""
    base = rename_clashes(docs, ["doc_id", "text"])
    text = F.coalesce(F.col("text"), F.lit(""))
    refs = cut_lineage(base.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")))
    out = shuffle_into_shards(refs, n_shards, "size", "doc_id", seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
