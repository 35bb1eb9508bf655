import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import llm_data
from rareclass.llm import mixing, sharding

MIX = {"weights": [3, 1, 2], "share": 1.5, "max_repeat": 2.0}
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes: dict, weights, share, most):
    """Targets by sharing out the excess again and again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        target = {s: most * sizes[s] for s in full} | {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if target[s] > most * sizes[s] or sizes[s] == 0}
        if not over:
            return target
        full |= over


def test_targets_and_copies(spark):
    rows = llm_data.rows(2, 120)
    got = mixing.mix_digest(llm_data.docs(spark, seed=2, n=120), **MIX).collect()
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    size = {r[0]: len(SPACE.findall(r[1] or "")) for r in rows}
    totals = Counter()
    for r in rows:
        totals[r[3]] += size[r[0]]
    want = fill(totals, **{"weights": [3, 1, 2], "share": 1.5, "most": 2.0})
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == totals[s]
        assert r["target"] == pytest.approx(want[s])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in totals:
        assert abs(taken[s] - want[s]) <= largest[s] + 1


def test_mix_agrees_with_its_plan_and_reruns(spark):
    docs = llm_data.docs(spark, seed=4)
    plan = {}
    for r in mixing.mix_plan(docs, **MIX).collect():
        plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["copies"]
    out = mixing.mix(docs, **MIX)
    assert out.columns == docs.columns
    first = Counter(r["doc_id"] for r in out.collect())
    assert first == Counter({k: v for k, v in plan.items() if v})
    assert first == Counter(r["doc_id"] for r in mixing.mix(docs.repartition(7), **MIX).collect())


def test_mix_hot_source_spreads(spark):
    """Most rows in one source: the ranks still come from many partitions, and the target is met."""
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 50 as int))").alias("text"),
                                  F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("source"))
    got = mixing.mix_plan(df, [1.0, 3.0], 1.0).groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["source"]: r["n"] for r in got} == {"hot": 4800, "cold": 1200}
    for r in got:
        assert abs(r["taken"] - r["target"]) <= 50


def test_mix_empty(spark):
    assert mixing.mix_digest(llm_data.empty(spark), **MIX).count() == 0
    assert mixing.mix(llm_data.empty(spark), **MIX).count() == 0


def check_laws(rows, n):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], n)
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


@pytest.mark.parametrize("bucket_bytes", [sharding.BUCKET_BYTES, 200])
def test_shards_hold_every_row_once(spark, bucket_bytes):
    docs = llm_data.docs(spark, seed=6)
    sized = docs.withColumn("bytes", F.octet_length("text"))
    out = sharding.shuffle_into_shards(sized, 5, "bytes", bucket_bytes=bucket_bytes)
    rows = out.collect()
    assert set(out.columns) == set(sized.columns) | {"grown_shard"}
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r[0], r[1]) for r in llm_data.rows(6))
    check_laws(rows, 5)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_id.values())
    again = sharding.shuffle_into_shards(sized.repartition(5), 5, "bytes", bucket_bytes=bucket_bytes)
    key = lambda r: (r["shard"], r["slot"], str(r["doc_id"]))
    assert sorted(map(key, rows)) == sorted(map(key, again.collect()))


def test_hot_and_null_ids_split_over_buckets(spark):
    """A third of all rows under one id, a third without an id, in part equal rows: no bucket takes much more than its bytes."""
    df = spark.range(6000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).cast("long").alias("doc_id"), F.lit(100).alias("b"),
        F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    out = sharding.shuffle_into_shards(df, 3, "b", bucket_bytes=164 * 100)
    sizes = [len(p) for p in out.rdd.glom().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 1000
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in df.collect())
    check_laws(rows, 3)
    again = sharding.shuffle_into_shards(df.repartition(4), 3, "b", bucket_bytes=164 * 100).collect()
    key = lambda r: (r["shard"], r["slot"], str(r["doc_id"]), r["text"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_growing_moves_rows_only_to_the_new_shard(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(1).alias("b"))
    before = {r["doc_id"]: r for r in sharding.shuffle_into_shards(df, 6, "b").collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.shuffle_into_shards(df, 7, "b").collect()}
    assert all(after[i] == r["grown_shard"] for i, r in before.items())
    moved = sum(after[i] != r["shard"] for i, r in before.items())
    assert 300 < moved < 560


def test_order_is_shuffled(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(1).alias("b"))
    rows = sorted(sharding.shuffle_into_shards(df, 1, "b").collect(), key=lambda r: r["slot"])
    ids = [r["doc_id"] for r in rows]
    rises = sum(a < b for a, b in zip(ids, ids[1:]))
    assert 900 < rises < 1100


def test_digest_and_written_shards(spark, tmp_path):
    rows = sharding.shard_digest(llm_data.docs(spark), 24).collect()
    import zlib
    text = {}
    for r in llm_data.rows():
        text[r[0]] = r[1]
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "key"
    check_laws(rows, 24)
    assert sharding.shard_digest(llm_data.empty(spark)).count() == 0
    out = sharding.shuffle_into_shards(llm_data.docs(spark).withColumn("b", F.lit(1)), 3, "b")
    sharding.write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == out.count() and back.select("shard").distinct().count() == 3


def test_map_columns(spark):
    """Maps can be neither hashed nor ordered; rows that hold them are still dealt, alike in every run."""
    docs = llm_data.docs(spark, seed=6).select("doc_id", "text", F.octet_length("text").alias("bytes")).withColumn(
        "tags", F.when(F.col("doc_id") % 3 != 0, F.create_map(F.lit("k"), F.col("text"), F.lit("n"), F.col("doc_id").cast("string"))))
    docs = docs.withColumn("deep", F.array(F.struct(F.col("tags").alias("t"))))
    for bucket_bytes in (sharding.BUCKET_BYTES, 200):
        rows = sharding.shuffle_into_shards(docs, 5, "bytes", bucket_bytes=bucket_bytes).collect()
        again = sharding.shuffle_into_shards(docs.repartition(5), 5, "bytes", bucket_bytes=bucket_bytes).collect()
        key = lambda r: (r["shard"], r["slot"], str(r["doc_id"]), str(r["text"]), str(r["tags"]))
        assert sorted(map(key, rows)) == sorted(map(key, again))
        assert Counter((r["doc_id"], r["text"], str(r["tags"])) for r in rows) == Counter((r["doc_id"], r["text"], str(r["tags"])) for r in docs.collect())
        check_laws(rows, 5)
