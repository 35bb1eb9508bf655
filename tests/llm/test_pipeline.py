"""The pipeline's stages against plain Python, on a small table with planted cases."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
import llm_data
from rareclass.llm import decontam, simhash, toxicity

INSULTS = ["moron", "idiot", "scum"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """documents, labels and benchmark as Parquet: toxic texts, near copies, leaks, nulls, empty and blank texts."""
    rng = random.Random(12)
    items = [(i, llm_data.words(rng, 30)) for i in range(4)]
    docs, labels = [], []
    for i in range(300):
        words = llm_data.words(rng, rng.randint(30, 90)).split()
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        if i % 29 == 5:
            words[10:10] = items[i % 4][1].split()
        docs.append((i, " ".join(words), "en", f"src{i % 4}" if i % 50 else None, 0))
        labels.append((i, 1, toxic))
    docs += [(1000 + i, docs[7][1], "en", "src0", 0) for i in range(20)]
    docs += [(1100 + i, docs[8][1] + f" {i}", "en", "src1", 0) for i in range(5)]
    docs += [(1200, None, None, None, None), (1201, "", "en", "src1", 0), (1202, "  \n", "en", "src2", 0)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(docs, llm_data.SCHEMA).repartition(4).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def test_stages(spark, sf_dir):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_duplicates", "benchmark_decontamination", "source_mixing", "sharding"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}

    clean = P.toxicity_stage(spark, docs, sf_dir)
    assert clean.columns == docs.columns
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r["doc_id"] for r in clean.collect()}
    assert kept == {i for i, r in rows.items() if model.score(r["text"]) < 0.5}
    assert kept == {i for i, r in rows.items() if not set((r["text"] or "").split()) & set(INSULTS)}

    single = P.near_duplicates_stage(spark, clean, sf_dir)
    assert single.columns == docs.columns
    prints = {i: simhash.fingerprint(rows[i]["text"]) for i in kept}
    left, group = sorted(kept), {}
    for i in left:
        if i not in group:
            stack = [i]
            while stack:
                a = stack.pop()
                if a in group:
                    continue
                group[a] = i
                stack += [b for b in left if b not in group and (prints[a] ^ prints[b]).bit_count() <= 4]
    kept = {r["doc_id"] for r in single.collect()}
    assert kept == {i for i, g in group.items() if i == g}

    fair = P.decontamination_stage(spark, single, sf_dir)
    assert fair.columns == docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    index = decontam.SeedIndex(items)
    hit = dict(zip(sorted(kept), index.hits([rows[i]["text"] for i in sorted(kept)])))
    planted = {i for i in kept if i < 300 and i % 29 == 5}
    kept = {r["doc_id"] for r in fair.collect()}
    assert kept == {i for i, h in hit.items() if not h} and not kept & planted

    mixed = P.mixing_stage(spark, fair, sf_dir)
    assert mixed.columns == docs.columns
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert set(times) <= kept and max(times.values()) <= 2

    out = P.sharding_stage(spark, mixed, sf_dir).collect()
    assert Counter(r["doc_id"] for r in out) == times
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["text"] == rows[r["doc_id"]]["text"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_equals_the_stages_and_reruns(spark, sf_dir):
    key = lambda r: (r["shard"], r["slot"], str(r["doc_id"]))
    first = sorted(map(key, P.run(spark, sf_dir).collect()))
    assert first and first == sorted(map(key, P.run(spark, sf_dir).collect()))


def test_empty_and_wide_tables(spark, sf_dir):
    empty, wide = llm_data.empty(spark), llm_data.docs(spark)
    for _, stage in P.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
        assert stage(spark, wide, sf_dir).count() > 0
