import itertools
import random
from collections import Counter

import numpy as np
import pytest

import llm_data
from rareclass.llm import simhash as S
from rareclass.llm.common import connected_components


def plain_print(text):
    import xxhash

    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius):
    n, root = len(prints), list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(n), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint_is_the_plain_one(spark):
    for _, text, *_ in llm_data.rows():
        assert S.fingerprint(text) == plain_print(text)
    from pyspark.sql import functions as F

    h = spark.createDataFrame([("Née ½ x y".lower(),)], "t string").select(F.xxhash64("t")).first()[0]
    assert S.fingerprint("Née ½ x y") == h & (1 << 64) - 1  # one shingle: its XXH64


@pytest.mark.parametrize("free", [(1 << 64) - 1, 0xFFFF0000FFFF])
def test_masks_cover_every_pair_within_the_radius(free):
    bits = [i for i in range(64) if free >> i & 1]
    for radius in (2, 4):
        masks = S.covering_masks(radius, free)
        assert len(masks) == 2 ** (radius + 1) - 1 and all(not m & ~free for m in masks)
        rng = random.Random(radius)
        for _ in range(3000):
            diff = sum(1 << b for b in rng.sample(bits, radius))
            assert any(not m & diff for m in masks)


@pytest.mark.parametrize("limit", [S.BUCKET_LIMIT, 3])
def test_components_against_all_pairs(spark, limit):
    rng = random.Random(8)
    prints = []
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.append(x)
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
    prints = sorted({S._signed(p) for p in prints})
    links = S.near_links(spark.createDataFrame([(p,) for p in prints], "fp long").repartition(3), 4, limit)
    assert links.where("bit_count(a ^ b) > 4").count() == 0
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    want = components([p & (1 << 64) - 1 for p in prints], 4)
    label = {}
    for p, w in zip(prints, want):
        assert label.setdefault(w, got.get(p, p)) == got.get(p, p)
    assert len(set(label.values())) == len(label)


def test_groups_of_documents(spark):
    rows = llm_data.rows()
    got = S.simhash_digest(llm_data.docs(spark)).collect()
    assert len(got) == len(rows)
    prints = [plain_print(r[1]) for r in rows]
    comp = components(prints, 4)
    least = {}
    for r, c in zip(rows, comp):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted((str(r[0]), f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, comp))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want
    assert S.simhash_digest(llm_data.empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = llm_data.docs(spark)
    kept = S.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    groups = S.simhash_groups(docs).where("doc_id = component_id").select("doc_id").distinct().collect()
    assert sorted(i for i in ids if i is not None) == sorted(r["doc_id"] for r in groups) and ids.count(None) == 1


def test_repeated_and_null_ids_lose_no_text(spark):
    """Rows without an id all stay; two texts under one id are two documents; a near copy under another's id goes."""
    rng = random.Random(6)
    a, b, c, d = (" ".join(str(rng.random()) for _ in range(400)) for _ in range(4))
    rows = [(1, a, "x"), (1, b, "x"), (1, a, "x"), (2, a, "x"), (2, c, "x"), (3, c, "x"), (None, a, "x"), (None, d, "x"), (None, d, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = Counter((r["doc_id"], r["text"]) for r in S.drop_near_copies(docs).collect())
    assert got == Counter([(1, a), (1, b), (2, c), (None, a), (None, d), (None, d)])


def test_long_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300))


def test_spanning_links_lose_nothing():
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 1 << 12, 300).astype(np.uint64))
    links = S.spanning_links(prints, 2)
    assert len(links) < len(prints)
