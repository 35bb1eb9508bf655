import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import docs, empty, rows
from pyspark.sql import functions as F

from rareclass.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, k):
    held = [(i, Counter(plain_terms(t))) for i, t in documents if plain_terms(t)]
    n_docs, occurrences = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // occurrences
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(plain_terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(0, "Th er On, the-in! the"), (1, None), (2, ""), (3, "nosuchtermatall"), (4, "the same ROW twice NÉE née ½ 中文 x"), (None, "here no id"), (5, rows()[3][1]), (6, "... ,,")]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("k,item_bytes", [(50, L.ITEM_BYTES), (3, 200), (1, L.ITEM_BYTES)])
def test_search_against_brute_force(spark, k, item_bytes):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, score string")
    got = found(L.search(docs(spark), items, k, item_bytes=item_bytes))
    assert got == brute([r[:2] for r in rows()], ITEMS, k)


def test_small_blocks_hot_copies_and_ties(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, weights=range(1, 61), k=rng.randint(1, 60))) for _ in range(150)]
    table = [(i, texts[0] if i % 3 == 0 else texts[i % 150]) for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=8))) for i in range(12)] + [(99, texts[0])]
    monkeypatch.setattr(L, "BLOCK_DOCS", 16)
    got = found(L.search(spark.createDataFrame(table, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), 20))
    assert got == brute(table, items, 20)


def test_no_rows(spark):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert L.search(empty(spark), items).count() == 0
    assert L.search(docs(spark), items.limit(0)).count() == 0
    assert L.search(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), items).count() == 0


def test_bounds_hold_and_exclude(spark):
    """No bound is below the exact score, and most documents are excluded by the floor of the best."""
    rng = random.Random(3)
    words = [f"t{i}" for i in range(800)]
    table = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(800)], k=rng.randint(5, 200)))) for i in range(600)]
    frame = spark.createDataFrame(table, "doc_id long, text string")
    index = L.build_index(frame)
    items = [(q, " ".join(rng.choices(words, k=10))) for q in range(10)]
    facts = {"docs": 600, "terms": sum(len(plain_terms(t)) for _, t in table)}
    question, names = L._ask(frame, items, facts, L.document_frequencies)
    exact = {(q, i): s for q, _, i, s in brute(table, items, 10 ** 6)}
    kept = 0
    for block in (r.asDict() for r in index.collect()):
        bounds = L.upper_bounds(block, question, L._hashes(question.vocabulary, {}))
        for q, item in enumerate(names):
            tenth = sorted((s for (p, _), s in exact.items() if p == item), reverse=True)[:10][-1]
            for i, bound in zip(block["ids"], bounds[q]):
                assert bound >= exact.get((item, i), 0)
            kept += int((bounds[q] >= tenth).sum())
    assert kept < 0.1 * 600 * len(names)


def test_terms():
    for text in ("A-b_C dÉ É\x1fz\x7f½2", "", None, "\n\t", "a" * 10, "x😀y z"):
        assert [t.decode() for t in L.terms(text)] == plain_terms(text)


def test_share_grows_with_count():
    tf = np.arange(1, 2000)
    for m in (50, 100, 10 ** 6):
        share = L._share(tf, m)
        assert (np.diff(share) >= 0).all() and share[-1] < 10 ** 6


def test_index_holds_every_document_with_a_term(spark):
    ids = L.build_index(docs(spark)).select(F.explode("ids").alias("i")).collect()
    assert sorted(str(r["i"]) for r in ids) == sorted(str(i) for i, t, *_ in rows() if plain_terms(t))
