import itertools
import random

import pytest

import llm_data
from rareclass.llm import decontam as D


@pytest.mark.parametrize("length", [1, 3, 5, 9, 10, 12, 13])
def test_masks_hit_every_window_with_the_allowed_substitutions(length):
    wrong = int(length * 0.2 + 1e-9) if length < D.WINDOW else 2
    masks = D.masks_for(length)
    for bad in itertools.combinations(range(length), wrong):
        assert any(all(at + i not in bad for i, c in enumerate(m) if c == "1") for m in masks for at in range(length - len(m) + 1))


def brute(texts, items):
    out = []
    for t, text in enumerate(texts):
        words = D.words_of(text)
        for item, body in items:
            own = D.words_of(body)
            if len(own) < D.PASSAGE_WORDS:
                if own and own == words:
                    out.append((t, item, len(own)))
                continue
            best, window = 0, min(D.WINDOW, len(own))
            for shift in range(-len(own), len(words)):
                same = [0 <= shift + j < len(words) and words[shift + j] == w for j, w in enumerate(own)]
                best = max(best, max(sum(same[a:a + window]) for a in range(len(own) - window + 1)))
            if best >= 0.8 * window:
                out.append((t, item, best))
    return out


def passage(rng, n):
    return [f"{rng.choice('abcdefghij')}{rng.randint(0, 9)}" for _ in range(n)]


def test_overlaps_against_brute_force():
    rng = random.Random(5)
    items = [(i, " ".join(passage(rng, n))) for i, n in enumerate([30, 13, 12, 9, 6, 4, 40, 1])] + [(20, ""), (21, "...")]
    items += [(22, "the"), (23, "The!"), (24, "four words of it")]
    texts = ["", None, "a b c", "the", "of the people", "Four words, of it.", "four words of it all"]
    for i, body in items[:7]:
        w = body.split()
        for changed in range(0, 5):
            v = list(w)
            for j in rng.sample(range(len(v)), min(changed, len(v))):
                v[j] = "zz"
            texts.append(" ".join(passage(rng, 5) + v + passage(rng, 8)))
        texts.append(" ".join(w[len(w) // 3:]).upper() + "!")
        texts.append(", ".join(w[:18]))
    got = [(t, h["item_id"], h["matched"]) for t, hits in enumerate(D.SeedIndex(items).hits(texts, slice_chars=50)) for h in hits]
    assert got == brute(texts, items)


def test_documents_and_blocks(spark):
    rng = random.Random(2)
    item = " ".join(llm_data.words(rng, 25).split())
    spoilt = item.split()
    spoilt[4], spoilt[15] = "x1", "x2"
    docs = llm_data.docs(spark).unionByName(spark.createDataFrame([(900, f"Some words. {' '.join(spoilt)} more words"), (901, item[:30])], "doc_id long, text string"), allowMissingColumns=True)
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (None, item, "x"), (4, item + " z", "x")], "item_id long, text string, size string")
    for block in (D.BLOCK_BYTES, 64):
        got = D.benchmark_overlaps(docs, bench, block_bytes=block).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(900, 1), (900, 4)]
    clean = D.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 1
    assert D.benchmark_overlaps(docs, bench.limit(0)).count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert D.benchmark_overlaps(llm_data.empty(spark), bench).count() == 0


def test_a_short_item_is_not_looked_for_inside_documents(spark):
    docs = spark.createDataFrame([(1, "the words of the people"), (2, "The."), (3, "it is so"), (4, "of the people by the people")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the"), (2, "is so"), (3, "of the people by the"), (4, None), (5, "")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in D.benchmark_overlaps(docs, bench).collect()) == [(2, 1), (4, 3)]
    assert sorted(r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()) == [1, 3]
    assert {r["item_id"]: r["words"] for r in D.short_items(bench).collect()} == {1: 1, 2: 2}
