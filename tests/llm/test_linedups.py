import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import docs, empty, rows
from pyspark.sql import functions as F

from rareclass.llm import linedups as D

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(table, min_docs, min_chars, keep="none"):
    held, first = Counter(), {}
    for i, t in table:
        for k in {key_of(x) for x in (t or "").split("\n")}:
            held[k] += 1
            if i is not None:
                first[k] = min(i, first.get(k, i))
    out = []
    for i, t in table:
        lines, kept, shown = (t or "").split("\n"), [], set()
        for line in lines:
            k = key_of(line)
            repeated = len(k) >= min_chars and held[k] >= min_docs
            if not repeated or keep == "first" and first.get(k) == i and k not in shown:
                kept.append(line)
            shown.add(k)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def lined(n=120, seed=4):
    rng = random.Random(seed)
    pool = [f"line {i} ß" for i in range(40)] + ["", "  ", "\t", "Menu", " menu ", "MENU\r", "É", "é", "\x1fx", "中文"]
    table = [(i, "\n".join(["hot line"] * (i % 3 == 0) + rng.choices(pool, weights=range(50, 0, -1), k=rng.randint(0, 9)))) for i in range(n)]
    table += [(n, None), (n + 1, ""), (n + 2, "\n\n"), (None, "menu\nown"), (None, "hot line\nx"), (5, table[5][1]), (5, table[5][1]), (7, "another\nmenu")]
    table += [(n + 3, "\n".join(f"long {i}" for i in range(30_000)) + "\nmenu\nmenu")]
    return table


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("min_docs,min_chars,inline", [(10, 1, D.INLINE_BYTES), (10, 1, -1), (2, 0, D.INLINE_BYTES), (3, 5, -1), (1, 1, -1)])
def test_lines_against_brute_force(spark, keep, min_docs, min_chars, inline):
    table = lined()
    frame = spark.createDataFrame(table, "doc_id long, text string").repartition(5).withColumn("key", F.lit("x")).withColumn("h", F.lit(1))
    got = found(D.drop_repeated_lines(frame, min_docs, min_chars, keep, inline_bytes=inline, per_bucket=500))
    assert got == brute(table, min_docs, min_chars, keep)


def test_only_repeats_are_suspected(spark):
    table = lined()
    keys = D.document_keys(spark.createDataFrame(table, "doc_id long, text string").repartition(6), 1)
    suspects = {r["h"] for r in D.suspected_hashes(keys, 1000).collect()}
    seen = Counter(r["h"] for r in keys.collect())
    assert {h for h, n in seen.items() if n > 1} <= suspects
    assert len(suspects) < sum(n > 1 for n in seen.values()) + 0.05 * len(seen)


def test_chunks_and_filters(monkeypatch, spark):
    monkeypatch.setattr(D, "CHUNK", 50)
    test_only_repeats_are_suspected(spark)
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    f = D.BloomFilter(10_000)
    f.add(h[:10_000])
    assert f.holds(h[:10_000]).all() and f.holds(h[10_000:]).mean() < 0.05


def test_awkward_rows(spark):
    got = found(D.line_digest(docs(spark), min_docs=3))
    want = sorted(((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute([r[:2] for r in rows()], 3, 1)), key=str)
    assert got == want
    assert D.line_digest(empty(spark)).count() == 0


def test_first_line_survives_once(spark):
    table = [(i, "same\nsame\nown %d" % i) for i in range(12)]
    got = {r["doc_id"]: r["kept"] for r in D.drop_repeated_lines(spark.createDataFrame(table, "doc_id long, text string"), keep="first").collect()}
    assert got[0] == "same\nown 0" and all(got[i] == f"own {i}" for i in range(1, 12))
    with pytest.raises(ValueError):
        D.drop_repeated_lines(empty(spark), keep="last")
