import hashlib
import random

import numpy as np
import pytest

import llm_data
from rareclass.llm import repeats as R


def brute(rows):
    """doc order by id (null last); a 50-byte string goes where a smaller id has it."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    first, out = {}, []
    for doc, text, *_ in order:
        b = (text or "").encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k:k + 50], (doc is None, doc))
    for doc, text, *_ in order:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] != (doc is None, doc):
                gone[k:k + 50] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_maximal_repeats_against_all_pairs():
    rng = random.Random(3)
    for _ in range(30):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 14))) for _ in range(4)]
        if rng.random() < 0.3:
            strings.append(strings[0])
        at = [(s, o) for s, x in enumerate(strings) for o in range(len(x))]
        want = {}
        for size in range(3, 15):
            by = {}
            for s, o in at:
                if o + size <= len(strings[s]):
                    by.setdefault(strings[s][o:o + size], []).append((s, o))
            for w, occ in by.items():
                left = {strings[s][o - 1] if o else (s, o) for s, o in occ}
                right = {strings[s][o + size] if o + size < len(strings[s]) else (s, o) for s, o in occ}
                if len(occ) > 1 and len(left) > 1 and len(right) > 1:
                    want[w] = sorted(occ)
        got = {strings[occ[0][0]][occ[0][1]:occ[0][1] + size]: sorted(occ) for size, occ in R.maximal_repeats(strings, 3)}
        assert got == want


@pytest.mark.parametrize("pack_bytes,hot", [(R.PACK_BYTES, R.HOT_PIECES), (2_000, R.HOT_PIECES), (2_000, 2), (1, 1)])
def test_remove_repeats_against_brute_force(spark, pack_bytes, hot):
    rows = llm_data.rows(5)
    shared = llm_data.words(random.Random(9), 14)
    rng = random.Random(11)
    rows += [(200 + i, f"{llm_data.words(rng, 9)} {shared} {llm_data.words(rng, 9)}", "en", "s", 0) for i in range(30)]
    df = spark.createDataFrame(rows, llm_data.SCHEMA).repartition(3)
    got = R.remove_repeats(df, pack_bytes=pack_bytes, hot_pieces=hot).collect()
    assert sorted([tuple(r[:5]) for r in got], key=str) == brute(rows)
    for r in got:  # the operator's own outputs agree with the digest
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]


def test_zero_bytes_and_runs_of_one_byte(spark):
    rows = [(1, "\0" * 120, "", "", 0), (2, "\0" * 70 + "a" * 60, "", "", 0), (3, "a" * 300, "", "", 0), (4, "a" * 49, "", "", 0), (5, "\0" * 50, "", "", 0)]
    got = R.repeats_digest(spark.createDataFrame(rows, llm_data.SCHEMA)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert R.repeats_digest(llm_data.empty(spark)).count() == 0
    got = R.repeats_digest(llm_data.docs(spark)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(llm_data.rows())
