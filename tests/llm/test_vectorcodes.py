import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rareclass.llm import vectorcodes as V

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max([1, *(len(v) for _, v, _ in kept)]) // parts) * parts
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    d = width // parts
    cut = lambda v, p: v[p * d:(p + 1) * d]
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in seeds] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if members[e] else book for e, book in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [(i, lab, [nearest(cut(v, p), books[p]) for p in range(parts)]) for i, v, lab in kept]
    by_label = defaultdict(int)
    for _, lab, near in coded:
        by_label[lab] += sum(x for x, _ in near)
    return sorted(((i, "".join("%02x" % e for _, e in near), sum(x for x, _ in near), by_label[lab], digest) for i, lab, near in coded), key=str)


def vectors(n, dim, seed=1):
    rng = random.Random(seed)
    rows = [(i * 3, [rng.gauss(0, 0.3) for _ in range(dim)], rng.choice([1, 2, None]), "x", 0) for i in range(n)]
    rows += [(n * 3 + i, rows[1][1], 9, "x", 0) for i in range(n // 3)] + [rows[2], rows[2], (6, [-1.0] * dim, 1, "x", 0)]
    rows += [(5000, None, 1, "x", 0), (5001, [], None, "x", 0), (5002, [None] * dim, 1, "x", 0), (5003, [float("nan")] * dim, 1, "x", 0),
             (5004, [float("inf")] * dim, 1, "x", 0), (None, [0.25] * dim, 2, "x", 0), (5005, [0.5] * (dim // 2), 2, "x", 0)]
    return rows


@pytest.mark.parametrize("n,dim", [(120, 16), (40, 13), (5, 8)])
def test_codes_against_brute_force(spark, n, dim):
    rows = vectors(n, dim)
    got = V.codes_digest(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_few_rows_and_empty(spark):
    rows = [(4, [1.0, -2.0], 1, "", 0), (2, [0.5, 0.0], None, "", 0)]
    assert sorted((tuple(r) for r in V.codes_digest(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == brute(rows)
    for none in ([], [(1, None, 1, "", 0)]):
        assert V.codes_digest(spark.createDataFrame(none, SCHEMA)).count() == 0
    with pytest.raises(OverflowError):
        V.codes_digest(spark.createDataFrame([(1, [1e200], 1, "", 0)], SCHEMA))


@pytest.mark.parametrize("spread", [3, 500])
def test_equal_average_search_is_exact_and_spares_distances(spread):
    rng = np.random.default_rng(spread)
    entries = rng.integers(-spread, spread, (40, 4))
    entries[7] = entries[30]  # equal entries: the lower index wins
    x = rng.integers(-spread, spread, (3000, 4))
    index, distance, computed = V.EqualAverage(entries).nearest(x)
    square = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (index == square.argmin(axis=1)).all() and (distance == square.min(axis=1)).all()
    assert computed < 0.8 * square.size


def test_decode(spark):
    rows = [(i, [i / 10, -i / 10, 0.0, 1.0], 1, "", 0) for i in range(6)]
    codes, books = V.compress_vectors(spark.createDataFrame(rows, SCHEMA), parts=2, entries=6, rounds=2)
    got = {r["vec_id"]: r for r in V.decode(codes, books).collect()}
    for i, v, *_ in rows:
        ints = [math.floor(4096 * x) for x in v]
        assert sum((a - b) ** 2 for a, b in zip(got[i]["v"], ints)) == got[i]["error"]
    assert V.decode(codes.withColumn("code", F.lit(None).cast("binary")), books).where("v is null").count() == 6
