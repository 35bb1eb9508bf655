import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rareclass.llm import topk as K

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, k=5, scale=256):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, u) in enumerate(ok):
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(u, w)), c) for j, (c, w) in enumerate(ok) if j != at)[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scores, 1)]
    return sorted(out)


def vectors(n, dim, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dim)], "x") for i in range(n)]
    rows += [(n + i, rows[0][1], "x") for i in range(40)]  # many ties
    rows += [(1000, None, "x"), (1001, [], "x"), (1050, [None] * dim, "x"), (1100, [float("nan")] * dim, "x"), (1150, [float("inf")] + [0.0] * (dim - 1), "x"),
             (None, [1.0] * dim, "x"), (1200, [0.5] * (dim // 2), "x"), (1250, [0.0] * dim, "x"), rows[50], rows[50], (100, [2.0] * dim, "x"), (7, [-9.0] * dim, "x")]
    return rows


@pytest.mark.parametrize("query_bytes", [K.QUERY_BYTES, 300])
def test_top_products_against_brute_force(spark, query_bytes):
    rows = vectors(260, 8)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = K.top_products(df, F.col("vec_id") % 50 == 0, query_bytes=query_bytes).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0, 2.0], ""), (1, [0.5, 0.5], ""), (50, [3.0, -1.0], "")]
    got = K.top_products(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows) and len(got) == 4
    assert K.top_products(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert K.top_products(spark.createDataFrame(rows, SCHEMA), F.lit(False)).count() == 0


def test_bounds_spare_candidates_and_lose_none():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 400, (20, 16))
    rows = (centres[rng.integers(0, 20, 4000)] + rng.normal(0, 10, (4000, 16))).astype(np.int64)
    radius2 = float((rows.astype(float) ** 2).sum(axis=1).max())
    space = K.Lifted(radius2, K.choose_pivots(rows[:500], 32))
    table = space.distances(space.lift(rows.astype(float)))
    for q in range(20):
        best = K.Best(5)
        own = np.hstack([rows[q].astype(float), [0.0]])[None]
        done = K.search_block(best, q, rows[q], space.distances(own)[0], rows, np.arange(4000), np.arange(4000), table, radius2)
        scores = rows @ rows[q]
        scores[q] = -10 ** 15
        want = np.lexsort((np.arange(4000), -scores))[:5]
        assert best.ids.tolist() == want.tolist()
        assert done < 4000
