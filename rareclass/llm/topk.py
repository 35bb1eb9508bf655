"""Exact top-k inner products by pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, rename_clashes, shuffle_partitions

# Pivots, and the sample (rows with the smallest hash of their id) from which they are taken, each far from the others.
PIVOTS = 32
PIVOT_SAMPLE = 1024
# Queries that one pass over the table carries; more queries take more passes.
QUERY_BYTES = 8 << 20
# Rows that a task compares at a time.
BLOCK_ROWS = 8192


def integer_vectors(table: DataFrame, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v, row``: components floor(scale * x) and a number of each row's own, written once.  Rows without an id,
    and vectors that are null, empty or hold null or non-finite components, take no part."""
    base = rename_clashes(table, [key, vector]).toDF("vec_id", "x").withColumn("x", F.col("x").cast("array<double>"))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    ints = F.transform("x", lambda e: F.floor(F.lit(float(scale)) * e).cast("long"))
    kept = base.where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & fine)
    return cut_lineage(kept.select("vec_id", ints.alias("v"), F.monotonically_increasing_id().alias("row")))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample that lie far apart: each next one is the farthest from all before."""
    if not len(sample):
        return sample
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


class Lifted:
    """Vectors on a sphere of radius R around 0, by one more component; queries have 0 there.  Then
    ``distance(q, v)^2 = |q|^2 + R^2 - 2 <q, v>``: the nearest have the largest inner product."""

    def __init__(self, radius2: float, pivots: np.ndarray):
        self.radius2 = radius2
        self.pivots = self.lift(pivots.astype(np.float64))

    def lift(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.radius2 - (rows * rows).sum(axis=1)))
        return np.hstack([rows, rest[:, None]])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        """Rows x pivots."""
        square = (lifted * lifted).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1)[None] - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(0.0, square))


class Best:
    """The k best ``(score, id)`` of a query so far, ties to the smaller id; an id may stand for several rows."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(self.scores) == self.k:
            keep = scores >= self.scores[-1]
            scores, ids = scores[keep], ids[keep]
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            by = np.lexsort((ids, -scores))[:self.k]
            self.scores, self.ids = scores[by], ids[by]


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every sum stays below 2^53, else in longs."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(query).sum())
    if most < 2.0 ** 53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if most >= 2.0 ** 63:
        raise OverflowError("a score does not fit a long")
    return rows @ query


def search_block(best: Best, query_row: int, query: np.ndarray, to_pivots: np.ndarray, rows: np.ndarray, ids: np.ndarray,
                 numbers: np.ndarray, table: np.ndarray, radius2: float) -> int:
    """Adds a block to a query's best, but for the query's own row; returns how many candidates were evaluated.

    The largest difference of the distances to a pivot bounds the distance from below, and with it the inner product
    from above.  Candidates are evaluated in order of that bound, a growing number at a time; once the bound falls
    below the k-th score found, no further candidate can enter (equal bounds are still evaluated).
    """
    q2 = float((query.astype(np.float64) ** 2).sum())
    low = np.abs(table - to_pivots).max(axis=1)
    slack = 1e-3 + 1e-9 * (q2 + radius2)  # rounding of the distances; scores are whole numbers
    bound = (q2 + radius2 - low * low) / 2 + slack
    left = np.flatnonzero((bound >= best.floor()) & (numbers != query_row))
    step, done = 256, 0
    while len(left):
        if len(left) > 2 * step:
            part = np.argpartition(-bound[left], step)
            now, rest = left[part[:step]], left[part[step:]]
        else:
            now, rest = left, left[:0]
        best.add(_products(rows[now], query), ids[now])
        done += len(now)
        left = rest[bound[rest] >= best.floor()]
        step *= 4
    return done


def _searcher(query_rows: np.ndarray, queries: np.ndarray, space: Lifted, dim: int, k: int):
    q = queries.astype(np.float64)
    q_dist = space.distances(np.hstack([q, np.zeros((len(q), 1))]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [Best(k) for _ in query_rows]
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[at:at + BLOCK_ROWS]
                rows = _matrix(part["v"].tolist(), dim)
                table = np.array(part["d"].tolist(), np.float64).reshape(len(rows), -1)
                ids, numbers = part["vec_id"].to_numpy(np.int64), part["row"].to_numpy(np.int64)
                for b, i, vector, dist in zip(best, query_rows.tolist(), queries, q_dist):
                    search_block(b, i, vector, dist, rows, ids, numbers, table, space.radius2)
        found = [(i, v, s) for b, i in zip(best, query_rows.tolist()) for v, s in zip(b.ids.tolist(), b.scores.tolist())]
        yield pd.DataFrame(found, columns=["query_row", "vec_id", "score"], dtype="int64")

    return run


def top_products(table: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding",
                 pivots: int = PIVOTS, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k largest integer inner products over all other rows, exact.

    ``is_query`` is a condition on ``vec_id``.  A pivot table - each row's distances to the pivots, in the space where
    the nearest neighbour is the largest product - is written once.  Queries go out in chunks of at most ``query_bytes``;
    in each pass every task scans its share of the table for all queries of the chunk and returns k rows a query, which
    one grouped ranking merges into a checkpoint, so the driver and the plan hold one chunk at a time.  Vectors that null,
    NaN or infinite components spoil take no part; shorter vectors count as filled up with zeros.  Rows that share an id
    are queries and candidates of their own: each has its k rows under that ``query_id``, and only the very row that asks
    is left out.  Ties go to the smaller id; with fewer than k other rows all are returned; an empty table or no query
    gives no row; other columns are not read.
    """
    spark = table.sparkSession
    vectors = integer_vectors(table, scale, key, vector)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = vectors.agg(F.max(F.size("v")).alias("dim"), F.max(norm).alias("r2")).first()
    result = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not facts["dim"]:
        return result
    dim = int(facts["dim"])
    picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(PIVOT_SAMPLE).collect()
    space = Lifted(float(facts["r2"]), choose_pivots(_matrix([r["v"] for r in picked], dim), pivots))

    @F.pandas_udf("array<double>")
    def to_pivots(v: pd.Series) -> pd.Series:
        return pd.Series(list(space.distances(space.lift(_matrix(v.tolist(), dim).astype(np.float64)))))

    pivot_table = cut_lineage(vectors.select("vec_id", "v", "row", to_pivots("v").alias("d")).repartition(shuffle_partitions(spark), "row"))
    asking = vectors.where(is_query)
    n = asking.count()
    passes = -(-n * (dim + pivots) * 8 // query_bytes)
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id"))
    for p in range(passes):
        chunk = asking.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == p).collect()
        if not chunk:
            continue
        rows = np.array([r["row"] for r in chunk], np.int64)
        search = _searcher(rows, _matrix([r["v"] for r in chunk], dim), space, dim, k)
        ranked = pivot_table.mapInPandas(search, "query_row long, vec_id long, score long").withColumn("rank", place).where(F.col("rank") <= k)
        named = spark.createDataFrame([(r["row"], r["vec_id"]) for r in chunk], "query_row long, query_id long")
        result = result.unionByName(cut_lineage(ranked.join(F.broadcast(named), "query_row").select("query_id", "rank", "vec_id", "score")))
    return result
