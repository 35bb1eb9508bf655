"""Exact k-nearest-neighbour vote (M5, J3, O6) by blocked matrix distances.

Plan:

1. The training rows (``id, vector, label``) are written once.
2. Queries go out in chunks of a bounded size; a larger query set takes more
   passes over the training rows.
3. In a pass, each task reads its share of the training rows block by block,
   computes one ``queries x rows`` distance matrix at a time (a matrix product
   for L2, one term per dimension otherwise) and keeps, per query, its local
   top ``k``.  No row per pair is ever made: a task returns at most ``k`` rows
   per query.
4. ``row_number() over (partition by query order by distance, id) <= k`` merges
   the tasks' rows.

The result is exact.  The matrix only preselects; the distances that decide are
summed term by term in dimension order.  Distances: Minkowski ``p`` (1 or 2
shown in the reference); ties broken by training id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# Queries (their vectors' bytes) that one pass carries, the cells of one distance matrix, and the training rows' bytes of a task.
QUERY_BYTES = 8 << 20
MATRIX_CELLS = 1 << 20
TRAIN_BYTES = 32 << 20
# Rows of one distance matrix, and its cells in single precision: two such matrices stay in a core's cache.
ROW_TILE = 4096
SINGLE_CELLS = 1 << 16
# A sum of d absolute differences in single precision is off by (d + 8) of these at most, times the two vectors' sums of
# absolute components; vectors whose sum is larger than the limit are compared in double precision.
SINGLE_ERROR = 2.0 ** -23
SINGLE_LIMIT = 1e30


def _as_double_array(col: str):
    return F.transform(F.col(col), lambda x: x.cast("double"))


def _stack(rows, dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for i, v in enumerate(rows):
        out[i] = v
    return out


def pair_terms(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, p: float) -> np.ndarray:
    """sum |a_i - b_j|^p of paired rows, summed in dimension order (no root: same order, cheaper)."""
    total = np.zeros(len(i))
    for f in range(a.shape[1]):
        d = a[i, f] - b[j, f]
        total = total + (d * d if p == 2 else np.abs(d) if p == 1 else np.abs(d) ** p)
    return total


def distance_matrix(queries: np.ndarray, rows: np.ndarray, p: float) -> np.ndarray:
    """``queries x rows`` Minkowski sums, up to rounding; memory is one or two matrices of that shape."""
    if p == 2:
        near = queries @ rows.T
        near *= -2
        near += (queries * queries).sum(axis=1)[:, None]
        near += (rows * rows).sum(axis=1)[None]
        return near
    total = np.zeros((len(queries), len(rows)))
    for i in range(queries.shape[1]):
        d = np.abs(queries[:, i][:, None] - rows[:, i][None])
        total += d if p == 1 else d ** p
    return total


def single_distances(queries: np.ndarray, rows: np.ndarray, near: np.ndarray, term: np.ndarray) -> np.ndarray:
    """``queries x rows`` sums of absolute differences in single precision, into ``near``; both sides are given by component."""
    near[:] = 0
    for q, r in zip(queries, rows):
        np.subtract(q[:, None], r[None], out=term)
        np.abs(term, out=term)
        np.add(near, term, out=near)
    return near


class NearestRows:
    """Per query, the ``k`` nearest rows seen so far: ``query, dp, id, label`` sorted by query, distance and id."""

    def __init__(self, queries: np.ndarray, k: int, p: float):
        self.queries, self.k, self.p = queries, k, p
        n = len(queries)
        self.count, self.reach = np.zeros(n, np.int64), np.full(n, np.inf)
        self._dp, self._label, self._id = np.zeros((n, k)), np.zeros((n, k)), None
        self.size = (queries * queries if p == 2 else np.abs(queries)).sum(axis=1)
        self.single = None  # the queries' components one after another, in single precision
        if p == 1 and np.fmax.reduce(self.size, initial=0.0) < SINGLE_LIMIT:
            self.single = np.ascontiguousarray(queries.T, np.float32)

    def _flat(self, of: np.ndarray) -> np.ndarray:
        return of[np.arange(self.k)[None] < self.count[:, None]]

    query = property(lambda self: np.repeat(np.arange(len(self.queries)), self.count))
    dp = property(lambda self: self._flat(self._dp))
    label = property(lambda self: self._flat(self._label))
    id = property(lambda self: np.zeros(0, object) if self._id is None else self._flat(self._id))

    def add(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        for at in range(0, len(rows), ROW_TILE):
            self._add_tile(rows[at:at + ROW_TILE], ids[at:at + ROW_TILE], labels[at:at + ROW_TILE])

    def _add_tile(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        d = rows.shape[1]
        size = np.fmax.reduce((rows * rows if self.p == 2 else np.abs(rows)).sum(axis=1), initial=0.0)  # without vectors that hold NaN
        single = self.single is not None and size < SINGLE_LIMIT
        cells = SINGLE_CELLS if single else MATRIX_CELLS // 4
        step = max(1, cells // max(1, len(rows)))
        if single:
            columns = np.ascontiguousarray(rows.T, np.float32)
            near, term = np.empty((2, min(step, len(self.queries)), len(rows)), np.float32)
        hits = []
        for at in range(0, len(self.queries), step):
            part = self.queries[at:at + step]
            if single:
                found = single_distances(self.single[:, at:at + step], columns, near[:len(part)], term[:len(part)])
                error = (d + 8) * SINGLE_ERROR * (self.size[at:at + step] + size)
            else:
                found, error = distance_matrix(part, rows, self.p), 0.0
            reach = self.reach[at:at + step]
            if len(rows) >= self.k and not np.isfinite(reach).all():
                reach = np.minimum(reach, np.partition(found, self.k - 1, axis=1)[:, self.k - 1])
            # the slack covers the rounding of the matrix form, of the distance and of the reach
            slack = 1e-9 * (np.abs(reach, where=np.isfinite(reach), out=np.zeros_like(reach)) + self.size[at:at + step] + size) + 1e-12 + 2 * error
            limit = reach + slack
            if single:
                limit = np.nextafter(limit.astype(np.float32), np.float32(np.inf))
            flat = np.flatnonzero(found <= limit[:, None])
            if len(flat):
                q, r = np.divmod(flat, len(rows))
                hits.append((q + at, r))
        if hits:
            q, r = (np.concatenate(c) for c in zip(*hits))
            for at in range(0, len(q), MATRIX_CELLS):
                here = slice(at, at + MATRIX_CELLS)
                self._merge(q[here], pair_terms(self.queries, q[here], rows, r[here], self.p), ids[r[here]], labels[r[here]])

    def _merge(self, query, dp, ids, labels) -> None:
        """Puts new rows between those that their queries have."""
        if self._id is None:
            self._id = np.zeros(self._dp.shape, ids.dtype)
        elif self._id.dtype != ids.dtype:
            self._id, ids = self._id.astype(object), ids.astype(object)
        held = np.unique(query)
        have = np.arange(self.k)[None] < self.count[held][:, None]
        query = np.concatenate([np.repeat(held, self.count[held]), query])
        dp, labels = np.concatenate([self._dp[held][have], dp]), np.concatenate([self._label[held][have], labels])
        ids = np.concatenate([self._id[held][have], ids])
        place = np.unique(ids, return_inverse=True)[1] if ids.dtype == object else ids  # ids of any kind, in order
        by = np.lexsort((place, dp, query))
        query, dp, ids, labels = query[by], dp[by], ids[by], labels[by]
        rank = np.arange(len(query)) - np.searchsorted(query, query, "left")
        keep = rank < self.k
        query, rank = query[keep], rank[keep]
        self._dp[query, rank], self._id[query, rank], self._label[query, rank] = dp[keep], ids[keep], labels[keep]
        self.count[held] = np.bincount(query, minlength=len(self.queries))[held]
        full = held[self.count[held] == self.k]
        self.reach[full] = self._dp[full, self.k - 1]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as a matrix; a null vector, and a null component, is NaN."""
    flat = column.flatten()
    if not column.null_count and not flat.null_count and (column.value_lengths().to_numpy() == dim).all():
        return flat.to_numpy().reshape(-1, dim)
    return _stack(column.to_pylist(), dim)


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers where they are, else as objects."""
    if pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy()
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def knn_vote(
    train: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "id",
    vec_col: str = "vec",
    label_col: str = "label",
    weights: str = "uniform",
    p: float = 2,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Score each query by its ``k`` nearest training rows: ``id, score``.

    ``score`` = share of positive (``label == 1``) neighbours, or the
    ``1/distance``-weighted share with ``weights='distance'`` (a zero distance
    wins outright, as in scikit-learn).
    """
    tr = cut_lineage(train.select(F.col(id_col).alias("tid"), _as_double_array(vec_col).alias("tv"), F.col(label_col).cast("double").alias("ty")))
    qs = cut_lineage(queries.select(F.col(id_col).alias("qid"), _as_double_array(vec_col).alias("qv")))
    facts = tr.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("tv")).alias("d")).first()
    n_train, dim = int(facts["n"]), int(facts["d"] or 1)
    n_queries = qs.count()
    if n_train == 0 or n_queries == 0:
        return qs.select(F.col("qid").alias(id_col), F.lit(None).cast("double").alias("score"))
    kk = min(k, n_train)
    kinds = dict(qs.dtypes)["qid"], dict(tr.dtypes)["tid"]
    schema = f"qid {kinds[0]}, tid {kinds[1]}, ty double, dp double"
    block = max(1, min(MATRIX_CELLS // 64, (8 << 20) // (dim * 8)))

    def searcher(ids: pa.Array, vectors: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, kind = NearestRows(vectors, kk, p), None
            for batch in batches:
                kind = batch.column("tid").type
                for at in range(0, len(batch), block):
                    part = batch.slice(at, block)
                    labels = part.column("ty").to_numpy(zero_copy_only=False).astype(float)
                    best.add(_matrix(part.column("tv"), dim), _ids(part.column("tid")), labels)
            if kind is not None:
                found = [ids.take(pa.array(best.query)), pa.array(best.id, kind, from_pandas=True), pa.array(best.label, from_pandas=True), pa.array(best.dp)]
                yield pa.RecordBatch.from_arrays(found, ["qid", "tid", "ty", "dp"])

        return run

    passes = max(1, -(-n_queries * dim * 8 // query_bytes))
    # a task returns k rows a query: no more tasks than the training rows' bytes, or the cores, ask for
    tasks = max(2, -(-n_train * dim * 8 // TRAIN_BYTES), min(-(-2 * tr.sparkSession.sparkContext.defaultParallelism // passes), -(-n_train // ROW_TILE)))
    rows = tr.coalesce(tasks) if tr.rdd.getNumPartitions() >= tasks else tr.repartition(tasks)
    found = None
    for i in range(passes):
        chunk = qs.where(F.pmod(F.xxhash64("qid"), F.lit(passes)) == i).toArrow().combine_chunks()  # about query_bytes
        if len(chunk):
            vectors = np.vstack([_matrix(c, dim) for c in chunk.column("qv").chunks])
            here = rows.mapInArrow(searcher(pa.concat_arrays(chunk.column("qid").chunks), vectors), schema)
            found = here if found is None else found.unionByName(here)
    w = Window.partitionBy("qid").orderBy("dp", "tid")
    top = found.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= kk)
    pos = (F.col("ty") == 1).cast("double")
    if weights == "distance":
        dist = F.pow(F.col("dp"), F.lit(1.0 / p))
        has_zero = F.max((F.col("dp") == 0).cast("int"))
        score = F.when(
            has_zero == 1,
            F.try_divide(F.sum(F.when(F.col("dp") == 0, pos).otherwise(0.0)), F.sum(F.when(F.col("dp") == 0, 1.0).otherwise(0.0))),
        ).otherwise(F.try_divide(F.sum(F.try_divide(pos, dist)), F.sum(F.try_divide(F.lit(1.0), dist))))
    else:
        score = F.avg(pos)
    res = top.groupBy("qid").agg(score.alias("score"))
    return res.select(F.col("qid").alias(id_col), "score")


class KNNModel:
    """Fitted M5: keeps the training rows; scoring is :func:`knn_vote`."""

    def __init__(self, train: DataFrame, k: int, weights: str, p: float, id_col: str):
        self.train, self.k, self.weights, self.p, self.id_col = train, k, weights, p, id_col

    def transform(self, df: DataFrame, id_col: str | None = None) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        idc = id_col or self.id_col
        qs = df.select(F.col(idc).alias("id"), vector_to_array("features").alias("vec"))
        s = knn_vote(self.train, qs, k=self.k, id_col="id", vec_col="vec", label_col="label",
                     weights=self.weights, p=self.p)
        return df.join(s.withColumnRenamed("id", idc), idc, "left")


class KNNScorer:
    """M5 in the common scorer contract: ``n_neighbors``, ``weights`` (uniform /
    distance), Minkowski ``p``; ``metric`` euclidean = p 2, manhattan = p 1."""

    def __init__(self, n_neighbors: int = 5, weights: str = "uniform", p: int = 2, metric: str = "minkowski"):
        self.k, self.weights = n_neighbors, weights
        self.p = {"euclidean": 2, "manhattan": 1}.get(metric, p)

    def fit(self, train: DataFrame, id_col: str = "id") -> KNNModel:
        from pyspark.ml.functions import vector_to_array

        tr = train.select(F.col(id_col).alias("id"), vector_to_array("features").alias("vec"), "label")
        return KNNModel(tr, self.k, self.weights, self.p, id_col)
