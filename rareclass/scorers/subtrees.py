"""Isolation forest: the random draws of a node, and whole subtrees grown in one task for a group of small nodes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Bytes of rows that one node grown in a task may have, and that a task takes for all its nodes.
NODE_BYTES = 16 << 20
TASK_BYTES = 32 << 20
# Candidate features of a large node's first try; later tries, for nodes where all were constant, take more.
FIRST_TRY = 4
MOST_TRIED = 32
# Nodes (a record has one in every tree) that a task looks at together.
TOP_CELLS = 1 << 19

# The primes of the 64-bit xxHash.
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (P1, P2, P3, P4, P5))


def _left(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _hash_int(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    h = seed + _P5 + np.uint64(4)
    return _mixed(_left(h ^ (x.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3)


def _hash_long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    h = seed + _P5 + np.uint64(8)
    return _mixed(_left(h ^ _left(x.astype(np.int64).astype(np.uint64) * _P2, 31) * _P1, 27) * _P1 + _P4)


def node_hash(seed: int, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
    """``xxhash64(lit(seed), t, node)`` of an int tree and a long node, as int64: both sides draw alike."""
    start = _hash_int(np.array([seed]), np.array([42], np.uint64))
    return _hash_long(node, _hash_int(tree, np.broadcast_to(start, tree.shape))).view(np.int64)


class Draws:
    """The seeded draws of a forest over ``d`` features, as columns and as arrays.

    A tree's features are ``(a * i + b) mod d`` for i below ``m``, a coprime to d: a pseudo-random subset.  A node runs
    through them from a random start by a random step coprime to m, so all come up once; it cuts at a uniform point.
    """

    def __init__(self, trees: int, d: int, m: int, seed: int):
        rng = np.random.default_rng(seed)
        self.d, self.m, self.seed = d, m, seed
        coprime = [a for a in range(1, d + 1) if math.gcd(a, d) == 1] or [1]
        steps = [a for a in range(1, m + 1) if math.gcd(a, m) == 1] or [1]
        self.steps = [steps[i] for i in sorted(rng.choice(len(steps), min(64, len(steps)), replace=False))]
        self.a = [int(rng.choice(coprime)) for _ in range(trees)]
        self.b = [int(rng.integers(0, d)) for _ in range(trees)]

    def candidate(self, k: int) -> Column:
        """The node's k-th feature, from the columns ``t`` and ``node``."""
        t, node = F.col("t"), F.col("node")
        start = F.pmod(F.xxhash64(F.lit(self.seed), t, node), F.lit(self.m))
        which = F.pmod(F.xxhash64(F.lit(self.seed + 3), t, node), F.lit(len(self.steps)))
        i = F.pmod(start + F.lit(k) * F.element_at(F.array(*map(F.lit, self.steps)), (which + 1).cast("int")), F.lit(self.m))
        a, b = (F.element_at(F.array(*map(F.lit, x)), t + 1) for x in (self.a, self.b))
        return F.pmod(a * i + b, F.lit(self.d)).cast("int")

    def candidates(self, k: int, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
        start = node_hash(self.seed, tree, node) % self.m
        step = np.array(self.steps)[node_hash(self.seed + 3, tree, node) % len(self.steps)]
        return (np.array(self.a)[tree] * ((start + k * step) % self.m) + np.array(self.b)[tree]) % self.d

    def point(self) -> Column:
        """Where in its range a node cuts, from 0 to 1."""
        return F.pmod(F.xxhash64(F.lit(self.seed + 2), F.col("t"), F.col("node")), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))

    def points(self, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
        return (node_hash(self.seed + 2, tree, node) % (1 << 53)) / float(1 << 53)


def grow(X: np.ndarray, at: np.ndarray, tree: np.ndarray, node: np.ndarray, draws: Draws, depth: int) -> list[tuple]:
    """The subtrees below the nodes (``tree, node``) that the rows ``X[at]`` stand in, all nodes of a level at once:
    ``(t, node, n, f, v)`` arrays for each level, f = -1 in a leaf."""
    out = []
    while len(node):
        by = np.lexsort((node, tree))
        at, tree, node = at[by], tree[by], node[by]
        first = np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])]
        start, group = np.flatnonzero(first), np.cumsum(first) - 1
        t, k, n = tree[start], node[start], np.diff(np.r_[start, len(node)])
        f, v = np.full(len(k), -1), np.zeros(len(k))
        left = np.flatnonzero((n > 1) & (np.frexp(k.astype(np.float64))[1] - 1 < depth))
        for tried in range(draws.m):
            if not len(left):
                break
            feature = draws.candidates(tried, t[left], k[left])
            own = np.full(len(k), -1)
            own[left] = feature
            rows = np.flatnonzero(own[group] >= 0)
            values = X[at[rows], own[group[rows]]]
            begin = np.cumsum(n[left]) - n[left]
            low, high = np.minimum.reduceat(values, begin), np.maximum.reduceat(values, begin)
            found = high > low
            hit = left[found]
            f[hit] = feature[found]
            v[hit] = low[found] + draws.points(t[hit], k[hit]) * (high[found] - low[found])
            left = left[~found]
        out.append((t, k, n, f, v))
        rows = np.flatnonzero(f[group] >= 0)
        right = X[at[rows], f[group[rows]]] >= v[group[rows]]
        at, tree, node = at[rows], tree[rows], node[rows] * 2 + right
    return out


NODES = "t int, node long, n long, f int, v double, level int"


def _node_rows(X: np.ndarray, at: np.ndarray, tree: np.ndarray, node: np.ndarray, draws: Draws, depth: int) -> pa.Table:
    levels = grow(X, at, tree, node, draws, depth)
    t, k, n, f, v = (np.concatenate(c) for c in zip(*levels)) if levels else (np.zeros(0, np.int64),) * 5
    level, leaf = np.frexp(k.astype(np.float64))[1] - 1, f < 0
    return pa.table({"t": pa.array(t, pa.int32()), "node": pa.array(k, pa.int64()), "n": pa.array(n, pa.int64()), "f": pa.array(f, pa.int32(), mask=leaf),
                     "v": pa.array(v, pa.float64(), mask=leaf), "level": pa.array(level, pa.int32())})


class Tops:
    """The upper parts of all trees: the nodes that are split by jobs.  Children of node ``i`` are ``left[i]`` and the one
    after it; ``f`` is the feature, or one of the three marks."""

    LEAF, PARKED, OPEN = -1, -2, -3

    def __init__(self, trees: int):
        self.t, self.node = np.arange(trees), np.ones(trees, np.int64)
        self.n, self.f, self.v, self.left = np.zeros(trees, np.int64), np.full(trees, self.OPEN), np.zeros(trees), np.zeros(trees, np.int64)

    def open(self) -> np.ndarray:
        return np.flatnonzero(self.f == self.OPEN)

    @property
    def pending(self) -> int:
        return int(self.n[self.f == self.PARKED].sum())

    def split(self, at: np.ndarray, feature: np.ndarray, value: np.ndarray) -> None:
        self.f[at], self.v[at], self.left[at] = feature, value, len(self.f) + 2 * np.arange(len(at))
        children = np.repeat(self.node[at] * 2, 2)
        children[1::2] += 1
        more = len(children)
        self.t, self.node = np.r_[self.t, np.repeat(self.t[at], 2)], np.r_[self.node, children]
        self.n, self.f = np.r_[self.n, np.zeros(more, np.int64)], np.r_[self.f, np.full(more, self.OPEN)]
        self.v, self.left = np.r_[self.v, np.zeros(more)], np.r_[self.left, np.zeros(more, np.int64)]

    def walk(self, X: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Where each record stands in each tree (``records x trees``, flat); -1: not in the tree's sample."""
        at = np.where(nodes != 0, np.arange(nodes.shape[1])[None], -1).ravel()
        go = np.flatnonzero(at >= 0)
        go = go[self.f[at[go]] >= 0]
        while len(go):
            here = at[go]
            here = self.left[here] + (X[go // nodes.shape[1], self.f[here]] >= self.v[here])
            at[go] = here
            go = go[self.f[here] >= 0]
        return at

    def parts(self, x: pa.Array, nodes: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """A batch as matrices of vectors and of places, some records at a time."""
        if len(x):
            trees = len(nodes[0])
            X, own = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), nodes.flatten().to_numpy(zero_copy_only=False).reshape(-1, trees)
            step = max(1, TOP_CELLS // trees)
            for i in range(0, len(X), step):
                yield X[i:i + step], self.walk(X[i:i + step], own[i:i + step]).reshape(-1, trees)

    def parked(self):
        """Per record its parked node in every tree, 0 where it stands in none."""
        node = np.where(self.f == self.PARKED, self.node, 0)

        @F.arrow_udf("array<long>")
        def waiting(x: pa.Array, nodes: pa.Array) -> pa.Array:
            found = [np.where(at >= 0, node[at], 0) for _, at in self.parts(x, nodes)]
            flat = np.concatenate([f.ravel() for f in found]) if found else np.zeros(0, np.int64)
            trees = len(flat) // max(1, len(x))
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * trees, pa.int32()), pa.array(flat))

        return waiting

    def frame(self, spark) -> DataFrame:
        """Node rows of the split nodes and the leaves."""
        kept = np.flatnonzero((self.f >= self.LEAF) & (self.n > 0))
        f = self.f[kept]
        level = np.frexp(self.node[kept].astype(np.float64))[1] - 1
        table = pa.table({"t": pa.array(self.t[kept], pa.int32()), "node": pa.array(self.node[kept], pa.int64()), "n": pa.array(self.n[kept], pa.int64()),
                          "f": pa.array(f, pa.int32(), mask=f < 0), "v": pa.array(self.v[kept], pa.float64(), mask=f < 0), "level": pa.array(level, pa.int32())})
        return spark.createDataFrame(table, NODES)


def _ranges(records: DataFrame, tops: Tops, asked: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the nodes ``asked``, and the smallest and largest value of their candidates (``features``: nodes x candidates): one job."""
    m, count = features.shape
    place = np.full(len(tops.f) + 1, -1)  # the last one: not in the sample
    place[asked] = np.arange(m)

    def partial(arrow):
        n, low, high = np.zeros(m, np.int64), np.full((m, count), np.inf), np.full((m, count), -np.inf)
        for b in arrow:
            for X, at in tops.parts(b.column(0), b.column(1)):
                g = place[at.ravel()]
                hit = np.flatnonzero(g >= 0)
                if not len(hit):
                    continue
                hit = hit[np.argsort(g[hit], kind="stable")]
                g, row = g[hit], hit // at.shape[1]
                start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
                which = g[start]
                n[which] += np.diff(np.r_[start, len(g)])
                for k in range(count):
                    values = X[row, features[g, k]]
                    low[which, k] = np.minimum(low[which, k], np.minimum.reduceat(values, start))
                    high[which, k] = np.maximum(high[which, k], np.maximum.reduceat(values, start))
        seen = np.flatnonzero(n)
        columns = [pa.array(seen, pa.int32()), pa.array(n[seen]), *[pa.array(low[seen, k]) for k in range(count)], *[pa.array(high[seen, k]) for k in range(count)]]
        yield pa.RecordBatch.from_arrays(columns, ["g", "n", *[f"lo{k}" for k in range(count)], *[f"hi{k}" for k in range(count)]])

    schema = "g int, n long" + "".join(f", {c}{k} double" for c in ("lo", "hi") for k in range(count))
    found = records.mapInArrow(partial, schema).groupBy("g").agg(
        F.sum("n").alias("n"), *[F.min(f"lo{k}").alias(f"lo{k}") for k in range(count)], *[F.max(f"hi{k}").alias(f"hi{k}") for k in range(count)]).toArrow()
    n, low, high = np.zeros(m, np.int64), np.zeros((m, count)), np.zeros((m, count))
    g = found.column("g").to_numpy()
    n[g] = found.column("n").to_numpy()
    for k in range(count):
        low[g, k], high[g, k] = found.column(f"lo{k}").to_numpy(), found.column(f"hi{k}").to_numpy()
    return n, low, high


def grow_tops(records: DataFrame, trees: int, draws: Draws, depth: int, local: int) -> Tops:
    """Splits the nodes of more than ``local`` rows of ``records(x, nodes)``, a level a job; smaller ones are parked."""
    tops = Tops(trees)
    for level in range(depth + 1):
        nodes = tops.open()
        if not len(nodes):
            break
        left, tried, count = nodes, 0, min(FIRST_TRY, draws.m)
        while len(left):
            features = np.stack([draws.candidates(tried + k, tops.t[left], tops.node[left]) for k in range(count)], axis=1)
            n, low, high = _ranges(records, tops, left, features)
            if not tried:
                tops.n[left] = n
                tops.f[left] = np.where((n > 0) & (n <= local), tops.PARKED, tops.LEAF)
            varies = high > low
            hit = np.flatnonzero((tops.n[left] > local) & (level < depth) & varies.any(axis=1))
            at, k = left[hit], np.argmax(varies[hit], axis=1)
            lo, hi = low[hit, k], high[hit, k]
            chosen = (at, features[hit, k], lo + draws.points(tops.t[at], tops.node[at]) * (hi - lo))
            again = (tops.n[left] > local) & (level < depth) & ~varies.any(axis=1)
            left = left[again]
            tried += count
            count = min(count * 2, MOST_TRIED, draws.m - tried)
            tops.split(*chosen)
            if count <= 0:
                break
    return tops


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def grow_trees(records: DataFrame, trees: int, d: int, draws: Draws, depth: int) -> DataFrame:
    """Node rows of all trees of ``records(x, nodes)``, which fit a task: tasks take a share of the trees each, and a record
    goes to a task once for all of its trees."""
    share = -(-trees // min(trees, max(1, records.sparkSession.sparkContext.defaultParallelism)))
    starts = list(range(0, trees, share))

    def run(table: pa.Table) -> pa.Table:
        X = _matrix(table.column("x"), d)
        nodes = _matrix(table.column("own"), len(table.column("own")[0]))
        at, tree = np.nonzero(nodes)  # 0: not in the tree's sample
        return _node_rows(X, at, tree + starts[table.column("g")[0].as_py()], np.ones(len(at), np.int64), draws, depth)

    dealt = records.select("x", F.posexplode(F.array(*[F.slice("nodes", s + 1, share) for s in starts])).alias("g", "own"))
    return cut_lineage(dealt.groupBy("g").applyInArrow(run, NODES))


def finish_subtrees(parked: DataFrame, rows: int, d: int, draws: Draws, depth: int, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Node rows of all subtrees below the nodes of ``parked(t, node, x)``: one shuffle brings the rows of a group of
    nodes into a task, which grows them to the end.  Groups hold ``task_bytes`` on average, by a hash of the node."""
    groups = max(1, -(-rows * d * 8 // task_bytes), min(rows // 4096, int(parked.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def run(table: pa.Table) -> pa.Table:
        X = _matrix(table.column("x"), d)
        tree, node = (table.column(c).to_numpy().astype(np.int64) for c in ("t", "node"))
        return _node_rows(X, np.arange(len(X)), tree, node, draws, depth)

    grouped = parked.withColumn("g", F.pmod(F.xxhash64("t", "node"), F.lit(groups))).groupBy("g")
    return cut_lineage(grouped.applyInArrow(run, NODES))
