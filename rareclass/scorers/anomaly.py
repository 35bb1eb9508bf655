"""Anomaly detectors fitted on the normal class.

* :class:`IsolationForestScorer` (Liu et al. 2008): large nodes are split level
  by level as Spark aggregates (a record keeps its vector and its node in every
  tree), small ones are finished as whole subtrees, a group of them in a task.
  Each tree sees its whole sample (``max_samples=1.0`` = every row, as in the
  reference) - no large node or tree is ever collected into one task.
* :class:`OneClassSVMScorer` (Schoelkopf et al. 2001): the linear nu-objective
  on the M4 feature map, minimised to a gradient tolerance by L-BFGS; every
  evaluation is one Spark job.
* :class:`ReconstructionScorer`: linear autoencoder = PCA (Baldi & Hornik
  1989), by randomised subspace iteration; score = row mean squared reconstruction error (A21).

Scores are "higher = more anomalous" (the reference negates
``decision_function``; the offset does not change any ranking metric).
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import exact_quantile_values
from ..session import cut_lineage
from .lbfgs import minimise
from .principal import principal_axes
from .rows import Rows, array_rows, fewer_tasks, stored, summed_arrays, vector_width
from .subtrees import NODE_BYTES, NODES, Draws, finish_subtrees, grow_tops, grow_trees
from .supervised import SCORE, kernel_map

EULER = 0.5772156649015329


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over ``n`` points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


# Most rows of node tables that the driver hands to one step over the records; a wider level is joined on the executors.
NODE_CHUNK = 500_000
# Nodes (a record has one in every tree) that a task moves at a time.
WALK_CELLS = 1 << 18

_NODE_BITS = 44  # key of a node: tree << 44 | node


def _node_steps(level_rows: list[int], most: int) -> list[list[int]]:
    """The levels of each step: small ones share a step of ``most`` node rows at most, a wider one stands alone."""
    steps: list[list[int]] = []
    size = most + 1
    for lvl, rows in enumerate(level_rows):
        if size + rows > most:
            steps.append([])
            size = 0
        steps[-1].append(lvl)
        size += rows
    return steps


def _key(t: F.Column, node: F.Column) -> F.Column:
    return F.shiftleft(t.cast("long"), _NODE_BITS).bitwiseOR(node.cast("long"))


_STATE = T.StructType([T.StructField("nodes", T.ArrayType(T.LongType())), T.StructField("path", T.DoubleType())])


def _advance(X: np.ndarray, at: np.ndarray, total: np.ndarray, level: int, known: np.ndarray, feature: np.ndarray, value: np.ndarray, size: np.ndarray):
    """One level of all trees at once for a batch of records: nodes (0 = ended) and summed path.

    A record in a leaf, or in a child that no training row reached, ends there.
    """
    here = (at >= 1 << level) & (at < 1 << level + 1)
    split = here & known & (feature >= 0)
    stop = here & ~split
    total = total + np.where(stop, level + _c_factors(np.where(known, size, 0)), 0.0).sum(axis=1)
    right = np.take_along_axis(X, np.where(split, feature, 0), axis=1) >= value
    return np.where(split, at * 2 + right, np.where(stop, 0, at)), total


def _arrays(x: pd.Series, nodes: pd.Series, path: pd.Series):
    return (np.stack([np.asarray(v, dtype=np.float64) for v in x]), np.stack([np.asarray(v, dtype=np.int64) for v in nodes]),
            path.to_numpy(np.float64).copy())


def _slices(x: pd.Series, nodes: pd.Series):
    """A batch in slices of ``WALK_CELLS`` nodes and components."""
    step = max(1, WALK_CELLS // max(1, len(x.iloc[0]), len(nodes.iloc[0])))
    return (slice(i, min(i + step, len(x))) for i in range(0, len(x), step))


def _walk(tables: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
    """The levels of ``tables``, whose rows are looked up by key."""

    @F.pandas_udf(_STATE)
    def step(x: pd.Series, nodes: pd.Series, path: pd.Series) -> pd.DataFrame:
        if not len(x):
            return pd.DataFrame({"nodes": [], "path": pd.Series([], dtype="float64")})
        ends, paths = [], []
        for part in _slices(x, nodes):
            X, at, total = _arrays(x.iloc[part], nodes.iloc[part], path.iloc[part])
            tree = np.arange(at.shape[1], dtype=np.int64) << _NODE_BITS
            for level, keys, feature, value, size in tables:
                key = tree[None] | at
                i = np.clip(np.searchsorted(keys, key), 0, max(0, len(keys) - 1))
                at, total = _advance(X, at, total, level, keys[i] == key, feature[i], value[i], size[i])
            ends += list(at)
            paths.append(total)
        return pd.DataFrame({"nodes": ends, "path": np.concatenate(paths)})

    return step


def _walk_joined(level: int):
    """One level whose node rows were joined to the records (``hits``: at most one for each tree)."""

    @F.pandas_udf(_STATE)
    def step(x: pd.Series, nodes: pd.Series, path: pd.Series, t: pd.Series, f: pd.Series, v: pd.Series, n: pd.Series) -> pd.DataFrame:
        if not len(x):
            return pd.DataFrame({"nodes": [], "path": pd.Series([], dtype="float64")})
        ends, paths = [], []
        for part in _slices(x, nodes):
            X, at, total = _arrays(x.iloc[part], nodes.iloc[part], path.iloc[part])
            known, feature, value, size = np.zeros(at.shape, bool), np.full(at.shape, -1), np.zeros(at.shape), np.zeros(at.shape)
            for r, trees in enumerate(t.iloc[part]):
                if trees is not None and len(trees):
                    i = part.start + r
                    known[r, trees], feature[r, trees], value[r, trees], size[r, trees] = True, f.iloc[i], v.iloc[i], n.iloc[i]
            at, total = _advance(X, at, total, level, known, feature, value, size)
            ends += list(at)
            paths.append(total)
        return pd.DataFrame({"nodes": ends, "path": np.concatenate(paths)})

    return step


def _join_level(rows: DataFrame, table: DataFrame, level: int) -> DataFrame:
    """``rows(__row, __x, __s, ...)`` one level on: (tree, node) of every record meets the node table on the executors,
    and the node rows come back to the record as one array."""
    at = rows.select("__row", F.posexplode("__s.nodes").alias("t", "node")).where((F.col("node") >= 1 << level) & (F.col("node") < 1 << level + 1))
    node_rows = table.select("t", "node", F.coalesce("f", F.lit(-1)).alias("f"), F.coalesce("v", F.lit(0.0)).alias("v"), F.col("n").cast("double").alias("n"))
    hits = at.join(node_rows, ["t", "node"]).groupBy("__row").agg(F.collect_list(F.struct("t", "f", "v", "n")).alias("__h"))
    both = rows.join(hits.withColumnRenamed("__row", "__hit"), F.col("__row") == F.col("__hit"), "left")
    moved = _walk_joined(level)("__x", F.col("__s.nodes"), F.col("__s.path"), *[F.col(f"__h.{c}") for c in ("t", "f", "v", "n")])
    return cut_lineage(both.withColumn("__s", moved).select(*rows.columns))


def _with_row(rows: DataFrame) -> DataFrame:
    """A number of its own for every record, fixed in a checkpoint (ids may repeat)."""
    return cut_lineage(rows.withColumn("__row", F.monotonically_increasing_id()))


def _c_factors(n: np.ndarray) -> np.ndarray:
    safe = np.maximum(n, 3)
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, 2.0 * (np.log(safe - 1.0) + EULER) - 2.0 * (safe - 1.0) / safe))


def _read_tables(levels: list[DataFrame], which: list[int]):
    """The node tables of a step as sorted arrays (``NODE_CHUNK`` rows at most)."""
    parts = [levels[lvl].select(F.lit(lvl).alias("level"), _key(F.col("t"), F.col("node")).alias("k"), F.coalesce("f", F.lit(-1)).alias("f"),
                                F.coalesce("v", F.lit(0.0)).alias("v"), F.col("n").cast("double").alias("n")) for lvl in which]
    rows = functools.reduce(DataFrame.unionByName, parts).toArrow()
    level, k, f, v, n = (rows.column(c).to_numpy() for c in ("level", "k", "f", "v", "n"))
    by = np.lexsort((k, level))
    cut = np.searchsorted(level[by], [*which, which[-1] + 1])
    return [(lvl, *(c[by[a:b]] for c in (k, f.astype(np.int64), v, n))) for lvl, a, b in zip(which, cut, cut[1:])]


class IsolationForestModel:
    def __init__(self, levels: list[DataFrame], level_rows: list[int], depth: int, psi: float, n_trees: int,
                 train: DataFrame | None, id_col: str, contamination: float, node_chunk: int = NODE_CHUNK):
        self.levels, self.level_rows, self.depth, self.psi, self.n_trees = levels, level_rows, depth, psi, n_trees
        self._train, self._id, self.contamination, self._threshold = train, id_col, contamination, None
        self.node_chunk = node_chunk

    @property
    def threshold(self) -> float | None:
        """Score above which a row is flagged (the ``1 - contamination`` quantile of
        the training scores); computed on first use - it needs a full traversal."""
        if self._threshold is None:
            if self._train is None:
                raise ValueError("the model was stored without its threshold and has no training rows")
            scored = self.transform(self._train.select(self._id, "features"), self._id)
            self._threshold = exact_quantile_values(scored, SCORE, [1.0 - self.contamination], interpolate=True)[0]
        return self._threshold

    def transform(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        """``df`` with the score: every record walks all trees in place (its node per tree is one array).

        A forest of at most ``node_chunk`` node rows goes out with the plan.  Of a larger one the driver holds one step
        at a time - each ends in a checkpoint - and no level wider than that: such a level is joined on the executors.
        """
        x = vector_to_array(F.col("features"))
        start = F.struct(F.array_repeat(F.lit(1).cast("long"), self.n_trees).alias("nodes"), F.lit(0.0).alias("path"))
        out = df.withColumn("__x", x).withColumn("__s", start)
        steps = _node_steps(self.level_rows, self.node_chunk)
        if len(steps) > 1 or sum(self.level_rows) > self.node_chunk:
            out = _with_row(out)
        for which in steps:
            if self.level_rows[which[0]] > self.node_chunk:
                out = _join_level(out, self.levels[which[0]], which[0])
                continue
            out = out.withColumn("__s", _walk(_read_tables(self.levels, which))("__x", F.col("__s.nodes"), F.col("__s.path")))
            if len(steps) > 1:
                out = cut_lineage(out)
        path = F.col("__s.path") / F.lit(float(self.n_trees))
        return out.select(*df.columns, F.pow(F.lit(2.0), -path / F.lit(c_factor(self.psi))).alias(SCORE))


class IsolationForestScorer:
    """M6: isolation forest.

    ``max_samples`` (fraction of rows, or an int count) draws each tree's sample
    by a seeded hash (1.0 = all rows); ``max_features`` draws each tree's
    feature subset.  A node splits on the first feature, in a random order of
    its own, that varies in the node, at a uniform point of its range.
    Depth limit ``ceil(log2(sample size))``.  ``contamination`` sets the
    score threshold (that quantile of the training scores).

    Layout: one row per record with its vector and the array of its node in
    every tree.  A level is one Spark aggregate of the nodes' ranges, combined in
    each task, only while nodes are large; a node of at most ``local_rows`` (by default 16 MB of vectors) is
    parked, and in the end one shuffle brings the records of every parked node
    into a task, which grows its subtree.  Both ways draw by the same hashes, so
    the forest does not depend on where they meet.
    """

    def __init__(self, n_estimators: int = 100, max_samples: float = 1.0, contamination: float = 0.1,
                 max_features: float = 1.0, seed: int = 42, node_chunk: int = NODE_CHUNK, local_rows: int | None = None):
        self.T, self.ms, self.cont, self.mf, self.seed, self.node_chunk, self.local_rows = (
            n_estimators, max_samples, contamination, max_features, seed, node_chunk, local_rows)

    def fit(self, train: DataFrame, id_col: str = "id") -> IsolationForestModel:
        normals = train.where(F.col("label") == 0) if "label" in train.columns else train
        x = vector_to_array(F.col("features"))
        base = normals.select(F.col(id_col).alias("__rid"), x.alias("__x")).persist()
        n, d = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("__x")).alias("d")).first()
        n, d = int(n), int(d or 1)
        frac = self.ms if isinstance(self.ms, float) else min(1.0, float(self.ms) / max(n, 1))
        psi = max(2.0, frac * n)
        depth = int(math.ceil(math.log2(psi)))
        m = max(1, int(self.mf * d))
        draws = Draws(self.T, d, m, self.seed)
        local = max(1, NODE_BYTES // (8 * d)) if self.local_rows is None else self.local_rows

        # a tree whose whole sample fits a task is parked at its root
        root = F.lit(-1 if n <= local else 1).cast("long")
        nodes = F.transform(F.sequence(F.lit(0), F.lit(self.T - 1)), lambda t: root)
        if frac < 1.0:
            nodes = F.transform(F.sequence(F.lit(0), F.lit(self.T - 1)), lambda t: F.when(
                F.pmod(F.xxhash64(F.lit(self.seed + 1), F.col("__rid"), t), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53)) < F.lit(frac),
                root).otherwise(F.lit(0).cast("long")))
        cur = base.select("__x", nodes.alias("nodes"))
        grown: list[DataFrame] = []
        if n > local:
            cur = cur.persist()
            top = grow_tops(cur, self.T, draws, depth, local)
            grown.append(top.frame(base.sparkSession))
            pending = top.pending
            if pending:
                waiting = cur.select("__x", F.posexplode(top.parked()("__x", "nodes")).alias("t", "node")).where("node > 0")
                grown.append(finish_subtrees(waiting.select(F.col("__x").alias("x"), "t", "node"), pending, d, draws, depth))
            cur.unpersist()
        elif n:
            grown.append(grow_trees(cur.select(F.col("__x").alias("x"), "nodes"), self.T, d, draws, depth))
        base.unpersist()
        columns = [F.col("t").cast("int").alias("t"), "node", F.col("n").cast("long").alias("n"), F.col("f").cast("int").alias("f"), "v", "level"]
        grown = grown or [base.sparkSession.createDataFrame([], NODES)]
        every = functools.reduce(DataFrame.unionByName, [g.select(*columns) for g in grown])
        counted = {r["level"]: int(r["n"]) for r in every.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
        levels = [every.where(F.col("level") == lvl).drop("level") for lvl in range(len(counted))]
        return IsolationForestModel(levels, [counted[lvl] for lvl in range(len(counted))], depth, psi, self.T, normals.select(id_col, "features"), id_col,
                                    self.cont, self.node_chunk)


class OneClassSVMModel:
    def __init__(self, fmap, w: np.ndarray, rho: float, objective: list[float] | None = None, converged: bool = True):
        self.fmap, self.w, self.rho = fmap, w, rho
        self.objective, self.converged = objective or [], converged

    def history(self) -> list[float]:
        """The nu-objective after each iteration."""
        return list(self.objective)

    def transform(self, df: DataFrame) -> DataFrame:
        w, rho = self.w, self.rho

        @F.arrow_udf("double")
        def below(column: pa.Array) -> pa.Array:
            return pa.array(rho - Rows(column, len(w)).dot(w))

        return self.fmap(df).select(*df.columns, below(stored("kfeat")).alias(SCORE))


class OneClassSVMScorer:
    """M7: one-class SVM (nu-formulation) on the kernel feature map.

    minimise 0.5|w|^2 + 1/(nu n) sum max(0, rho - w.z_i) - rho.  The hinge is
    rounded over ``corner`` (its value changes by less than half of that), so
    the problem is smooth and L-BFGS runs until the gradient is below ``tol``.
    Objective and gradient of each trial point are one Spark job: a sum per
    task, added up component by component on the executors; ``dim + 2`` numbers
    reach the driver, which holds a few dozen vectors of that length.  The poly
    map has ``sketch_size`` components at any width of the features; with the
    linear kernel sparse rows stay sparse.  ``max_iter`` is a stop for
    ill-posed input: reaching it warns, and ``converged`` is false.
    """

    def __init__(self, nu: float = 0.1, kernel: str = "rbf", gamma: str | float = "scale", n_components: int = 256,
                 degree: int = 3, max_iter: int = 500, seed: int = 42, tol: float = 1e-3, corner: float = 1e-2,
                 coef0: float = 0.0, sketch_size: int = 1024):
        self.nu, self.kernel, self.gamma, self.D, self.degree, self.iters, self.seed = (
            nu, kernel, gamma, n_components, degree, max_iter, seed)
        self.tol, self.corner, self.coef0, self.sketch = tol, corner, coef0, sketch_size

    def fit(self, train: DataFrame) -> OneClassSVMModel:
        normals = train.where(F.col("label") == 0) if "label" in train.columns else train
        fmap = kernel_map(normals, self.kernel, self.gamma, self.D, self.degree, self.seed, self.coef0, self.sketch)
        z = fmap(normals.select("features")).select(stored("kfeat").alias("u"), vector_width("kfeat").alias("d")).persist()
        first = z.agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).first()
        n, dim = int(first["n"]), int(first["d"] or 0)
        if not n:
            z.unpersist()
            return OneClassSVMModel(fmap, np.zeros(dim), 0.0, [], True)
        rows_in, corner, scale = fewer_tasks(z, n, 8 * dim), self.corner, 1.0 / (self.nu * n)
        tasks = rows_in.rdd.getNumPartitions()

        def value(point: np.ndarray) -> tuple[float, np.ndarray]:
            """Objective and gradient at ``(w, rho)``: one job."""
            w, rho = point[:-1], float(point[-1])

            def partial(batches):
                # one row per task: weighted vector sum, weight sum, hinge sum
                acc = np.zeros(dim + 2)
                for batch in batches:
                    rows = Rows(batch.column(0), dim)
                    u = rho - rows.dot(w)
                    slope = np.clip(u / corner, 0.0, 1.0)
                    acc[:dim] += rows.weighted_sum(slope)
                    acc[dim] += slope.sum()
                    acc[dim + 1] += np.where(u >= corner, u - corner / 2, np.where(u > 0, u * u / (2 * corner), 0.0)).sum()
                yield pa.RecordBatch.from_arrays([array_rows(acc[None])], names=["s"])

            total = summed_arrays(rows_in.select("u").mapInArrow(partial, "s array<double>"), tasks, dim + 2)
            gradient = np.concatenate([w - scale * total[:dim], [scale * total[dim] - 1.0]])
            return 0.5 * float(w @ w) + scale * float(total[dim + 1]) - rho, gradient

        best = minimise(value, np.zeros(dim + 1), self.tol, self.iters)
        z.unpersist()
        if not best.converged:
            import warnings

            warnings.warn(f"one-class SVM stopped with a gradient of {np.abs(best.gradient).max():.2e} (tolerance {self.tol:.0e})")
        return OneClassSVMModel(fmap, best.point[:-1], float(best.point[-1]), best.objective, best.converged)


class ReconstructionModel:
    def __init__(self, mean: np.ndarray, scale: np.ndarray, P: np.ndarray):
        self.mean, self.scale, self.P = mean, scale, P

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the score.  The axes are orthonormal, so a row's error is its square sum less that of its place on
        them; both follow from the stored components."""
        mean, width, shift = self.mean, len(self.mean), self.mean / self.scale
        axes, centre, base = self.P / self.scale[:, None], shift @ self.P, float(shift @ shift)
        inverse = 1.0 / self.scale ** 2

        @F.arrow_udf("double")
        def recon_error(column: pa.Array) -> pa.Array:
            rows = Rows(column, width)
            place = rows.dot(axes) - centre
            square = rows.row_sums(lambda i, a: (a * a - 2 * a * mean[i]) * inverse[i]) + base
            return pa.array(np.maximum(0.0, square - (place * place).sum(axis=1)) / width)

        return df.withColumn(SCORE, recon_error(stored("features")))


class ReconstructionScorer:
    """M8: scale on the normal rows (population std), the ``encoding_dim`` first principal axes, score = mean squared
    reconstruction error per row (A21).  Fitting and scoring read the stored components of sparse rows only, and no
    matrix of width x width is made, see :func:`principal_axes`."""

    def __init__(self, encoding_dim: int = 32):
        self.k = encoding_dim

    def fit(self, train: DataFrame) -> ReconstructionModel:
        normals = train.where(F.col("label") == 0) if "label" in train.columns else train
        from pyspark.ml.stat import Summarizer

        row = normals.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s")).first()["s"]
        mean, n = row["mean"].toArray(), int(row["count"] or 1)
        variance = row["variance"].toArray() * ((n - 1.0) / n if n > 1 else 0.0)  # population variance
        scale = np.where(variance > 1e-300, np.sqrt(np.maximum(variance, 0.0)), 1.0)
        kept = fewer_tasks(normals.select(stored("features").alias("u")).persist(), n, 8 * len(mean))
        axes, _ = principal_axes(kept, kept.rdd.getNumPartitions(), n, mean, scale, min(self.k, len(mean)))
        kept.unpersist()
        return ReconstructionModel(mean, scale, axes)
