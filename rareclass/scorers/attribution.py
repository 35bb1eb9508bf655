"""Attribution of tree scores to components: exact Shapley values of boosted trees and forests.

A component that is not known follows both branches of its nodes, each with the share of the background's rows that went there.
Along one path to a leaf, a component known to the row either keeps to the path or leaves it, so its Shapley value is a sum over
paths of a weight that depends only on which of the path's components keep to it.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .boosting import BoostedModel, leaves
from .forest import ForestModel
from .rows import Rows, stored, summed_arrays, vector_width

# Rows that a task takes through a tree together, and numbers (rows x components) of its result.
BLOCK_ROWS = 32_768
BLOCK_NUMBERS = 1 << 20
# Numbers of a table that tells sets of kept components apart.
TABLE_NUMBERS = 1 << 22

ATTRIBUTION = "array<struct<feature:int,value:double>>"


def covers(model: BoostedModel, background: DataFrame) -> list[np.ndarray]:
    """How many rows of ``background`` pass each node of each tree: one job, the counts are added up."""
    used = model.used()
    trees = model.arrays(used)
    ends = np.cumsum([0] + [len(t[-1]) for t in trees])

    def partial(arrow):
        total = np.zeros(ends[-1])
        for b in arrow:
            x = b.column("x")
            if not len(x):
                continue
            for _, _, block in model.blocks(Rows(x, b.column("d")[0].as_py()), used):
                for k, tree in enumerate(trees):
                    total[ends[k]:ends[k + 1]] += np.bincount(leaves(tree, block), minlength=len(tree[-1]))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["s"])

    rows = background.where("features is not null").select(stored("features").alias("x"), vector_width("features").alias("d"))
    total = summed_arrays(rows.mapInArrow(partial, "s array<double>"), rows.rdd.getNumPartitions(), int(ends[-1]))
    out = []
    for k, (_, inner, _, _, left, _) in enumerate(trees):
        own = total[ends[k]:ends[k + 1]]
        for node in np.flatnonzero(inner)[::-1]:  # children stand behind their parents
            own[node] = own[left[node]] + own[left[node] + 1]
        out.append(own)
    return out


def shares_left(tree: tuple, cover: np.ndarray) -> np.ndarray:
    """The share of the background at each node that goes left; half if no row passed the node."""
    _, inner, _, _, left, _ = tree
    out = np.full(len(inner), 0.5)
    node = np.flatnonzero(inner)
    a, b = cover[left[node]], cover[left[node] + 1]
    out[node[a + b > 0]] = (a / np.maximum(a + b, 1))[a + b > 0]
    return out


def background_mean(tree: tuple, cover: np.ndarray) -> float:
    """The tree's value if no component is known."""
    _, inner, _, _, left, value = tree
    share, reach = shares_left(tree, cover), np.zeros(len(inner))
    reach[0] = 1.0
    for node in np.flatnonzero(inner):  # children stand behind their parents
        reach[left[node]], reach[left[node] + 1] = reach[node] * share[node], reach[node] * (1 - share[node])
    return float((reach * value)[~inner].sum())


@functools.cache
def _rule(points: int) -> tuple[np.ndarray, np.ndarray]:
    """The Gauss-Legendre rule on 0 to 1."""
    at, weight = np.polynomial.legendre.leggauss(points)
    return (at + 1) / 2, weight / 2


def path_weights(keeps: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """For rows of ``keeps`` (which components keep to the path), each component's Shapley value on a path of value 1.

    The Shapley weight of a subset of size s among m is the integral of t^s (1-t)^(m-1-s) over t from 0 to 1, so the sum over
    all subsets is the integral of a product over the other components.  It has degree m - 1 in t: a Gauss-Legendre rule with
    (m + 1) // 2 points is exact.  The product over all components is divided by a component's own factor, which is
    ``t + share (1 - t)`` if it keeps to the path, else ``share (1 - t)``.
    """
    t, w = _rule((len(shares) + 1) // 2)
    leaves_it = np.maximum(shares[:, None] * (1 - t), 1e-300)
    keeps_to = t + leaves_it
    low = np.log(leaves_it)
    product = np.exp(np.einsum("uk,kq->uq", keeps, np.log(keeps_to) - low) + low.sum(axis=0))
    kept = np.einsum("uq,kq->uk", product, w * (1 - shares)[:, None] / keeps_to)
    return np.where(keeps > 0, kept, -np.einsum("uq,q->u", product, w / (1 - t))[:, None])


def _numbered(code: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Codes below ``size`` as numbers without gaps, and how many there are."""
    if size > TABLE_NUMBERS:
        found, number = np.unique(code, return_inverse=True)
        return number, len(found)
    there = np.zeros(size, bool)
    there[code] = True
    found = np.flatnonzero(there)
    place = np.empty(size, np.intp)
    place[found] = np.arange(len(found))
    return place.take(code, mode="clip"), len(found)


def _kept(keeps: list[np.ndarray] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different columns of ``keeps`` (components x rows), and which of them each row has: eight components at a time, by tables."""
    same, count = None, 1
    for i in range(0, len(keeps), 8):
        byte = keeps[i].astype(np.uint8)
        for k in range(i + 1, min(len(keeps), i + 8)):
            byte |= keeps[k].view(np.uint8) << np.uint8(k - i)
        number, several = _numbered(byte.astype(np.intp), 256)
        if same is None:
            same, count = number, several
        else:
            same *= several
            same += number
            same, count = _numbered(same, count * several)
    one = np.zeros(count, np.intp)
    one[same] = np.arange(len(same))
    return np.array([k[one] for k in keeps]), same


def _add_values(out: np.ndarray, x: np.ndarray, tree: tuple, cover: np.ndarray) -> None:
    """Adds the attributions of the columns of ``x`` (components x rows) by one tree to ``out``.

    Down the tree, a path has for each of its components the rows that keep to it and the background's share that does.
    """
    place, inner, threshold, missing_left, left, value = tree
    share = shares_left(tree, cover)
    worth = ~inner & (value != 0)
    for node in np.flatnonzero(inner)[::-1]:
        worth[node] = worth[left[node]] or worth[left[node] + 1]
    held = np.empty(x.shape[1])
    open_ = [(0, [], [], [])] if worth[0] else []
    while open_:
        node, parts, keeps, shares = open_.pop()
        if inner[node]:
            part = int(place[node])
            lefts = x[part] < threshold[node]
            if missing_left[node]:
                lefts |= np.isnan(x[part])
            at = parts.index(part) if part in parts else len(parts)
            for child, goes, s in ((left[node] + 1, ~lefts, 1 - share[node]), (left[node], lefts, share[node])):
                if not worth[child]:
                    continue
                if at < len(parts):
                    open_.append((child, parts, [*keeps[:at], keeps[at] & goes, *keeps[at + 1:]], [*shares[:at], shares[at] * s, *shares[at + 1:]]))
                else:
                    open_.append((child, [*parts, part], [*keeps, goes], [*shares, s]))
        elif parts:
            # rows that keep to the same components have the same values
            sets, same = _kept(keeps)
            found = np.ascontiguousarray(value[node] * path_weights(sets.T.astype(float), np.array(shares)).T)
            for k, part in enumerate(parts):
                out[part] += np.take(found[k], same, out=held, mode="clip")


def tree_attribution(model: BoostedModel | ForestModel, df: DataFrame, background: DataFrame) -> DataFrame:
    """``df`` with ``base`` (the mean over the background as the trees see it) and ``attribution`` (component and value, by
    component, zeros left out): exact Shapley values.

    ``base`` and the values add up to the margin of boosted trees (log odds), to the score of a forest.  NaN is a missing value
    and goes where the trees send it; null features have null attributions; a model without trees attributes nothing.  A task
    takes a block of rows through a share of the trees; the blocks' sums are added up.  Trees of a forest come in the steps of
    its scoring.
    """
    forest = isinstance(model, ForestModel)
    scale = 1 / max(1, model.n_trees) if forest else 1.0
    several = forest and sum(s[2] for s in model.sizes) > model.model_nodes
    base = 0.5 if forest and not model.tops else 0.0
    steps = (s for s in (model.steps() if forest else [model.trees]) if s)
    nothing = F.when(F.col("features").isNotNull(), F.array().cast(ATTRIBUTION))
    rows = sums = None
    for step in steps:
        part = BoostedModel(step, [])
        used = part.used()
        trees = part.arrays(used)
        passed = covers(part, background)
        base += scale * sum(background_mean(t, c) for t, c in zip(trees, passed))
        if rows is None:
            rows = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))  # written: the numbers stay
            known = rows.where("features is not null").select("__row", stored("features").alias("x"), vector_width("features").alias("d"))
            count = known.count()
            width = known.agg(F.max("d")).first()[0] or 1
            blocks = max(1, -(-count // max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // width))))
        found = _block_sums(known, blocks, part, used, trees, passed, scale)
        found = cut_lineage(found) if several else found  # one step's trees at a time
        sums = found if sums is None else sums.unionByName(found)
    if sums is None:
        return df.withColumn("attribution", nothing).withColumn("base", F.lit(float(base)))
    total = sums.groupBy("block").applyInArrow(_block_total, f"__row long, attribution {ATTRIBUTION}")
    return rows.join(total, "__row", "left").drop("__row").withColumn("base", F.lit(float(base)))


def _block_sums(known: DataFrame, blocks: int, model: BoostedModel, used: np.ndarray, trees: list[tuple], passed: list[np.ndarray], scale: float) -> DataFrame:
    """``block, rows, used, sums`` for each block of rows and share of the trees: rows by number, sums by component and row."""
    shares = min(len(trees), max(1, -(-3 * known.sparkSession.sparkContext.defaultParallelism // blocks)))  # few bytes, much work

    def block_sums(key, table):
        table = table.sort_by("__row").combine_chunks()
        task = key[0].as_py()
        x = np.concatenate([x for _, _, x in model.blocks(Rows(table.column("x").chunk(0), table.column("d")[0].as_py()), used)])
        x = np.ascontiguousarray(x.T)
        out = np.zeros(x.shape)
        for tree, cover in list(zip(trees, passed))[task % shares::shares]:
            _add_values(out, x, tree, cover)
        return pa.table({"block": pa.array([task // shares], pa.int32()), "rows": [table.column("__row").to_numpy().astype(np.int64).tobytes()],
                         "used": [used.astype(np.int64).tobytes()], "sums": [(scale * out).tobytes()]})

    block = F.pmod(F.xxhash64("__row"), F.lit(blocks))
    share = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    tasks = known.select("__row", "x", "d", share.alias("share")).select("__row", "x", "d", (block * shares + F.col("share")).alias("task"))
    return tasks.repartitionByRange(blocks * shares, "task").groupBy("task").applyInArrow(block_sums, "block int, rows binary, used binary, sums binary")


def _block_total(key, table):
    """The attributions of a block's rows from the sums of its tasks."""
    rows = np.frombuffer(table.column("rows")[0].as_buffer(), np.int64)
    parts = [(np.frombuffer(u.as_buffer(), np.int64), s) for u, s in zip(table.column("used"), table.column("sums"))]
    used = np.unique(np.concatenate([u for u, _ in parts]))
    total = np.zeros((len(used), len(rows)))
    for u, s in parts:
        total[np.searchsorted(used, u)] += np.frombuffer(s.as_buffer()).reshape(len(u), len(rows))
    row, column = np.nonzero(total.T)
    entries = pa.StructArray.from_arrays([pa.array(used[column].astype(np.int32)), pa.array(total[column, row])], ["feature", "value"])
    ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(rows)))]
    return pa.table({"__row": pa.array(rows), "attribution": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)})
