"""Random forest (M2): Gini trees from histograms of class counts, bootstrap draws, any depth.

Rows are cut into cells as for the boosted trees (:mod:`boosting`).  Rows with equal label and cells are one row with a number
of copies; how often a tree draws its copies follows from a hash of the row and the tree, so a forest depends on the data and
the seed only.  While nodes are large, a job adds the class counts of many nodes of many trees; a node whose rows fit a task is
parked, and one shuffle brings the rows of parked nodes into tasks that grow whole subtrees by the same code.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_partitions
from .boosting import Batch, Bins, BoostedModel, Tree, find_bins
from .rows import TASK_BYTES, Rows, fewer_tasks, stored, summed_arrays, vector_width

# Numbers of one job's histograms (three a cell), and nodes of the trees that a scoring pass holds.
HISTOGRAM_NUMBERS = 4 << 20
MODEL_NODES = 500_000
# Copies of a row that are drawn one by one; more are drawn together, from the same distribution.
COPIES = 32

PART = "tree int, node int, feature array<int>, threshold array<double>, missing_left array<boolean>, left array<int>, value array<double>"
_ARROW = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.list_(pa.int32())), ("threshold", pa.list_(pa.float64())),
                    ("missing_left", pa.list_(pa.bool_())), ("left", pa.list_(pa.int32())), ("value", pa.list_(pa.float64()))])

# Poisson with mean 1: the number of times that a bootstrap sample of a large table holds a row
_PMF = np.array([math.exp(-1) / math.factorial(k) for k in range(20)])
_PMF /= _PMF.sum()
_CDF = np.cumsum(_PMF)[:-1]


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seed(*parts: int) -> int:
    out = np.zeros(1, np.uint64)
    for p in parts:
        out = _mix(out ^ np.uint64(p & (1 << 64) - 1))
    return int(out[0])


def draws(row_hash: np.ndarray, copies: np.ndarray, tree_seed: int) -> tuple[np.ndarray, np.ndarray]:
    """How often a tree draws each row's copies, and how many of the copies it draws at all."""
    key = _mix(row_hash.astype(np.int64).view(np.uint64) ^ np.uint64(tree_seed))
    total, distinct = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    for j in range(min(COPIES, int(copies.max(initial=0)))):
        some = np.flatnonzero((copies > j) & (copies <= COPIES))
        u = (_mix(key[some] + np.uint64(j)) >> np.uint64(11)) * 2.0 ** -53
        w = np.searchsorted(_CDF, u, "right")
        total[some] += w
        distinct[some] += w > 0
    for i in np.flatnonzero(copies > COPIES):
        times = np.random.default_rng(int(key[i])).multinomial(copies[i], _PMF)
        total[i], distinct[i] = times @ np.arange(len(times)), copies[i] - times[0]
    return total, distinct


class Rule:
    """When a node is split, and how the classes weigh."""

    def __init__(self, width: int, max_depth: int | None, min_samples_split: int, min_samples_leaf: int, class_weights: tuple[float, float] | None):
        self.width, self.features = width, max(1, int(math.sqrt(width)))
        self.depth, self.split, self.leaf = max_depth or 1 << 30, max(2, min_samples_split), max(1, min_samples_leaf)
        self.class_weights = class_weights  # None: from each tree's own sample

    def weights(self, totals: np.ndarray) -> np.ndarray:
        if self.class_weights is not None:
            return np.array(self.class_weights)
        return balanced(totals[0], totals[1])

    def open(self, totals: np.ndarray, depth: int) -> bool:
        return depth < self.depth and totals[2] >= max(self.split, 2 * self.leaf) and totals[0] > 0 and totals[1] > 0

    def tried(self, seed: int, attempt: int) -> np.ndarray:
        """The components of one attempt at a node, in the order drawn: the square root of the width, then - while all
        before were constant in the node - as many again, twice as many, and so on."""
        lo = self.features << (attempt - 1) if attempt else 0
        return np.random.default_rng(seed).permutation(self.width)[lo:self.features << attempt]


def balanced(negatives: float, positives: float) -> np.ndarray:
    """The rows over twice the rows of a class; 1 for a class without rows."""
    n = negatives + positives
    return np.array([n / (2 * c) if c else 1.0 for c in (negatives, positives)])


class Growing(Tree):
    """A tree, or a subtree, whose open nodes are still to be split."""

    def __init__(self, index: int, seed: int, depth: int = 0, weights: np.ndarray | None = None):
        super().__init__()
        self.index, self.weights, self.seed, self.depth, self.totals = index, weights, [seed], [depth], [None]

    def child(self, node: int, side: int, totals: np.ndarray) -> int:
        k = self.left[node] + side
        self.seed.append(_seed(self.seed[node], side)), self.depth.append(self.depth[node] + 1), self.totals.append(totals)
        self.value[k] = self.share(totals)
        return k

    def share(self, totals: np.ndarray) -> float:
        w = self.weights * totals[:2]
        return float(w[1] / w.sum()) if w.sum() > 0 else 0.0


class Layout:
    """Where the sums of a job's nodes stand: per node the cells of its components as drawn, then the node's total."""

    def __init__(self, bins: Bins, wanted: list[tuple[Growing, int, np.ndarray]]):
        self.parts, self.by_tree, at = [], {}, 0
        for tree, node, features in wanted:
            sizes = bins.bins[features] + 1
            self.parts.append((tree, node, features, at, at + int(sizes.sum())))
            self.by_tree.setdefault(id(tree), []).append(self.parts[-1])
            at += int(sizes.sum()) + 1
        self.size = at


class Sample(Batch):
    """The rows of a batch that a tree draws: label, times drawn, copies drawn, cells."""

    def __init__(self, y: np.ndarray, drawn: np.ndarray, distinct: np.ndarray, counts: np.ndarray, cells: np.ndarray, bins: Bins):
        super().__init__(y, counts, cells, bins)
        self.counts, self.drawn, self.distinct = counts, drawn, distinct

    @classmethod
    def drawn_of(cls, batch: Batch, kept: np.ndarray, drawn: np.ndarray, distinct: np.ndarray) -> "Sample":
        """Some rows of a batch with a table of all their cells, which is all that walking and adding up ask for."""
        out = cls.__new__(cls)
        out.y, out.drawn, out.distinct, out.bins, out.table = batch.y[kept], drawn[kept], distinct[kept], batch.bins, batch.table[kept]
        out._tree, out._at = None, None
        return out

    def only(self, kept: np.ndarray) -> "Sample":
        out = Sample(self.y[kept], self.drawn[kept], self.distinct[kept], self.counts[kept], self.cells[kept[self.row]], self.bins)
        out._tree, out._at = self._tree, self._at[kept]
        return out

    def add_sums(self, out: np.ndarray, parts: list[tuple]) -> None:
        """Adds draws of label 0, of label 1 and the copies drawn to the places of one tree's nodes."""
        tree, lo, hi = parts[0][0], parts[0][3], parts[-1][4] + 1
        place = np.full(len(tree.left), -1)
        place[[p[1] for p in parts]] = np.arange(len(parts))
        slot = place[self.walk(tree)]
        there = np.flatnonzero(slot >= 0)
        key, row = self._tabled(parts, slot, there) if self.table is not None else self._listed(parts, slot)
        key -= lo
        total = np.array([p[4] for p in parts])[slot[there]] - lo
        for k, w in enumerate((self.drawn * (self.y == 0), self.drawn * (self.y == 1), self.distinct)):
            out[k, lo:hi] += np.bincount(key, w[row], hi - lo)
            out[k, lo:hi] += np.bincount(total, w[there], hi - lo)

    def _listed(self, parts: list[tuple], slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and rows of the listed cells that the nodes ask for."""
        shift = np.full((len(parts), self.bins.width), -(1 << 60))
        for k, (_, _, features, at, _) in enumerate(parts):
            sizes = self.bins.bins[features] + 1
            shift[k, features] = at + np.cumsum(sizes) - sizes - self.bins.start[features]
        used = np.flatnonzero(slot[self.row] >= 0)
        key = shift[slot[self.row[used]], self.of[used]] + self.cells[used]
        inside = key >= 0
        return key[inside], self.row[used[inside]]

    def _tabled(self, parts: list[tuple], slot: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by the table, which holds zero's cells too: only the components that a row's node asks for are read."""
        most = max(len(p[2]) for p in parts)
        asked, shift = np.zeros((len(parts), most), np.int64), np.zeros((len(parts), most), np.int64)
        number = np.array([len(p[2]) for p in parts])
        for k, (_, _, features, at, _) in enumerate(parts):
            sizes = self.bins.bins[features] + 1
            asked[k, :len(features)] = features
            shift[k, :len(features)] = at + np.cumsum(sizes) - sizes - self.bins.start[features]
        keys, rows = [], []
        for j in range(most):
            row = there if number.min() > j else there[number[slot[there]] > j]
            node = slot[row]
            keys.append(self.table[row, asked[node, j]] + shift[node, j])
            rows.append(row)
        return np.concatenate(keys), np.concatenate(rows)


def best_split(bins: Bins, hist: np.ndarray, total: np.ndarray, features: np.ndarray, weights: np.ndarray, least: int, first_only: bool):
    """``(feature, cell, missing_left, left totals)`` of the cut with the smallest weighted Gini impurity, None without one, and
    whether all components are constant in the node.  Of equal cuts the first drawn and lowest wins; missing values go right if
    equal."""
    sizes = bins.bins[features] + 1
    start, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(features)), sizes)
    hist = hist.copy()
    hist[:, start + bins.zero[features] - bins.start[features]] += total[:, None] - np.add.reduceat(hist, start, axis=1)  # rows that store no cell hold zero
    varied = np.add.reduceat((hist[2] > 0).astype(np.int64), start) > 1
    if not varied.any():
        return None, True
    # a cut behind an empty cell is the cut before it: cells with rows, each component's first and its last two are enough
    first, behind = start, start + sizes - 1
    filled = hist[2] > 0
    filled[first] = filled[behind] = filled[behind - 1] = True
    cells = np.flatnonzero(filled)
    hist, of, start, behind = hist[:, cells], of[cells], np.searchsorted(cells, first), np.searchsorted(cells, behind)
    run = np.cumsum(hist, axis=1)
    run -= (run - hist)[:, start][:, of]
    gone = hist[:, behind][:, of]
    allowed = varied[of] if not first_only else of == int(np.argmax(varied))
    allowed[behind] = False
    last = np.zeros(len(of), bool)
    last[behind - 1] = True

    def purity(left: np.ndarray, fits: np.ndarray) -> np.ndarray:
        right = total[:, None] - left
        fits = fits & (left[2] >= least) & (right[2] >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            l, r = left[:2] * weights[:, None], right[:2] * weights[:, None]
            return np.where(fits, (l ** 2).sum(axis=0) / l.sum(axis=0) + (r ** 2).sum(axis=0) / r.sum(axis=0), -np.inf)

    right = purity(run, allowed)
    left = purity(run + gone, allowed & ~last & (gone[2] > 0)) if gone[2].any() else np.full(len(of), -np.inf)
    best = np.maximum(right, left)
    at = int(np.argmax(best))
    if best[at] == -np.inf:
        return None, False
    f = int(features[of[at]])
    missing_left = bool(left[at] > right[at])
    return (f, int(bins.start[f] + cells[at] - first[of[at]]), missing_left, run[:, at] + (gone[:, at] if missing_left else 0)), False


def grow(source, bins: Bins, trees: list[Growing], rule: Rule, park: float = 0) -> list[tuple[Growing, int]]:
    """Splits the trees' open nodes level by level with the sums that ``source`` gives; returns the nodes of at most ``park``
    drawn rows, which stay leaves for now."""
    level, parked = [(t, 0, 0) for t in trees], []
    while level:
        source.focus(level)
        wanted, following, size = [], [], 0
        for n, (tree, node, attempt) in enumerate(level):
            features = rule.tried(tree.seed[node], attempt)
            wanted.append((tree, node, features, attempt))
            size += max(3 * int((bins.bins[features] + 1).sum()) + 3, bins.width)
            if size < HISTOGRAM_NUMBERS and n + 1 < len(level):
                continue
            layout = Layout(bins, [w[:3] for w in wanted])
            sums = source.sums(layout)
            for (_, _, _, attempt), (tree, node, features, lo, hi) in zip(wanted, layout.parts):
                total = sums[:, hi]
                if tree.totals[node] is None:
                    tree.totals[node] = total
                    if tree.weights is None:
                        tree.weights = rule.weights(total)
                    tree.value[node] = tree.share(total)
                    if not rule.open(total, tree.depth[node]):
                        continue
                found, constant = best_split(bins, sums[:, lo:hi], total, features, tree.weights, rule.leaf, attempt > 0)
                if constant and rule.features << attempt < rule.width:
                    following.append((tree, node, attempt + 1))
                if found is None:
                    continue
                f, cell, missing_left, left = found
                tree.split(node, f, cell, missing_left)
                for side, totals in enumerate((left, total - left)):
                    k = tree.child(node, side, totals)
                    if rule.open(totals, tree.depth[k]):
                        (parked if totals[2] <= park else following).append((tree, k) if totals[2] <= park else (tree, k, 0))
            wanted, size = [], 0
        level = sorted(following, key=lambda w: w[0].index)  # a tree's nodes of one job stand together
    return parked


class Local:
    """Sums over one tree's sample in a task."""

    def __init__(self, sample: Sample):
        self.sample = sample

    def focus(self, level: list[tuple[Growing, int, int]]) -> None:
        """Drops the rows of closed nodes once they are half of all."""
        tree, s = level[0][0], self.sample
        at = s.walk(tree)
        is_open = np.zeros(len(tree.left), bool)
        is_open[[w[1] for w in level]] = True
        kept = is_open[at]
        if 2 * np.count_nonzero(kept) > len(kept):
            return
        if s.table is None:
            self.sample = s.only(kept)
        else:
            self.sample = Sample.drawn_of(s, kept, s.drawn, s.distinct)
            self.sample._tree, self.sample._at = tree, at[kept]

    def sums(self, layout: Layout) -> np.ndarray:
        out = np.zeros((3, layout.size))
        for parts in layout.by_tree.values():
            self.sample.add_sums(out, parts)
        return out


class Cluster:
    """Sums over the rows of a frame: one job each."""

    def __init__(self, rows: DataFrame, bins: Bins):
        self.rows, self.bins, self.tasks = rows, bins, rows.rdd.getNumPartitions()

    def focus(self, level: list[tuple[Growing, int, int]]) -> None:
        pass

    def sums(self, layout: Layout) -> np.ndarray:
        bins, size, groups = self.bins, layout.size, list(layout.by_tree.values())

        def partial(arrow):
            total = np.zeros((3, size))
            for b in arrow:
                whole = Batch(b.column("y").to_numpy(), b.column("cells").value_lengths().to_numpy(), b.column("cells").flatten().to_numpy(), bins)
                for parts in groups:
                    tree = parts[0][0].index
                    if whole.table is None:
                        _sample(b, tree, bins).add_sums(total, parts)
                        continue
                    drawn, distinct = draws(b.column("h").to_numpy(), b.column("copies").to_numpy(), _seed(tree))
                    Sample.drawn_of(whole, drawn > 0, drawn, distinct).add_sums(total, parts)
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["s"])

        return summed_arrays(self.rows.mapInArrow(partial, "s array<double>"), self.tasks, 3 * size).reshape(3, size)


def _sample(b: pa.RecordBatch, tree: int, bins: Bins) -> Sample:
    """What tree number ``tree`` draws of a batch of ``y, copies, h, cells``."""
    counts, cells = b.column("cells").value_lengths().to_numpy(), b.column("cells").flatten().to_numpy()
    drawn, distinct = draws(b.column("h").to_numpy(), b.column("copies").to_numpy(), _seed(tree))
    kept = drawn > 0
    return Sample(b.column("y").to_numpy()[kept], drawn[kept], distinct[kept], counts[kept], cells[np.repeat(kept, counts)], bins)


def _part(tree: Growing, node: int, bins: Bins) -> dict:
    edges = [float(bins.edge[c]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cell)]
    return {"tree": tree.index, "node": node, "feature": tree.feature, "threshold": edges, "missing_left": tree.missing_left,
            "left": tree.left, "value": tree.value}


def fit_forest(train: DataFrame, n_estimators: int, max_depth: int | None, min_samples_split: int, min_samples_leaf: int,
               class_weight: str | None, seed: int, max_bins: int, task_bytes: int = TASK_BYTES) -> "ForestModel":
    """Fits on rows with a label and features.  NaN components are missing values; an empty table gives no tree.

    ``min_samples_split`` and ``min_samples_leaf`` count the rows that a tree drew, each once.
    """
    spark = train.sparkSession
    train = train.where("label is not null and features is not null").select(F.col("label").cast("double").alias("label"), "features")
    size = train.agg(F.count(F.lit(1)).alias("n"), F.max(vector_width("features")).alias("d"), F.sum((F.col("label") == 1).cast("long")).alias("ones")).first()
    if not size["n"]:
        return ForestModel([], None, [], 0)
    width = size["d"]
    bins = find_bins(train, width, size["n"], max_bins)

    def binned(arrow):
        for b in arrow:
            rows = Rows(b.column("x"), width)
            row, index, value = rows.triples()
            cell = bins.cell(index, value)
            kept = cell != bins.zero[index]
            ends = np.r_[0, np.cumsum(np.bincount(row[kept], minlength=rows.n))]
            cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cell[kept], pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array((b.column("label").to_numpy() == 1).astype(np.int8)), cells], ["y", "cells"])

    rows = cut_lineage(
        train.select("label", stored("features").alias("x")).mapInArrow(binned, "y tinyint, cells array<int>")
        .groupBy("y", "cells").agg(F.count(F.lit(1)).alias("copies")).withColumn("h", F.xxhash64("y", "cells", F.lit(seed))))
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("cells")).alias("cells")).first()
    row_bytes = 32 + 4 * (counted["cells"] / counted["n"])
    weights = {"balanced": tuple(balanced(size["n"] - size["ones"], size["ones"])), "balanced_subsample": None}.get(class_weight, (1.0, 1.0))
    rule = Rule(width, max_depth, min_samples_split, min_samples_leaf, weights)
    trees = [Growing(t, _seed(seed, t)) for t in range(n_estimators)]

    def finished(samples: Iterator[tuple[Growing, int, Sample]]) -> pa.Table:
        out = []
        for tree, node, sample in samples:
            grow(Local(sample), bins, [tree], rule)
            out.append(_part(tree, node, bins))
        return pa.Table.from_pylist(out, _ARROW)

    if counted["n"] * row_bytes <= task_bytes:
        shares = min(n_estimators, shuffle_partitions(spark))

        def share(key, table):
            b = table.combine_chunks().to_batches()[0]
            mine = range(key[0].as_py(), n_estimators, shares)
            return finished((Growing(t, _seed(seed, t)), 0, _sample(b, t, bins)) for t in mine)

        spread = rows.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).repartitionByRange(shares, "share")  # few bytes, much work: a task a share
        parts = cut_lineage(spread.groupBy("share").applyInArrow(share, PART))
        tops = [_part(t, -1, bins) for t in trees]
    else:
        rows = fewer_tasks(rows, counted["n"], int(row_bytes))
        parked = grow(Cluster(rows, bins), bins, trees, rule, task_bytes / row_bytes)
        tops = [_part(t, -1, bins) for t in trees]
        if not parked:
            return ForestModel(tops, None, [], n_estimators)
        at_node = {(t.index, k): (t.seed[k], t.depth[k], t.weights) for t, k in parked}
        waiting = sorted({t.index: t for t, _ in parked}.values(), key=lambda t: t.index)
        inside = {t.index: np.isin(np.arange(len(t.left)), [k for u, k in parked if u is t]) for t in waiting}

        def sent(arrow):
            for b in arrow:
                for tree in waiting:
                    s = _sample(b, tree.index, bins)
                    at = s.walk(tree)
                    s = s.only(inside[tree.index][at])
                    if not len(s.y):
                        continue
                    ends = pa.array(np.r_[0, np.cumsum(s.counts)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s.y), tree.index, np.int32)), pa.array(s._at.astype(np.int32)), pa.array(s.y),
                         pa.array(s.drawn), pa.array(s.distinct), pa.ListArray.from_arrays(ends, pa.array(s.cells.astype(np.int32)))],
                        ["tree", "node", "y", "drawn", "distinct", "cells"])

        def subtree(key, table):
            t, node = (k.as_py() for k in key)
            b = table.combine_chunks().to_batches()[0]
            node_seed, depth, w = at_node[t, node]
            cells = b.column("cells")
            sample = Sample(b.column("y").to_numpy(), b.column("drawn").to_numpy(), b.column("distinct").to_numpy(),
                            cells.value_lengths().to_numpy(), cells.flatten().to_numpy(), bins)
            return finished(iter([(Growing(t, node_seed, depth, w), node, sample)]))

        moved = rows.mapInArrow(sent, "tree int, node int, y tinyint, drawn long, distinct long, cells array<int>")
        tasks = max(shuffle_partitions(spark), int(counted["n"] * row_bytes * n_estimators // (8 * max(task_bytes, 1 << 20))))
        parts = cut_lineage(moved.repartition(tasks, "tree", "node").groupBy("tree", "node").applyInArrow(subtree, PART))
    return ForestModel(tops, parts, _sizes(parts), n_estimators)


def _sizes(parts: DataFrame) -> list[tuple[int, int, int]]:
    return sorted((r[0], r[1], r[2]) for r in parts.select("tree", "node", F.size("feature")).collect())


class ForestModel:
    """The upper parts of the trees, and a table of the subtrees below their parked nodes (``sizes`` lists them)."""

    def __init__(self, tops: list[dict], parts: DataFrame | None, sizes: list[tuple[int, int, int]], n_trees: int, model_nodes: int = MODEL_NODES):
        self.tops, self.parts, self.sizes, self.n_trees, self.model_nodes = tops, parts, sizes, n_trees, model_nodes

    def history(self) -> list[float]:
        return []

    def frame(self, spark: SparkSession) -> DataFrame:
        """The whole model as a table."""
        tops = spark.createDataFrame([tuple(r[c] for c in _ARROW.names) for r in self.tops], PART)
        return tops if self.parts is None else tops.unionByName(self.parts)

    @classmethod
    def from_frame(cls, table: DataFrame) -> "ForestModel":
        tops = sorted((r.asDict() for r in table.where("node = -1").collect()), key=lambda r: r["tree"])
        parts = table.where("node >= 0")
        return cls(tops, parts, _sizes(parts), len(tops))

    def steps(self) -> Iterator[list[dict]]:
        """Trees that add up to the forest: each step holds the subtrees of about ``model_nodes`` nodes under their upper parts."""
        groups, total = [[]], 0
        for tree, node, n in self.sizes:
            if groups[-1] and total + n > self.model_nodes:
                groups.append([])
                total = 0
            groups[-1].append((tree, node))
            total += n
        for first, group in enumerate(groups):
            below: dict[int, list] = {}
            if group:
                pair = F.struct("tree", "node")
                low, high = (F.struct(F.lit(t).cast("int").alias("tree"), F.lit(n).cast("int").alias("node")) for t, n in (group[0], group[-1]))
                for r in self.parts.where(pair.between(low, high)).collect():
                    below.setdefault(r["tree"], []).append(r.asDict())
            parked: dict[int, list] = {}
            for t, n, _ in self.sizes:
                parked.setdefault(t, []).append(n)
            yield [_joined(top, below.get(top["tree"], []), parked.get(top["tree"], []), first == 0)
                   for top in self.tops if first == 0 or top["tree"] in below]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean share of label 1 in the trees' leaves as ``score``: 0.5 without trees, null for null features."""
        out = df.withColumn("score", F.when(F.col("features").isNotNull(), F.lit(0.0 if self.tops else 0.5)))
        if not self.tops:
            return out
        several = len(self.sizes) > 1 and sum(s[2] for s in self.sizes) > self.model_nodes
        for trees in self.steps():
            out = out.withColumn("score", F.col("score") + _shares(BoostedModel(trees, []), self.n_trees)(stored("features"), vector_width("features")))
            out = cut_lineage(out) if several else out
        return out


def _joined(top: dict, below: list[dict], parked: list[int], own_leaves: bool) -> dict:
    """A tree with some of its subtrees in place; parked nodes without one add nothing, the other leaves only with ``own_leaves``."""
    out = {c: list(top[c]) for c in ("feature", "threshold", "missing_left", "left", "value")}
    for k, f in enumerate(out["feature"]):
        if f < 0 and not own_leaves:
            out["value"][k] = 0.0
    for k in parked:
        out["value"][k] = 0.0
    for part in below:
        base, node = len(out["left"]) - 1, part["node"]  # node i > 0 of the subtree goes to base + i
        for c in ("feature", "threshold", "missing_left", "value"):
            out[c][node] = part[c][0]
            out[c] += part[c][1:]
        moved = [n + base if f >= 0 else 0 for n, f in zip(part["left"], part["feature"])]
        out["left"][node] = moved[0]
        out["left"] += moved[1:]
    return {"tree": top["tree"], **out}


def _shares(model: BoostedModel, n_trees: int):
    @F.arrow_udf("double")
    def score(x: pa.Array, width: pa.Array) -> pa.Array:
        known = x.is_valid().to_numpy(zero_copy_only=False)
        p = np.zeros(len(x))
        if known.any():
            p[known] = model.margins(Rows(x.drop_null(), int(max(width.drop_null().to_pylist())))) / n_trees
        return pa.array(p, mask=~known)

    return score
