"""Product codes of integer vectors: codebooks by Lloyd rounds, nearest entries by equal-average search."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, hinted, rename_clashes

# Squared distances and squared sum gaps must fit a long: |component| * components of a part stay below this.
MOST_SUM = 1 << 29


def integer_vectors(table: DataFrame, parts: int, scale: float, key: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, v``: components floor(scale * x), filled up with zeros to the longest vector's length, rounded up
    to a multiple of ``parts``.  Vectors that are null or hold null or non-finite components are left out."""
    base = rename_clashes(table, [key, label, vector]).toDF("vec_id", "label", "x").withColumn("x", F.col("x").cast("array<double>"))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    ints = F.transform("x", lambda e: F.floor(F.lit(float(scale)) * e).cast("long"))
    kept = cut_lineage(base.where(F.col("x").isNotNull() & fine).select("vec_id", "label", ints.alias("v")))
    facts = kept.agg(F.max(F.size("v")).alias("d"), F.max(F.array_max(F.transform("v", F.abs))).alias("top")).first()
    width = -(-max(1, facts["d"] or 1) // parts) * parts
    if (facts["top"] or 0) * (width // parts) >= MOST_SUM:
        raise OverflowError("a component is too large for distances that fit a long")
    return kept.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))))


class EqualAverage:
    """A codebook whose entries are sorted by component sum.

    By Cauchy and Schwarz the squared distance of two vectors of d components is at least their squared sum gap over d.
    """

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.order = np.lexsort((np.arange(len(entries)), sums))
        self.entries, self.sums = entries[self.order], sums[self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index of each row's nearest entry (ties to the lower index), its squared distance, and how many distances
        were computed.

        Every row starts where its own sum stands among the entries' sums and takes the entry of the smaller gap next,
        below or above; it is done when that gap's square over d strictly exceeds its best distance.
        """
        n, d = x.shape
        total, last = x.sum(axis=1), len(self.sums) - 1
        far = np.int64(1) << 31
        up = np.searchsorted(self.sums, total)
        down = up - 1
        best, index = np.full(n, far * far // d), np.full(n, last + 1)
        live, computed = np.arange(n), 0
        while len(live):
            lo, hi, own = down[live], up[live], total[live]
            below = np.where(lo >= 0, own - self.sums[np.maximum(lo, 0)], far)
            above = np.where(hi <= last, self.sums[np.minimum(hi, last)] - own, far)
            gap, lower = np.minimum(below, above), below <= above
            go = (gap < far) & (gap * gap <= best[live] * d)
            live, lower = live[go], lower[go]
            at = np.where(lower, down[live], up[live])
            distance = ((x[live] - self.entries[at]) ** 2).sum(axis=1)
            entry = self.order[at]
            better = (distance < best[live]) | ((distance == best[live]) & (entry < index[live]))
            best[live[better]], index[live[better]] = distance[better], entry[better]
            down[live] -= lower
            up[live] += ~lower
            computed += len(live)
        return index, best, computed


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: the component sums (position -1: the count) of the parts that each entry is nearest to."""
    parts, entries, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [EqualAverage(b) for b in books]
        total = np.zeros((parts, entries, d + 1), np.int64)
        for batch in batches:
            rows = _matrix(batch.column("v"), parts * d)
            for p in range(parts):
                x = rows[:, p * d:(p + 1) * d]
                index = search[p].nearest(x)[0]
                np.add.at(total[p], index, np.hstack([np.ones((len(x), 1), np.int64), x]))
        p, e, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in (p, e, i - 1, total[p, e, i])], names=["part", "entry", "at", "total"])

    return run


def learn_codebooks(vectors: DataFrame, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, component) of ``vectors(vec_id, v)``.

    A codebook starts as that part of the rows with the smallest ids (equal ids by vector, rows without an id last; as
    many entries as there are rows, if fewer).  A round is one Spark aggregate; parts x entries x components sums, the
    size of the codebooks, reach the driver.  All sums are whole numbers, so the result does not depend on the order.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        found = vectors.select("v").mapInArrow(_sums(books), "part long, entry long, at long, total long")
        total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for r in found.groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect():
            total[r["part"], r["entry"], r["at"] + 1] = r["total"]
        count = total[:, :, :1]
        books = np.where(count > 0, total[:, :, 1:] // np.maximum(count, 1), books)  # // rounds down
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of ``vectors(vec_id, label, v)``: one byte of the code for each part."""
    parts, _, d = books.shape

    @F.pandas_udf("code binary, error long")
    def assign(v: pd.Series) -> pd.DataFrame:
        rows = np.array(v.tolist(), np.int64).reshape(len(v), parts * d)
        found = [EqualAverage(b).nearest(rows[:, p * d:(p + 1) * d]) for p, b in enumerate(books)]
        codes = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
        return pd.DataFrame({"code": [c.tobytes() for c in codes], "error": sum(f[1] for f in found)})

    return vectors.withColumn("a", assign("v")).select("vec_id", "label", "a.code", "a.error")


def decode(codes: DataFrame, books: np.ndarray, code: str = "code", out: str = "v") -> DataFrame:
    """``codes`` with the integer vector that each code stands for."""

    @F.pandas_udf("array<long>")
    def vector(c: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else books[np.arange(len(x)), np.frombuffer(x, np.uint8)].ravel() for x in c])

    return codes.withColumn(out, vector(code))


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(table: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0,
                     key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``(codes, codebooks)`` of a table of vectors, see :func:`encode` and :func:`learn_codebooks`; at most 256 entries.

    Vectors that are null or hold null or non-finite components are dropped.  Shorter vectors count as filled up with
    zeros, an empty one as all zeros; lengths that ``parts`` does not divide are filled up too.  Rows without an id are
    coded, repeated rows once each.  An empty table gives no row and empty codebooks.  Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code byte holds 256 entries at most")
    vectors = integer_vectors(table, parts, scale, key, vector, label)
    books = learn_codebooks(vectors, parts, entries, rounds)
    if not books.size:
        return table.sparkSession.createDataFrame([], "vec_id long, label int, code binary, error long"), books
    return encode(vectors, books), books


def codes_digest(table: DataFrame, **options) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: codes as hex, errors summed over equal labels (nulls are
    one label).  The sums are combined map-side and joined back, so a label of many rows is no task of its own."""
    codes, books = compress_vectors(table, **options)
    codes = cut_lineage(codes)
    sums = cut_lineage(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"))
    joined = codes.join(hinted(sums, sums.count(), 32), F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
