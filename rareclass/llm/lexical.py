"""Exact ranked lexical search over bit-sliced Bloom signatures."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, hinted, rename_clashes

# A term is entered once for each of these counts that its occurrences reach.
LEVELS = (1, 2, 3, 5, 8, 16)
# Bits per entered term, and bits that it sets.
BITS, PROBES = 16, 4
# A block of documents of one size class: bits of its slices, and documents, at most.
BLOCK_BITS, BLOCK_DOCS = 1 << 24, 1024
# An item's floor is the k-th exact score among the SEEDS * k documents with its highest bounds.
SEEDS = 4
# Bytes of item texts that one search carries; more items take more searches.
ITEM_BYTES = 4 << 20

# Every byte that no term holds becomes a space; A-Z become a-z.  Bytes from 0x80 belong to terms.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SALT = np.array([xxhash.xxh64_intdigest(b"level %d" % n) for n in LEVELS], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text: runs of letters and digits and of everything beyond ASCII, A-Z lower-cased."""
    return (text or "").encode().translate(_BYTES).split()


def _hashes(found: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > 1 << 20:
        known.clear()
    out = []
    for t in found:
        h = known.get(t)
        if h is None:
            h = known[t] = xxhash.xxh64_intdigest(t)
        out.append(h)
    return np.array(out, np.uint64)


def _entries(hashes: np.ndarray, level: np.ndarray) -> np.ndarray:
    """A hash of (term, level)."""
    x = (hashes ^ _SALT[level]) * _ODD
    return x ^ (x >> np.uint64(29))


def _slices_of(entries: np.ndarray, width: int) -> np.ndarray:
    """The slices (entries x PROBES) that an entry sets in a signature of ``width`` slices, a power of two."""
    step = (entries >> np.uint64(32)) | np.uint64(1)
    return ((entries[:, None] + np.arange(PROBES, dtype=np.uint64)[None] * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


INDEX = "width int, ids array<long>, sizes array<long>, tops array<long>, digests array<binary>, slices binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of a task's documents, in blocks of one size class; slice s of a block is the bitmap of its documents
    that set bit s."""
    known: dict[bytes, int] = {}
    open_blocks: dict[int, list[tuple]] = {}

    def close(width: int) -> pa.RecordBatch:
        docs = open_blocks.pop(width)
        bits = np.zeros((width, -(-len(docs) // 8) * 8), bool)
        for i, (*_, entries) in enumerate(docs):
            bits[_slices_of(entries, width).ravel(), i] = True
        packed = np.packbits(bits, axis=1)
        columns = list(zip(*[d[:4] for d in docs]))
        arrays = [pa.array([width], pa.int32()), *(pa.array([list(c)], pa.list_(pa.int64())) for c in columns[:3]),
                  pa.array([list(columns[3])], pa.list_(pa.binary())), pa.array([packed.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["width", "ids", "sizes", "tops", "digests", "slices"])

    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = terms(text)
            if not found:
                continue
            counts = Counter(found)
            hashes, tf = _hashes(list(counts), known), np.fromiter(counts.values(), np.int64, len(counts))
            entries = np.concatenate([_entries(hashes[tf >= n], np.full(int((tf >= n).sum()), lvl)) for lvl, n in enumerate(LEVELS)])
            width = BITS << max(2, int(len(entries) - 1).bit_length())
            held = open_blocks.setdefault(width, [])
            held.append((i, len(found), int(tf.max()), hashlib.md5(text.encode()).digest(), entries))
            if len(held) >= max(8, min(BLOCK_DOCS, BLOCK_BITS // width)):
                yield close(width)
    for width in list(open_blocks):
        yield close(width)


def build_index(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The signatures of all documents with at least one term, a row for each block; written once, no shuffle.

    With a block's slices stand its documents' ids, numbers of terms, largest term counts and text digests."""
    docs = rename_clashes(documents, [key, text]).toDF("doc_id", "text")
    return cut_lineage(docs.mapInArrow(_blocks, INDEX))


@dataclass
class Question:
    """The items of one search: their terms' numbers, weights and hashes, and the corpus counts."""

    vocabulary: list[bytes]
    weights: np.ndarray  # of each term
    items: list[np.ndarray]  # term numbers of each item
    documents: int
    occurrences: int

    def penalty(self, n: np.ndarray) -> np.ndarray:
        return 50 + 50 * n * self.documents // self.occurrences


def _share(tf, m):
    """A term's part of a score before its weight: grows with ``tf``, stays below 1,000,000."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def upper_bounds(block: dict, question: Question, hashes: np.ndarray) -> np.ndarray:
    """Items x documents of a block: scores that the exact ones cannot exceed.

    The AND of an entry's slices is a bitmap that holds every document with the entry, and some others.  A weighted sum
    of a level's bitmaps, times what the level can add to a term's share (up to the next level's count, or to the
    document's largest), summed over levels, bounds the score.
    """
    width, n = block["width"], len(block["ids"])
    packed = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
    present = []
    for lvl in range(len(LEVELS)):
        at = _slices_of(_entries(hashes, np.full(len(hashes), lvl)), width)
        bitmap = packed[at[:, 0]]
        for probe in range(1, PROBES):
            bitmap = bitmap & packed[at[:, probe]]
        present.append(bitmap if not present else bitmap & present[-1])  # a level holds the ones below too
    bits = np.unpackbits(np.stack(present, axis=1), axis=2)[:, :, :n]  # terms x levels x documents
    m, top = question.penalty(np.array(block["sizes"], np.int64)), np.array(block["tops"], np.int64)
    most = [_share(np.minimum(top, after - 1), m) for after in (*LEVELS[1:], 1 << 40)]
    added = np.diff(np.stack([np.zeros(n, np.int64), *most]), axis=0)
    bounds = np.zeros((len(question.items), n), np.int64)
    some = bits[:, 0].any(axis=1)
    for q, numbers in enumerate(question.items):
        numbers = numbers[some[numbers]]
        if len(numbers):
            weights = question.weights[numbers]
            exact = np.float32 if weights.sum() < 1 << 24 else np.float64  # whole numbers up to 2^24 and 2^53
            sums = weights.astype(exact) @ bits[numbers].reshape(len(numbers), -1).astype(exact)
            bounds[q] = (sums.astype(np.int64).reshape(len(LEVELS), n) * added).sum(axis=0)
    return bounds


FOUND = "q int, doc_id long, digest binary, bound long"


def _found(q: np.ndarray, at: np.ndarray, block: dict, bound: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(q, pa.int32()), pa.array([block["ids"][i] for i in at], pa.int64()),
              pa.array([block["digests"][i] for i in at], pa.binary()), pa.array(bound, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["q", "doc_id", "digest", "bound"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _highest(question: Question, k: int):
    """Per task: for each item the documents of the k highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(question.vocabulary, {})
        best = [[] for _ in question.items]
        floor = np.ones(len(question.items), np.int64)
        for block in _read(batches):
            bounds = upper_bounds(block, question, hashes)
            for q in np.flatnonzero((bounds >= floor[:, None]).any(axis=1)):
                at = np.flatnonzero(bounds[q] >= floor[q])
                held = best[q] + [(-int(bounds[q, i]), block["ids"][i] is None, block["ids"][i] or 0, block["digests"][i]) for i in at]
                best[q] = sorted(held)[:k]
                if len(best[q]) == k:
                    floor[q] = -best[q][-1][0]
        for q, held in enumerate(best):
            if held:
                block = {"ids": [None if none else i for _, none, i, _ in held], "digests": [d for *_, d in held]}
                yield _found(np.full(len(held), q), np.arange(len(held)), block, np.array([-b for b, *_ in held]))

    return run


def _not_excluded(question: Question, floor: np.ndarray):
    """Every (item, document) whose bound reaches the item's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(question.vocabulary, {})
        for block in _read(batches):
            bounds = upper_bounds(block, question, hashes)
            q, at = np.nonzero(bounds >= floor[:, None])
            if len(q):
                yield _found(q, at, block, bounds[q, at])

    return run


def _scorer(question: Question):
    """The exact scores of a document for the items ``qs``."""
    weight = dict(zip(question.vocabulary, question.weights.tolist()))
    items = [[question.vocabulary[t] for t in numbers] for numbers in question.items]

    @F.pandas_udf("array<struct<q int, score long>>")
    def score(texts: pd.Series, asked: pd.Series) -> pd.Series:
        out = []
        for text, qs in zip(texts, asked):
            found = terms(text)
            counts, m = Counter(found), int(question.penalty(np.int64(len(found))))
            part = {t: weight[t] * _share(n, m) for t, n in counts.items() if t in weight}
            out.append([{"q": int(q), "score": sum(part[t] for t in items[q] if t in part)} for q in qs])
        return pd.Series(out)

    return score


def exact_scores(documents: DataFrame, pairs: DataFrame, question: Question) -> DataFrame:
    """``q, doc_id, score`` of ``pairs(q, doc_id)``: each document's text is read once, with all items that ask for it."""
    asked = cut_lineage(pairs.groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("q").alias("qs")))
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("qs")).alias("q")).first()
    small = hinted(asked, 1, 32 * int(size["n"]) + 4 * int(size["q"] or 0))
    both = documents.join(small, F.col("doc_id").eqNullSafe(F.col("of")))
    return both.select("doc_id", F.explode(_scorer(question)("text", "qs")).alias("s")).select("s.q", "doc_id", "s.score")


def _ask(documents: DataFrame, items: list, facts, count_terms) -> tuple[Question, list]:
    """The question of a block of items, after counting its terms' documents; items without a term are left out."""
    sets = [(i, sorted(set(terms(t)))) for i, t in items]
    asked = [(i, s) for i, s in sets if s]
    vocabulary = sorted({t for _, s in asked for t in s})
    number = {t: n for n, t in enumerate(vocabulary)}
    df = count_terms(documents, vocabulary)
    weights = np.array([math.floor(1000 * math.log((2 * facts["docs"] + 2) / (2 * df.get(t, 0) + 1))) for t in vocabulary], np.int64)
    question = Question(vocabulary, weights, [np.array([number[t] for t in s], np.int64) for _, s in asked], facts["docs"], facts["terms"])
    return question, [i for i, _ in asked]


def document_frequencies(documents: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """How many documents hold each term of a bounded vocabulary; counted per task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, found = frozenset(vocabulary), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(wanted.intersection(terms(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["term", "df"])

    counted = documents.select("text").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in counted.collect()}


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return scores.where("score > 0").withColumn("rank", place).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, k: int = 50, index: DataFrame | None = None, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's k highest-scoring documents with a score above 0, exact.

    The documents of an item's highest upper bounds (``SEEDS * k``) are scored first; the k-th of those scores is its
    floor.  Every document whose bound reaches the floor is then scored from its text, the others are provably excluded.
    Of documents with equal text only the k smallest ids can rank, so no more are scored.  Equal scores stand by ascending ``doc_id``, rows
    without an id last.  Repeated documents are documents of their own.  Items go out in blocks of ``item_bytes``, each
    of which ends in a checkpoint; equal item rows are one item.  Null or empty texts hold no term; an item without a
    term, an empty table or no item give no row.  Other columns are not read.
    """
    spark = documents.sparkSession
    docs = rename_clashes(documents, [key, text]).toDF("doc_id", "text")
    asked = rename_clashes(items, [item_key, item_text]).toDF("item_id", "text").distinct()
    index = build_index(documents, key, text) if index is None else index
    total = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    facts = index.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("docs"), F.coalesce(F.sum(total), F.lit(0)).alias("terms")).first()
    kind = asked.schema["item_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    size = asked.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    for at in range(blocks := max(1, -(-size // item_bytes)) if facts["docs"] else 0):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == at).collect()
        question, names = _ask(docs, [(r["item_id"], r["text"]) for r in rows], facts, document_frequencies)
        if not names:
            continue
        best = Window.partitionBy("q").orderBy(F.col("bound").desc(), "doc_id")
        highest = index.mapInArrow(_highest(question, SEEDS * k), FOUND)
        seeds = highest.withColumn("place", F.row_number().over(best)).where(F.col("place") <= SEEDS * k)
        first = _ranked(exact_scores(docs, seeds.select("q", "doc_id").distinct(), question), k)
        floor = np.ones(len(names), np.int64)
        for r in first.where(F.col("rank") == k).select("q", "score").collect():  # a number for each item
            floor[r["q"]] = r["score"]
        same = Window.partitionBy("q", "digest").orderBy(F.col("doc_id").asc_nulls_last())
        left = index.mapInArrow(_not_excluded(question, floor), FOUND).withColumn("place", F.row_number().over(same)).where(F.col("place") <= k)
        ranked = _ranked(exact_scores(docs, left.select("q", "doc_id").distinct(), question), k)
        named = spark.createDataFrame([(q, i) for q, i in enumerate(names)], f"q int, item_id {kind}")
        result = result.unionByName(cut_lineage(ranked.join(F.broadcast(named), "q").select("item_id", F.col("rank").cast("int"), "doc_id", "score")))
    return result
