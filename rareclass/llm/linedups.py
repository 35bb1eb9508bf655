"""Lines that many documents share: two Bloom filters find the suspects, an exact count settles them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, hinted, rename_clashes

# ASCII white space, and the letters that are made lower-case.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Hashes that a task sorts at a time, hashes that share one pair of filters, and the filters' bits per hash and probes.
CHUNK = 1 << 21
PER_BUCKET = 1 << 20
BITS, PROBES = 10, 5
# Repeated keys of this many bytes in all go out with the plan; more are joined.
INLINE_BYTES = 16 << 20


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order: A-Z lower-cased, ASCII white space stripped at both ends."""
    lines = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "\n", -1)
    return F.transform(lines, lambda line: F.btrim(line, F.lit(SPACE)))


def document_keys(documents: DataFrame, min_chars: int, *columns: str) -> DataFrame:
    """``columns, key, h``: the different keys of every document with at least ``min_chars`` code points."""
    keys = F.filter(F.array_distinct(line_keys(F.col("text"))), lambda k: F.length(k) >= min_chars)
    return documents.select(*columns, F.explode(keys).alias("key")).withColumn("h", F.xxhash64("key"))


def _sorted_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: its hashes in sorted chunks, those seen once and those seen more often apart."""

    def chunk(parts: list[np.ndarray]) -> pa.RecordBatch:
        h, seen = np.unique(np.concatenate(parts), return_counts=True)
        arrays = [pa.array([len(h)], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in (h[seen == 1], h[seen > 1]))]
        return pa.RecordBatch.from_arrays(arrays, names=["n", "once", "more"])

    held, size = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        size += len(held[-1])
        if size >= CHUNK:
            yield chunk(held)
            held, size = [], 0
    if size:
        yield chunk(held)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are equal stretches of the hash's upper half."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _deal(buckets: int):
    """The slices of every chunk by bucket (a chunk is sorted, so each is a stretch of it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for once, more in zip(batch.column("once").to_pylist(), batch.column("more").to_pylist()):
                sides = [np.frombuffer(x, np.uint64) for x in (once, more)]
                cuts = [np.searchsorted(_bucket(x, buckets), np.arange(buckets + 1)) for x in sides]
                used = [b for b in range(buckets) if any(c[b + 1] > c[b] for c in cuts)]
                found = [[x[c[b]:c[b + 1]].tobytes() for b in used] for x, c in zip(sides, cuts)]
                if used:
                    arrays = [pa.array(used, pa.int32()), *(pa.array(f, pa.binary()) for f in found)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "once", "more"])

    return run


class BloomFilter:
    """A Bloom filter over 64-bit hashes (a byte for each bit while it is in use)."""

    def __init__(self, expected: int):
        self.mask = np.uint64((1 << max(10, int(expected * BITS - 1).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)

    def _places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(17) | np.uint64(1)
        for i in range(PROBES):
            yield (h + np.uint64(i) * step) & self.mask

    def add(self, h: np.ndarray) -> None:
        for place in self._places(h):
            self.bits[place] = True

    def holds(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for place in self._places(h):
            found &= self.bits[place]
        return found


def _suspects(group: pa.Table) -> pa.Table:
    """Hashes of a bucket that the filter of twice-seen hashes holds.

    A chunk's hashes are all different: one that the filter of once-seen hashes holds already was (or seems to have
    been) in an earlier chunk, and enters the filter of twice-seen hashes.  Nothing seen twice is missed.
    """
    once = [np.frombuffer(x, np.uint64) for x in group.column("once").to_pylist()]
    more = [np.frombuffer(x, np.uint64) for x in group.column("more").to_pylist()]
    n = sum(map(len, once)) + sum(map(len, more))
    seen, again = BloomFilter(n), BloomFilter(n)
    for a, b in zip(once, more):
        h = np.concatenate([a, b])
        again.add(h[seen.holds(h)])
        again.add(b)
        seen.add(h)
    found = [h[again.holds(h)] for h in (*once, *more)]
    return pa.table({"h": pa.array(np.unique(np.concatenate(found)).view(np.int64), pa.int64())})


def suspected_hashes(keys: DataFrame, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``h``: the hashes of ``keys(h)`` that seem to occur more than once.

    Tasks sort and count their own hashes first, so a key that a third of all documents hold is one hash of a task.
    Eight bytes a key go on, to buckets of about ``per_bucket`` hashes; each bucket fills the two filters.
    """
    chunks = cut_lineage(keys.select("h").mapInArrow(_sorted_chunks, "n long, once binary, more binary"))
    total = chunks.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // per_bucket))
    dealt = chunks.select("once", "more").mapInArrow(_deal(buckets), "bucket int, once binary, more binary")
    return cut_lineage(dealt.groupBy("bucket").applyInArrow(_suspects, "h long"))


def repeated_keys(documents: DataFrame, min_docs: int = 10, min_chars: int = 1, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``key, docs, first_doc``: keys of at least ``min_chars`` code points in at least ``min_docs`` documents, how many
    hold them, and the smallest id among those.  ``documents`` has ``doc_id, text``.

    Only lines whose hash is suspected are counted, by their whole key; counts are combined map-side.
    """
    lines = document_keys(documents, min_chars, "doc_id")
    if min_docs > 1:
        suspects = suspected_hashes(lines, per_bucket)
        lines = lines.join(hinted(suspects, suspects.count(), 16), "h", "left_semi")
    found = lines.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"))
    return cut_lineage(found.where(F.col("docs") >= min_docs))


def _drop(text: str | None, repeated, first: bool) -> tuple[int, int, str]:
    """Lines, dropped lines and the rest of a text.  ``repeated`` maps a key to whether this document is its first."""
    lines = (text or "").split("\n")
    keys = (text or "").translate(_LOWERED).split("\n")
    kept, shown = [], set()
    for line, key in zip(lines, keys):
        key = key.strip(SPACE)
        own = repeated(key)
        if own is None or (first and own and key not in shown):
            kept.append(line)
        shown.add(key)
    return len(lines), len(lines) - len(kept), "\n".join(kept)


_LOWERED = str.maketrans(UPPER, LOWER)
_RESULT = "n_lines long, n_dropped long, kept string"


def drop_repeated_lines(documents: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none", key: str = "doc_id",
                        text: str = "text", inline_bytes: int = INLINE_BYTES, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` of every document: its text without the lines that ``min_docs`` documents share.

    ``keep="none"`` drops them everywhere; ``"first"`` leaves the first such line of the document with the smallest id.
    Repeated keys of at most ``inline_bytes`` in all go out with the plan; more are joined to the documents' own keys,
    and each document gets those it holds.  A null or empty text is one empty line (the empty key has no code point).
    Repeated rows are documents of their own and give equal results; rows without an id count and are processed, but
    are first only if no document with an id holds the key.  An empty table gives no row; other columns are not read.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is none or first")
    docs = rename_clashes(documents, [key, text]).toDF("doc_id", "text")
    repeated = repeated_keys(docs, min_docs, min_chars, per_bucket)
    first = keep == "first"
    size = repeated.agg(F.sum(F.octet_length("key") + 64).alias("b")).first()["b"] or 0
    if size <= inline_bytes:
        table = {r["key"]: r["first_doc"] for r in repeated.select("key", F.col("first_doc").cast("string")).collect()}

        @F.pandas_udf(_RESULT)
        def inline(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
            def of(i):
                return lambda k: table[k] == i if k in table else None

            return pd.DataFrame([_drop(t, of(i), first) for i, t in zip(ids, texts)], columns=["n_lines", "n_dropped", "kept"])

        return docs.withColumn("r", inline(F.col("doc_id").cast("string"), "text")).select("doc_id", "r.*")

    @F.pandas_udf(_RESULT)
    def joined(texts: pd.Series, keys: pd.Series, owns: pd.Series) -> pd.DataFrame:
        found = []
        for t, k, o in zip(texts, keys, owns):
            table = dict(zip(k, o)) if k is not None else {}
            found.append(_drop(t, table.get, first))
        return pd.DataFrame(found, columns=["n_lines", "n_dropped", "kept"])

    # documents that agree in id and text get the same keys, so the digest stands for the row
    marked = docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    lines = document_keys(marked.dropDuplicates(["doc_id", "digest"]), min_chars, "doc_id", "digest")
    own = lines.join(repeated.select("key", "first_doc"), "key").groupBy("doc_id", "digest").agg(
        F.collect_list(F.struct("key", F.col("first_doc").eqNullSafe(F.col("doc_id")).alias("own"))).alias("k"))
    own = own.select(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"), F.col("k.key").alias("keys"), F.col("k.own").alias("owns"))
    both = marked.join(own, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest")), "left")
    return both.withColumn("r", joined("text", "keys", "owns")).select("doc_id", "r.*")


def line_digest(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256``."""
    found = drop_repeated_lines(documents, **options)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
