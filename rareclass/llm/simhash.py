"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from itertools import accumulate
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import connected_components, cut_lineage, rename_clashes, shuffle_partitions

# Distinct fingerprints that one task compares within one bucket; fuller buckets are divided by further masks.
BUCKET_LIMIT = 16_384


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """64-bit SimHash: A-Z lower-cased, words split at ASCII white space, word shingles with repeats, XXH64 (seed 42);
    a bit is set if over half of the hashes have it.  Fewer words make one shingle; no word gives 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = len(words) - words_per_shingle + 1
    line = b" ".join(words)
    if n <= 1:
        return xxh64_intdigest(line, 42)
    lengths = [len(w) + 1 for w in words]
    starts = list(accumulate(lengths, initial=0))
    ends = starts[words_per_shingle:]
    hashes = np.fromiter((xxh64_intdigest(line[a:b - 1], 42) for a, b in zip(starts, ends)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 18):
        part = hashes[i:i + (1 << 18)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def covering_masks(radius: int, free: int = (1 << 64) - 1, seed: int = 7) -> list[int]:
    """Masks such that any two words that differ in at most ``radius`` of the ``free`` bits agree under one of them.

    Each free bit gets a non-zero vector of ``radius + 1`` bits; the mask of a non-zero vector v keeps the bits whose
    vector has odd overlap with v.  Any ``radius`` vectors span less than the whole space, so some v is orthogonal to
    all of them, and its mask leaves out every differing bit.  Unit vectors come first, so no mask is empty while there
    are more free bits than the radius.
    """
    bits = [i for i in range(64) if free >> i & 1]
    rng = np.random.default_rng(seed)
    top = (1 << radius + 1) - 1
    units = [1 << i for i in range(radius + 1)]
    vectors = units + [int(v) for v in rng.permutation(np.arange(1, top + 1)) if int(v) not in units]
    vector = {bits[int(j)]: vectors[n % top] for n, j in enumerate(rng.permutation(len(bits)))}
    return [sum(1 << i for i in bits if (vector[i] & v).bit_count() & 1) for v in range(1, top + 1)]


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph that links words within ``radius`` bits: fewer links than words, none lost."""
    links, rest = [], prints
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            word = queue.pop()
            near = np.bitwise_count(rest ^ word) <= radius
            if near.any():
                found = rest[near]
                links += [(int(word), int(x)) for x in found]
                queue += list(found)
                rest = rest[~near]
    return links


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_links(radius: int):
    """mapInPandas over rows sorted by (mask, key): links within each bucket; a bucket may span batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        held_key: tuple | None = None

        def emit(groups: list[np.ndarray]) -> pd.DataFrame:
            links = set()
            for g in groups:
                if len(g) == 2:
                    if (int(g[0]) ^ int(g[1])).bit_count() <= radius:
                        links.add((int(g[0]), int(g[1])))
                else:
                    links.update(spanning_links(g, radius))
            return pd.DataFrame({"a": [_signed(a) for a, _ in links], "b": [_signed(b) for _, b in links]}, dtype="int64")

        for batch in batches:
            if batch.empty:
                continue
            mask, key, fp = (batch[c].to_numpy() for c in ("mask", "key", "fp"))
            fp = fp.astype(np.int64).view(np.uint64)
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            edges = np.concatenate([[0], cut, [len(fp)]])
            ready: list[np.ndarray] = []
            first = (mask[0], key[0])
            if held_key is not None and held_key != first:
                if (n := sum(map(len, held))) > 1:
                    ready.append(np.concatenate(held) if n else held[0])
                held = []
            sizes = np.diff(edges)
            if len(sizes) == 1:
                held.append(fp)
                held_key = first
            else:
                head = [*held, fp[:edges[1]]]
                if sum(map(len, head)) > 1:
                    ready.append(np.concatenate(head))
                for i in np.flatnonzero(sizes[1:-1] > 1) + 1:
                    ready.append(fp[edges[i]:edges[i + 1]])
                held, held_key = [fp[edges[-2]:]], (mask[-1], key[-1])
            if ready:
                yield emit(ready)
        if held and sum(map(len, held)) > 1:
            yield emit([np.concatenate(held)])

    return run


def near_links(prints: DataFrame, radius: int = 4, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``prints(fp)`` distinct -> ``a, b``: links that connect exactly the fingerprints within ``radius`` bits.

    Every fingerprint goes to one bucket per covering mask.  Buckets are counted first (combined map-side).  Those within
    the limit are sorted together and compared; a fuller one is divided by covering masks over the bits its mask leaves
    free - pairs of the bucket differ only there, so again none is lost - until all fit or fewer than 14 bits are free.
    """
    n = shuffle_partitions(prints.sparkSession)
    masks = [(_signed(m), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for m in covering_masks(radius)]
    rows = prints.select("fp", F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), k.alias("key")) for m, k in masks])).alias("t")).select("fp", "t.mask", "t.key")
    found = None
    for level in range(1, 64):
        full = cut_lineage(rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_limit).select("mask", "key"))
        n_full = full.count()
        open_masks = [r["mask"] for r in full.select("mask").distinct().collect()] if n_full else []  # masks, not documents
        done = [m for m in open_masks if 64 - (m & (1 << 64) - 1).bit_count() < 14]
        fits = rows if not n_full else rows.join(full.where(~F.col("mask").isin(done)), ["mask", "key"], "left_anti")
        here = fits.repartition(n, "mask", "key").sortWithinPartitions("mask", "key").mapInPandas(_bucket_links(radius), "a long, b long")
        found = here if found is None else found.unionByName(here)
        if len(done) == len(open_masks):
            return found.distinct()
        hot = cut_lineage(rows.join(full.where(~F.col("mask").isin(done)), ["mask", "key"], "left_semi"))
        parts = []
        for m in (m for m in open_masks if m not in done):
            kept = m & (1 << 64) - 1
            finer = [kept | c for c in covering_masks(radius, ~kept & (1 << 64) - 1, seed=7 + level)]
            parts.append((m, F.array(*[F.lit(_signed(x)) for x in finer])))
        choice = F.when(F.lit(False), F.array().cast("array<long>"))
        for m, finer in parts:
            choice = choice.when(F.col("mask") == m, finer)
        # several masks may lead to one finer bucket: its rows come once
        rows = hot.select("fp", F.explode(choice).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
    raise RuntimeError("buckets could not be divided")


def simhash_groups(docs: DataFrame, words_per_shingle: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text",
                   bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``doc_id, fp, component_id`` for every document; fingerprints link at ``radius`` or fewer differing bits.

    Copies collapse to one fingerprint before anything is compared; components are found over distinct fingerprints.
    ``component_id`` is the smallest id reachable.  Null or blank texts have fingerprint 0, linked like any other;
    repeated rows come back as often as they stand; an empty table gives no row; other columns are not read.
    """
    base = rename_clashes(docs, [key, text]).toDF("doc_id", "text")
    prints = cut_lineage(base.select("doc_id", _print_of(words_per_shingle)("text").alias("fp")))
    label = _labels(prints, radius, bucket_limit)
    return prints.join(label, prints["fp"] == label["label_fp"]).select("doc_id", "fp", "component_id")


def _print_of(words_per_shingle: int):
    @F.pandas_udf("long")
    def print_of(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, words_per_shingle)) for t in texts], dtype="int64")

    return print_of


def _labels(prints: DataFrame, radius: int, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``label_fp, root, component_id`` of each fingerprint; ``root`` tells components of one smallest id apart."""
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    parts = connected_components(near_links(distinct.select("fp"), radius, bucket_limit))
    linked = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        distinct["fp"], "first_id", F.coalesce("root", distinct["fp"]).alias("root"))
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return linked.join(least, "root").select(F.col("fp").alias("label_fp"), "root", "component_id")


def simhash_digest(docs: DataFrame, words_per_shingle: int = 4, radius: int = 4) -> DataFrame:
    """The contract's columns."""
    out = simhash_groups(docs, words_per_shingle, radius)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words_per_shingle: int = 4, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: one with the smallest id (rows without an id stay).

    Under a repeated id the row is chosen by its text (smallest fingerprint and hash), so texts of other groups stay.
    """
    id_, text_hash = F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))
    base = docs.select(id_.alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = cut_lineage(base.select("doc_id", _print_of(words_per_shingle)("text").alias("fp"), F.xxhash64("text").alias("text_hash")))
    label = _labels(prints, radius)
    first = cut_lineage(prints.join(label, prints["fp"] == label["label_fp"]).where("doc_id = component_id").select("root", "doc_id", "fp", "text_hash"))
    keep = first.groupBy("root").agg(F.min(F.struct("doc_id", "fp", "text_hash")).alias("r")).select(
        F.col("r.doc_id").alias("__keep_id"), F.col("r.text_hash").alias("__keep_hash"))
    out = docs.join(keep, (id_ == F.col("__keep_id")) & (text_hash == F.col("__keep_hash")), "left_semi")
    if first.groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():
        out = out.withColumn("__text_hash", text_hash).dropDuplicates([key, "__text_hash"]).drop("__text_hash")
    return out.unionByName(docs.where(id_.isNull())).select(*[F.col(f"`{c}`") for c in docs.columns])
