"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, rename_clashes

# An overlap is a stretch of this many aligned words (or the whole item, if shorter) ...
WINDOW = 13
# ... of which at least this share agree.
SIMILARITY = 0.8
# An item of fewer words is no passage: it overlaps only a document of exactly these words.
PASSAGE_WORDS = 5
# A 1 compares the word at that place, a 0 ignores it. One of the two hits any 13 words with 2 replaced at most.
MASKS = ("11101011", "11001111")
# Benchmark text handled in one pass; a larger benchmark takes several passes over the documents.
BLOCK_BYTES = 8 << 20

_WORD = re.compile(r"\w+")
HITS = "array<struct<item_id:long,start:int,window:int,matched:int>>"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def masks_for(length: int) -> list[str]:
    """Masks that hit every window of an item of ``length`` words with the allowed number of words replaced."""
    if length >= WINDOW:
        return list(MASKS)
    wrong = int(length * (1 - SIMILARITY) + 1e-9)
    return ["1" * -(-(length - wrong) // (wrong + 1))]


class SeedIndex:
    """The seeds of a block of benchmark items; :meth:`hits` finds the overlaps of many texts at once."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, w) for i, t in items if (w := words_of(t))]
        self.ids = {w: n for n, w in enumerate(sorted({w for _, ws in self.items for w in ws}))}
        self.coded = [np.array([self.ids[w] for w in ws], np.int64) for _, ws in self.items]
        self.short: dict[tuple[str, ...], list[int]] = {}
        tables: dict[str, list[tuple[np.ndarray, int]]] = {}
        for n, code in enumerate(self.coded):
            if len(code) < PASSAGE_WORDS:
                self.short.setdefault(tuple(self.items[n][1]), []).append(n)
                continue
            for mask in masks_for(len(code)):
                tables.setdefault(mask, []).append((self._seeds(code, mask)[0], n))
        self.tables = {}
        for mask, parts in tables.items():
            keys = np.concatenate([p for p, _ in parts])
            owner = np.concatenate([np.full(len(p), n) for p, n in parts])
            at = np.concatenate([np.arange(len(p)) for p, _ in parts])
            order = np.argsort(keys, kind="stable")
            self.tables[mask] = keys[order], owner[order], at[order]

    @staticmethod
    def _seeds(code: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the words under the mask at each place, and the places where all of them are benchmark words."""
        n = len(code) - len(mask) + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        on = [i for i, c in enumerate(mask) if c == "1"]
        ok = np.ones(n, bool)
        for i in on:
            ok &= code[i:i + n] >= 0
        places = np.flatnonzero(ok)
        key = np.zeros(len(places), np.uint64)
        for i in on:
            key = (key ^ code[places + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key, places

    def best_overlap(self, code: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
        """``matched, window, start`` of the best window of the item laid on the text at ``shift``; None below the bound."""
        same = np.zeros(len(item), np.int64)
        lo, hi = max(0, -shift), min(len(item), len(code) - shift)
        if hi > lo:
            same[lo:hi] = code[shift + lo:shift + hi] == item[lo:hi]
        window = min(WINDOW, len(item))
        run = np.concatenate([[0], np.cumsum(same)])
        counts = run[window:] - run[:-window]
        at = int(counts.argmax())
        return (int(counts[at]), window, shift + at) if counts[at] >= SIMILARITY * window - 1e-9 else None

    def hits(self, texts: list[str | None], slice_chars: int = 2_000_000) -> list[list[dict]]:
        """Per text, the best overlap with each item it overlaps, by item.  Whole texts, some at a time, so that memory
        does not follow the number of rows in a batch."""
        out, part, chars = [], [], 0
        for text in texts:
            part.append(text)
            chars += len(text or "") + 1
            if chars >= slice_chars:
                out += self._hits(part)
                part, chars = [], 0
        return out + self._hits(part)

    def _hits(self, texts: list[str | None]) -> list[list[dict]]:
        split = [words_of(t) for t in texts]
        gap = max((len(m) for m in self.tables), default=1)
        sizes = [len(w) for w in split]
        starts = np.concatenate([[0], np.cumsum([n + gap for n in sizes])]).astype(np.int64)
        code = np.full(int(starts[-1]), -1, np.int64)
        for words, at in zip(split, starts):
            if words:
                code[at:at + len(words)] = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        seen: set[tuple[int, int, int]] = set()
        for mask, (keys, owner, place) in self.tables.items():
            key, at = self._seeds(code, mask)
            left, right = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            for i in np.flatnonzero(right > left):
                doc = int(np.searchsorted(starts, at[i], "right")) - 1
                for j in range(left[i], right[i]):
                    seen.add((doc, int(owner[j]), int(at[i] - starts[doc] - place[j])))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, n, shift in seen:
            own = code[starts[doc]:starts[doc] + sizes[doc]]
            if found := self.best_overlap(own, self.coded[n], shift):
                old = best.get((doc, n))
                if old is None or (found[0], -found[2]) > (old[0], -old[2]):
                    best[doc, n] = found
        for doc, words in enumerate(split):
            if len(words) < PASSAGE_WORDS:
                for n in self.short.get(tuple(words), ()):
                    best[doc, n] = len(words), len(words), 0
        out: list[list[dict]] = [[] for _ in texts]
        for (doc, n), (matched, window, start) in sorted(best.items()):
            out[doc].append({"item_id": self.items[n][0], "start": start, "window": window, "matched": matched})
        return out


def _hits_udf(items: list[tuple[int, str]]):
    index = SeedIndex(items)

    @F.pandas_udf(HITS)
    def hits(texts: pd.Series) -> pd.Series:
        return pd.Series(index.hits(list(texts)))

    return hits


def benchmark_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES):
    """The benchmark as lists of at most about ``block_bytes`` of text, each small enough to go to every task."""
    base = cut_lineage(rename_clashes(benchmark, [item, text]).toDF("item_id", "text").where("item_id is not null and text is not null"))
    total = base.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    blocks = max(1, -(-total // block_bytes))
    for n in range(blocks):
        rows = base.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == n) if blocks > 1 else base
        yield sorted((r["item_id"], r["text"]) for r in rows.collect())


def short_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, words`` of the items that are too short to be looked for inside a document."""
    @F.pandas_udf("int")
    def words(texts: pd.Series) -> pd.Series:
        return pd.Series([len(words_of(t)) for t in texts], dtype="int32")

    base = rename_clashes(benchmark, [item, text]).toDF("item_id", "text").where("item_id is not null")
    return base.select("item_id", words("text").alias("words")).where((F.col("words") > 0) & (F.col("words") < PASSAGE_WORDS))


def overlap_columns(benchmark: DataFrame, text: Column, block_bytes: int = BLOCK_BYTES) -> list[Column]:
    """For each block of the benchmark, a column with the overlaps of ``text``."""
    return [_hits_udf(items)(text) for items in benchmark_blocks(benchmark, block_bytes=block_bytes) if items]


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and benchmark item that it overlaps: ``doc_id, item_id, start, window, matched, similarity``.

    Fixed masks ignore chosen word places; seeds of the documents meet equal seeds of the items in a hash lookup (the
    items, at most ``block_bytes`` of them at a time, are at every task), which gives an item and how it lies on the
    text.  The words are then compared place by place, and the best stretch of 13 words (whole shorter items) counts as
    an overlap if 80 % agree: replaced words, cut passages and changed case or punctuation do not hide it.  An item of
    fewer than five words overlaps only documents of exactly its words; :func:`short_items` lists them.  Clean documents give no row.  Null and empty texts and items overlap nothing; items that repeat under different ids each
    count; repeated documents give repeated rows; an empty table on either side gives no row; other columns are not read.
    """
    base = rename_clashes(docs, [key, text]).toDF("doc_id", "text")
    found = None
    for column in overlap_columns(benchmark, F.col("text"), block_bytes):
        part = base.select("doc_id", F.explode(column).alias("o")).select("doc_id", "o.*")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = base.limit(0).select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (("item_id", "long"), ("start", "int"), ("window", "int"), ("matched", "int"))])
    return found.withColumn("similarity", F.col("matched") / F.col("window"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item; nothing is shuffled or joined."""
    clean = docs
    for column in overlap_columns(benchmark, F.col(f"`{text}`")):
        clean = clean.where(F.size(column) == 0)
    return clean
