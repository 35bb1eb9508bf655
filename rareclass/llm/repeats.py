"""Exact removal of repeated byte strings: a common-prefix interval tree over an enhanced suffix array, distributed."""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, rename_clashes, shuffle_partitions

# Shortest repeat, in bytes.
LENGTH = 50
# Bytes of an anchor; each stretch of LENGTH bytes has the anchor with the smallest hash among the LENGTH - ANCHOR + 1 in it.
ANCHOR = 24
# Text bytes of a pack (a longer text is a pack of its own) and of the slices in which a pack is scanned.
PACK_BYTES = 6 << 20
SLICE_BYTES = 1 << 20
# Text bytes per bucket of anchors.
BUCKET_TEXT = 16 << 20
# Compression of packs and blobs (zstandard).
LEVEL = 3
# An anchor with at least this many different surroundings is dealt out by single stretches instead.
HOT_PIECES = 4096

_NO_ID = np.iinfo(np.int64).max
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_AT_BITS = np.uint64(24)


# ------------------------------------------------------------ enhanced suffix array --


def suffix_array(strings: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted suffixes of at least ``least`` bytes of all strings: ``string, offset, length`` and the common prefix with
    the suffix before (strings end in marks that equal nothing)."""
    sizes = np.array([len(s) for s in strings], np.int64)
    per = np.maximum(sizes - least + 1, 0)
    owner = np.repeat(np.arange(len(strings)), per)
    offset = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    length = sizes[owner] - offset
    if not len(owner):
        return owner, offset, length, np.zeros(0, np.int64)
    width = int(length.max())
    flat = np.frombuffer(b"".join(strings) + bytes(width), np.uint8)
    at = (np.cumsum(sizes) - sizes)[owner] + offset
    rows = flat[at[:, None] + np.arange(width)]
    rows[np.arange(width) >= length[:, None]] = 0
    order = np.lexsort((length, rows.view(f"S{width}").ravel()))
    owner, offset, length, rows = owner[order], offset[order], length[order], rows[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(length[1:], length[:-1]))
    return owner, offset, length, np.concatenate([[0], common])


def interval_groups(common: np.ndarray, left: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Maximal repeats as ``(length, first, last)`` of the suffix array: the intervals of the common-prefix tree, found by
    one scan with a stack, whose members are preceded by different bytes (``left``; -1, a string's start, differs from
    all).  An interval that is preceded by one byte only lies inside a longer repeat and is passed over."""
    stack: list[list[int]] = []  # common length, first member, byte before all members (or -2: different ones)
    n = len(common)
    merge = lambda a, b: a if a == b and a != -1 else -2
    for i in range(1, n + 1):
        value = int(common[i]) if i < n else 0
        first, before = i - 1, int(left[i - 1])
        while stack and stack[-1][0] > value:
            size, first, own = stack.pop()
            own = merge(own, before)
            if own == -2:
                yield size, first, i - 1
            before = own
        if value < least:
            continue
        if stack and stack[-1][0] == value:
            stack[-1][2] = merge(stack[-1][2], before)
        else:
            stack.append([value, first, before])


def maximal_repeats(strings: list[bytes], least: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Every maximal repeat of at least ``least`` bytes with all its occurrences: ``(length, [(string, offset), ...])``."""
    owner, offset, _, common = suffix_array(strings, least)
    left = np.array([strings[s][o - 1] if o else -1 for s, o in zip(owner, offset)], np.int64)
    for size, first, last in interval_groups(common, left, least):
        yield size, list(zip(owner[first:last + 1].tolist(), offset[first:last + 1].tolist()))


# -------------------------------------------------------------------- packs of text --


class Pack:
    """Some documents, end to end, cut into pieces: runs of stretches (of LENGTH bytes) that share their anchor."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, data: bytes):
        self.ids, self.sizes = ids, sizes
        self.ends = np.cumsum(sizes)
        self.data = np.frombuffer(data, np.uint8)
        self._cut()

    @staticmethod
    def pack(ids: list[int], texts: list[bytes]) -> dict:
        body = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(texts))
        return {"pack": random.getrandbits(62), "ids": np.array(ids, np.int64).tobytes(),
                "sizes": np.array([len(t) for t in texts], np.int64).tobytes(), "n_bytes": sum(map(len, texts)), "body": body}

    @classmethod
    def unpack(cls, row) -> Pack:
        data = zstandard.ZstdDecompressor().decompress(bytes(row["body"]), max_output_size=int(row["n_bytes"]) + 1)
        return cls(np.frombuffer(bytes(row["ids"]), np.int64), np.frombuffer(bytes(row["sizes"]), np.int64), data)

    def _cut(self) -> None:
        n = len(self.data)
        inside = np.ones(max(0, n), bool)
        for end, size in zip(self.ends, self.sizes):
            inside[end - min(int(size), LENGTH - 1):end] = False
        parts = [self._cut_slice(s, inside) for s in range(0, max(0, n - LENGTH + 1), SLICE_BYTES)]
        empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        self.start, self.stop, self.anchor, self.print = (np.concatenate(x) for x in zip(*parts, empty))
        self.doc = np.searchsorted(self.ends, self.start, "right")
        self.id = self.ids[self.doc] if len(self.ids) else np.zeros(0, np.int64)

    def _cut_slice(self, at: int, inside: np.ndarray):
        """Pieces that begin in a slice: first and last stretch, anchor's hash, fingerprint of the piece's bytes."""
        t = self.data[at:at + SLICE_BYTES + LENGTH - 1].astype(np.uint64)
        with np.errstate(over="ignore"):
            h, power = {1: t + np.uint64(1)}, {1: _BASE}
            for k in (1, 2, 4, 8, 16):  # hashes of doubled length from two halves
                h[2 * k] = h[k][:-k] * power[k] + h[k][k:]
                power[2 * k] = power[k] * power[k]
            n = len(t) - LENGTH + 1
            gram = h[16][:len(t) - ANCHOR + 1] * power[8] + h[8][16:16 + len(t) - ANCHOR + 1]
            gram ^= gram >> np.uint64(31)
            gram *= np.uint64(0xBF58476D1CE4E5B9)
            gram ^= gram >> np.uint64(29)
            whole = (h[32][:n] * power[16] + h[16][32:32 + n]) * power[2] + h[2][48:48 + n]
        low = (gram >> _AT_BITS << _AT_BITS) | np.arange(len(gram), dtype=np.uint64)
        span, reach = LENGTH - ANCHOR + 1, 1
        while reach * 2 <= span:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        low = np.minimum(low[:n], low[span - reach:span - reach + n])
        place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        ok = inside[at:at + n]
        new = np.empty(n, bool)
        new[0] = True
        np.not_equal(place[1:], place[:-1], out=new[1:])
        new[1:] |= ok[1:] != ok[:-1]
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [n]]) - 1
        keep = ok[first]
        first, last = first[keep], last[keep]
        with np.errstate(over="ignore"):
            mark = (whole[first] ^ (whole[first] >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            mark = (mark ^ whole[last] ^ (last - first).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            mark ^= mark >> np.uint64(32)
        return first + at, last + at, gram[place[first]], mark

    def split(self, pieces: np.ndarray) -> None:
        """Replaces the given pieces by their single stretches, with fingerprints of their own."""
        if not len(pieces):
            return
        count = self.stop[pieces] - self.start[pieces] + 1
        single = np.repeat(self.start[pieces], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        rows = self.data[single[:, None] + np.arange(LENGTH)]
        with np.errstate(over="ignore"):
            mark = np.zeros(len(single), np.uint64)
            for j in range(LENGTH):
                mark = (mark ^ rows[:, j]) * _BASE
                mark ^= mark >> np.uint64(29)
        keep = np.ones(len(self.start), bool)
        keep[pieces] = False
        self.start = np.concatenate([self.start[keep], single])
        self.stop = np.concatenate([self.stop[keep], single])
        # a stretch's bucket follows from its own bytes, so the surroundings of a hot anchor spread over all buckets
        self.anchor = np.concatenate([self.anchor[keep], mark])
        self.print = np.concatenate([self.print[keep], mark])
        self.doc = np.concatenate([self.doc[keep], np.repeat(self.doc[pieces], count)])
        self.id = self.ids[self.doc]

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces in order of fingerprint, id and place; the first of each fingerprint; the group of every ordered piece."""
        order = np.lexsort((self.start, self.id, self.print))
        p = self.print[order]
        new = np.ones(len(p), bool)
        new[1:] = p[1:] != p[:-1]
        return order, order[new], np.cumsum(new) - 1

    def removed(self, shown: dict[int, int]) -> np.ndarray:
        """Bytes to remove.  A piece goes where a smaller id of the pack has an equal one; the smallest id loses the
        stretches that the buckets found elsewhere with a smaller id (``shown``: place of the piece -> bits)."""
        order, first, group = self.distinct()
        edge = np.zeros(len(self.data) + 1, np.int32)
        later = self.id[order] > self.id[first][group]
        gone = order[later]
        np.add.at(edge, self.start[gone], 1)
        np.add.at(edge, self.stop[gone] + LENGTH, -1)
        if shown:
            places = np.fromiter(shown, np.int64, len(shown))
            bits = np.array([shown[int(p)] for p in places], np.uint64)
            by = np.argsort(places)
            places, bits = places[by], bits[by]
            at = np.clip(np.searchsorted(places, self.start[first]), 0, len(places) - 1)
            found = np.where(places[at] == self.start[first], bits[at], np.uint64(0))
            own = order[~later]
            own_bits = found[group[~later]]
            for j in range(LENGTH - ANCHOR + 1):
                hit = own[(own_bits >> np.uint64(j) & np.uint64(1)).astype(bool)]
                np.add.at(edge, self.start[hit] + j, 1)
                np.add.at(edge, self.start[hit] + j + LENGTH, -1)
        return np.cumsum(edge[:-1], out=edge[:-1]) > 0


def _blob(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(a.tobytes() for a in arrays))


def _unblob(data: bytes, n: int, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(bytes(data), max_output_size=max(1, n * 200))
    out, at = [], 0
    for t in types:
        size = np.dtype(t).itemsize * n
        out.append(np.frombuffer(raw, t, n, at))
        at += size
    return [*out, raw[at:]]


def to_packs(pack_bytes: int):
    """Documents -> packs of about ``pack_bytes``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, size = [], [], 0
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids.append(_NO_ID if pd.isna(doc) else int(doc))
                texts.append((text or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1]) + 16
                if size >= pack_bytes:
                    rows.append(Pack.pack(ids, texts))
                    ids, texts, size = [], [], 0
            if rows:
                yield pd.DataFrame(rows)
        if ids:
            yield pd.DataFrame([Pack.pack(ids, texts)])

    return run


PACKS = "pack long, ids binary, sizes binary, n_bytes long, body binary"


def _buckets(anchor: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return ((anchor >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64), (anchor & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of a sorted bucket column."""
    if len(bucket):
        cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
        for a, b in zip(cut, cut[1:]):
            yield int(bucket[a]), slice(int(a), int(b))


def anchor_rows(n_buckets: int):
    """Packs -> per bucket, the pack's distinct anchors with their number of different pieces and whether two ids hold them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                pack = Pack.unpack(row)
                order, first, _ = pack.distinct()
                by = np.lexsort((pack.id, pack.anchor))
                a = pack.anchor[by]
                if not len(a):
                    continue
                cut = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1])
                ids = pack.id[by]
                last = np.concatenate([cut[1:], [len(a)]]) - 1
                shared = ids[cut] != ids[last]
                keys = a[cut]
                pieces = np.bincount(np.searchsorted(keys, pack.anchor[first]), minlength=len(keys))
                note = (np.minimum(pieces, 127).astype(np.uint8) << 1) | shared.astype(np.uint8)
                bucket, low = _buckets(keys, n_buckets)
                by = np.lexsort((low, bucket))
                bucket, low, note = bucket[by], low[by], note[by]
                out = [{"bucket": b, "pack": row["pack"], "n": s.stop - s.start, "data": _blob(low[s], note[s])} for b, s in _by_bucket(bucket)]
                yield pd.DataFrame(out)

    return run


BUCKET_ROWS = "bucket long, pack long, n int, data binary"


def live_anchors(hot_pieces: int):
    """A bucket's anchors -> for each pack those that two ids hold, the hot ones apart."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [_unblob(d, n, np.uint32, np.uint8) for d, n in zip(group["data"], group["n"])]
        low = np.concatenate([p[0] for p in parts])
        note = np.concatenate([p[1] for p in parts])
        row = np.repeat(np.arange(len(group)), group["n"].to_numpy())
        by = np.argsort(low, kind="stable")
        low, note, row = low[by], note[by], row[by]
        cut = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
        size = np.diff(np.concatenate([cut, [len(low)]]))
        live = (size > 1) | (np.maximum.reduceat(note & 1, cut) > 0)
        hot = live & (np.add.reduceat((note >> 1).astype(np.int64), cut) >= hot_pieces)
        kind = np.repeat(live.astype(np.uint8) + hot.astype(np.uint8), size)
        keep = kind > 0
        low, kind, row = low[keep], kind[keep], row[keep]
        by = np.lexsort((low, row))
        low, kind, row = low[by], kind[by], row[by]
        out = [{"bucket": int(group["bucket"].iloc[0]), "pack": int(group["pack"].iloc[r]), "n": s.stop - s.start, "data": _blob(low[s], kind[s])}
               for r, s in _by_bucket(row)]
        return pd.DataFrame(out, columns=["bucket", "pack", "n", "data"])

    return run


def _known(replies: pd.DataFrame, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Live and hot anchors of a pack as ``bucket * 2^32 + low`` keys, sorted."""
    keys, kinds = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for b, n, d in zip(replies["bucket"], replies["n"], replies["data"]):
        low, kind, _ = _unblob(d, n, np.uint32, np.uint8)
        keys.append(np.uint64(b) << np.uint64(32) | low.astype(np.uint64))
        kinds.append(kind)
    key, kind = np.concatenate(keys), np.concatenate(kinds)
    by = np.argsort(key)
    return key[by], kind[by]


def _kinds(pack: Pack, key: np.ndarray, kind: np.ndarray, n_buckets: int) -> np.ndarray:
    """0, 1 (live) or 2 (hot) for every piece of the pack."""
    if not len(key):
        return np.zeros(len(pack.anchor), np.uint8)
    bucket, low = _buckets(pack.anchor, n_buckets)
    own = bucket.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)
    at = np.clip(np.searchsorted(key, own), 0, len(key) - 1)
    return np.where(key[at] == own, kind[at], 0)


def piece_rows(n_buckets: int):
    """A pack and its live anchors -> per bucket, the pack's different live pieces with their bytes and smallest id."""

    def run(packs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(packs) and len(replies):
            pack = Pack.unpack(packs.iloc[0])
            kind = _kinds(pack, *_known(replies, n_buckets), n_buckets)
            live = kind > 0
            hot = np.flatnonzero(kind == 2)
            pack.split(hot)
            live = np.concatenate([live[kind != 2], np.ones(len(pack.start) - int((kind != 2).sum()), bool)])
            _, first, _ = pack.distinct()
            first = first[live[first]]
            bucket, low = _buckets(pack.anchor[first], n_buckets)
            by = np.lexsort((low, bucket))
            first, bucket, low = first[by], bucket[by], low[by]
            start, size = pack.start[first], pack.stop[first] - pack.start[first] + LENGTH
            for b, s in _by_bucket(bucket):
                body = b"".join(pack.data[a:a + n].tobytes() for a, n in zip(start[s].tolist(), size[s].tolist()))
                data = _blob(low[s], pack.id[first[s]], start[s].astype(np.uint32), size[s].astype(np.uint8), np.frombuffer(body, np.uint8))
                out.append({"bucket": b, "pack": packs["pack"].iloc[0], "n": s.stop - s.start, "data": data})
        return pd.DataFrame(out, columns=["bucket", "pack", "n", "data"])

    return run


def bucket_repeats(pieces: list[bytes], low: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each piece, bits of the stretches that also stand in a piece with a smaller id.

    Equal pieces are one string of the suffix array, with the smallest of their ids; the others lose all stretches.
    Strings whose anchor has no other string around it stand alone in the tree.  Among the rest, each maximal repeat
    shows its occurrences under larger ids than its smallest.
    """
    width = max(map(len, pieces))
    table = np.array(pieces, f"S{width + 1}")  # a piece that ends in zero bytes keeps its length below
    size = np.array([len(p) for p in pieces], np.int64)
    by = np.lexsort((ids, size, table, low))
    same = (table[by][1:] == table[by][:-1]) & (size[by][1:] == size[by][:-1]) & (low[by][1:] == low[by][:-1])
    head = np.concatenate([[True], ~same])
    string = np.cumsum(head) - 1
    firsts = by[head]
    least = ids[firsts]
    full = (np.uint64(1) << (size - LENGTH + 1).astype(np.uint64)) - np.uint64(1)
    around = low[firsts]
    edge = np.flatnonzero(np.concatenate([[True], around[1:] != around[:-1], [True]]))
    found = np.zeros(len(firsts), np.uint64)
    crowds = [(a, b) for a, b in zip(edge.tolist(), edge[1:].tolist()) if b - a > 1]
    for rows in _batches(crowds, 20_000):
        strings = [pieces[i] for i in firsts[rows]]
        owner, offset, _, common = suffix_array(strings, LENGTH)
        flat = np.frombuffer(b"".join(strings), np.uint8)
        base = np.cumsum([0] + [len(x) for x in strings])[:-1]
        left = np.where(offset > 0, flat[np.maximum(base[owner] + offset - 1, 0)].astype(np.int64), -1)
        own = least[rows][owner]
        for length, a, b in interval_groups(common, left, LENGTH):
            members = own[a:b + 1]
            stretch = np.uint64((1 << length - LENGTH + 1) - 1)
            for m in np.flatnonzero(members > members.min()):
                found[rows[owner[a + m]]] |= stretch << np.uint64(offset[a + m])
    bits = np.empty(len(pieces), np.uint64)
    bits[by] = np.where(ids[by] > least[string], full[by], found[string])
    return bits


def _batches(ranges: list[tuple[int, int]], most: int) -> Iterator[np.ndarray]:
    """Row numbers of whole ranges, about ``most`` at a time."""
    held, size = [], 0
    for a, b in ranges:
        held.append(np.arange(a, b))
        size += b - a
        if size >= most:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def show_repeats(group: pd.DataFrame) -> pd.DataFrame:
    """A bucket's pieces -> for each pack, the places of pieces with stretches to remove, and which."""
    low, ids, place, size, pieces, row = [], [], [], [], [], []
    for r, (d, n) in enumerate(zip(group["data"], group["n"])):
        a, b, c, e, rest = _unblob(d, n, np.uint32, np.int64, np.uint32, np.uint8)
        low.append(a), ids.append(b), place.append(c), row.append(np.full(n, r))
        end = np.cumsum(e.astype(np.int64)).tolist()
        pieces += [rest[x:y] for x, y in zip([0, *end], end)]
    ids, place, row = np.concatenate(ids), np.concatenate(place), np.concatenate(row)
    bits = bucket_repeats(pieces, np.concatenate(low), ids)
    keep = bits > 0
    place, bits, row = place[keep], bits[keep], row[keep]
    out = [{"bucket": -1, "pack": int(group["pack"].iloc[r]), "n": s.stop - s.start, "data": _blob(place[s], bits[s])} for r, s in _by_bucket(row)]
    return pd.DataFrame(out, columns=["bucket", "pack", "n", "data"])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>, kept binary"


def cut_repeats(n_buckets: int, with_text: bool):
    """A pack, its hot anchors and the places to remove -> one row per document."""

    def run(packs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        names = [c.split()[0] for c in RESULT.split(", ")]
        if len(packs):
            pack = Pack.unpack(packs.iloc[0])
            asked = replies["bucket"] >= 0
            kind = _kinds(pack, *_known(replies[asked], n_buckets), n_buckets)
            pack.split(np.flatnonzero(kind == 2))
            shown: dict[int, int] = {}
            for n, d in zip(replies["n"][~asked], replies["data"][~asked]):
                place, bits, _ = _unblob(d, n, np.uint32, np.uint64)
                for p, b in zip(place.tolist(), bits.tolist()):
                    shown[p] = shown.get(p, 0) | b
            gone = pack.removed(shown)
            for doc, end, size in zip(pack.ids.tolist(), pack.ends.tolist(), pack.sizes.tolist()):
                own, text = gone[end - size:end], pack.data[end - size:end]
                turn = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                kept = text[~own].tobytes()
                out.append((None if doc == _NO_ID else doc, size, int(own.sum()), len(turn) // 2, hashlib.sha256(kept).hexdigest(),
                            [{"start": a, "stop": b} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist())] if with_text else None,
                            kept if with_text else None))
        frame = pd.DataFrame(out, columns=names)
        return frame.astype({"doc_id": "Int64"})

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True,
                   pack_bytes: int = PACK_BYTES, hot_pieces: int = HOT_PIECES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept``: every byte goes that is covered by a string of 50
    bytes which also starts in a document with a smaller id; strings are judged on the input.

    1. Texts are packed (compressed, about 6 MB), written once, and cut into pieces at anchors: equal stretches of 50
       bytes have equal anchors, wherever they stand.  Packs move once, to meet the replies.
    2. Each pack reports its distinct anchors to their buckets (5 bytes each), which answer with those that two ids hold.
       Text without such an anchor holds no repeat and is never moved again.
    3. The pieces around live anchors, equal ones once per pack, meet in their bucket.  A suffix array over the strings
       of the bucket, the common-prefix interval tree by a stack scan, and the test for different bytes to the left give
       the maximal repeats with all occurrences; larger ids than the smallest lose them.
    4. Each pack puts the answers on its documents.

    An anchor with thousands of different surroundings (a line that a third of all documents hold) is dealt out by the
    bytes of single stretches instead, equal ones once per pack.  ``with_text=False`` leaves ``spans`` and ``kept`` null.
    Null and empty texts have 0 bytes.  Rows without an id come after all ids.  Rows with equal ids are not removed for
    each other's sake.  An empty table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    base = rename_clashes(docs, [key, text]).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    packed = base.mapInPandas(to_packs(pack_bytes), PACKS)
    packs = cut_lineage(packed)
    total = packs.agg(F.sum("n_bytes").alias("b")).first()["b"] or 0
    n_buckets = max(shuffle_partitions(spark), -(-total // BUCKET_TEXT))
    reported = packs.mapInPandas(anchor_rows(n_buckets), BUCKET_ROWS)
    live = cut_lineage(reported.groupBy("bucket").applyInPandas(live_anchors(hot_pieces), BUCKET_ROWS))
    pieces = packs.groupBy("pack").cogroup(live.groupBy("pack")).applyInPandas(piece_rows(n_buckets), BUCKET_ROWS)
    shown = pieces.groupBy("bucket").applyInPandas(show_repeats, BUCKET_ROWS)
    answers = live.unionByName(shown)
    return packs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInPandas(cut_repeats(n_buckets, with_text), RESULT)


def repeats_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return remove_repeats(docs, with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
