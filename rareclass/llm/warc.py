"""WARC archives with segmented, chunked responses: writing through Spark, reading and reassembling."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_dir, cut_lineage, hinted, rename_clashes

# Payloads below this many bytes are never stored as revisits.
MIN_REVISIT_BYTES = 100
# Largest block of one record; longer blocks continue in further records.
SEGMENT_BYTES = 16 << 10
# Size of the chunks of the transfer framing.
CHUNK_BYTES = 4 << 10
# Records of about this many payload bytes go to one archive file.
FILE_BYTES = 16 << 20
# Fixed capture time: archives written twice are equal.
CAPTURED = "2024-01-01T00:00:00Z"

_END = b"\r\n\r\n"
_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (payload[i:i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are allowed, a torn frame is an error."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line is missing")
        size = int(body[at:end].split(b";", 1)[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response block, without its transfer framing."""
    head, mark, body = block.partition(_END)
    if not mark:
        raise ValueError("HTTP head is not ended")
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head) else body


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def _line(text: object) -> str:
    """A header value on one line."""
    return " ".join(str(text).split()) if text is not None else ""


def page_records(page: object, url: str | None, payload: bytes, digest: str, refers_to: object, row: str,
                 segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a first segment and its continuations."""
    uid = lambda n: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row}/{n}')}>"
    common = [("WARC-Date", CAPTURED), ("WARC-Target-URI", _line(url)), ("WARC-Page-ID", "" if page is None else page)]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        extra = [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", len(payload)), ("WARC-Refers-To-Page-ID", refers_to),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", uid(1)), *common, *extra], b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = head + chunked(payload)
    pieces = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", uid(1)), *common, ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("Content-Type", "application/http;msgtype=response")]
    if len(pieces) == 1:
        yield record(first, block)
        return
    yield record([*first, ("WARC-Segment-Number", 1)], pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", uid(n)), *common, ("WARC-Segment-Number", n), ("WARC-Segment-Origin-ID", uid(1))]
        yield record(more + [("WARC-Segment-Total-Length", len(block))] * (n == len(pieces)), piece)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                   segment_bytes: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Writes one record per page (and its continuations) as gzipped archives under ``path``.

    Of equal payloads of at least 100 bytes the one with the smallest id is stored, the others revisit it; the election
    is a grouped minimum by digest (combined map-side).  Equal rows meet in one task and are counted there: each has
    record ids of its own.  Spark's writer puts the two line ends between records.
    """
    base = rename_clashes(pages, [key, url, html]).toDF("page_id", "url", "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = base.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256)).withColumn("n", F.octet_length("payload"))
    stats = base.agg(F.sum(F.col("n") + 600).alias("b")).first()["b"] or 0
    large = base.where(F.col("n") >= MIN_REVISIT_BYTES).select("digest", "page_id")
    # only digests that repeat are needed at the join; a repeated id keeps its own record by the count of its rows
    shared = cut_lineage(
        large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
        .select(F.col("digest").alias("shared_digest"), "first_id"))
    n_files = max(1, -(-stats // file_bytes))
    marked = base.join(hinted(shared, shared.count(), 96), F.col("digest") == F.col("shared_digest"), "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def to_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()  # of rows of one file
        for batch in batches:
            out = []
            for page, u, data, digest, ref in zip(batch["page_id"], batch["url"], batch["payload"], batch["digest"], batch["refers_to"]):
                page, ref = None if pd.isna(page) else int(page), None if pd.isna(ref) else int(ref)
                row = f"{page}/{u}/{digest}"
                mark = hashlib.md5(row.encode()).digest()
                seen[mark] += 1
                out += page_records(page, u, bytes(data), digest, ref, f"{row}/{seen[mark]}", segment_bytes)
            yield pd.DataFrame({"record": out})

    records = marked.repartition(n_files, F.xxhash64("page_id", "digest")).mapInPandas(to_records, "record binary")
    # the text writer copies the bytes of a string as they are
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, gzipped (also member by member) or plain."""
    if data[:2] == b"\x1f\x8b":
        parts, rest = [], data
        while rest[:2] == b"\x1f\x8b":
            z = zlib.decompressobj(31)
            parts.append(z.decompress(rest) + z.flush())
            rest = z.unused_data
        data = b"".join(parts)
    at = 0
    while at < len(data):
        if data[at:at + 2] == b"\r\n":
            at += 2
            continue
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        end = data.index(_END, at)
        headers = {k.decode().lower(): v.decode() for k, v in _HEADER.findall(data, data.index(b"\r\n", at) + 2, end + 2)}
        at = end + 4
        n = int(headers["content-length"])
        if at + n > len(data):
            raise ValueError("record is cut off")
        yield headers, data[at:at + n]
        at += n


_WHOLE = "origin string, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"
_READ = _WHOLE + ", segment int, total long, block binary"


def _number(headers: dict[str, str], name: str) -> int | None:
    return int(headers[name]) if headers.get(name) else None


def _whole(headers: dict[str, str], block: bytes) -> dict:
    """The row of a record whose block is complete; a stored digest that does not fit the payload is an error."""
    row = {"origin": headers["warc-record-id"], "page_id": _number(headers, "warc-page-id"), "url": headers.get("warc-target-uri"),
           "record_type": headers["warc-type"], "refers_to": _number(headers, "warc-refers-to-page-id")}
    stored = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    if row["record_type"] == "revisit":
        return row | {"payload_digest": stored, "payload_bytes": _number(headers, "warc-payload-length")}
    payload = http_payload(block)
    digest = hashlib.sha256(payload).hexdigest()
    if stored and stored != digest:
        raise ValueError(f"payload of {row['origin']} does not fit its digest")
    return row | {"payload_digest": digest, "payload_bytes": len(payload)}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_digest, payload_bytes`` of every page record under ``path``.

    Whole records are decoded where they are read.  Segments meet by origin identifier - one page's segments are a
    group - are put in order of segment number, checked for gaps and against the total length, joined, and only then
    the transfer framing is undone.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _READ.split(", ")]
        for batch in batches:
            for data in batch["content"]:
                rows = []
                for headers, block in parse_archive(bytes(data)):
                    segment = _number(headers, "warc-segment-number")
                    if segment is None:
                        rows.append(_whole(headers, block) | {"segment": None, "total": None, "block": None})
                    else:
                        stored = headers.get("warc-payload-digest", "").removeprefix("sha256:")
                        rows.append({"origin": headers.get("warc-segment-origin-id", headers["warc-record-id"]), "page_id": _number(headers, "warc-page-id"),
                                     "url": headers.get("warc-target-uri"), "record_type": headers["warc-type"], "refers_to": None, "payload_digest": stored,
                                     "payload_bytes": None, "segment": segment, "total": _number(headers, "warc-segment-total-length"), "block": block})
                frame = pd.DataFrame(rows, columns=names)
                yield frame.astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes", "segment", "total")})

    def reassemble(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("segment")
        if list(group["segment"]) != list(range(1, len(group) + 1)):
            raise ValueError(f"segments of {group['origin'].iloc[0]} are missing or repeated")
        block = b"".join(bytes(b) for b in group["block"])
        if pd.isna(group["total"].iloc[-1]) or int(group["total"].iloc[-1]) != len(block):
            raise ValueError(f"segments of {group['origin'].iloc[0]} do not add up")
        first = group.iloc[0]
        headers = {"warc-record-id": first["origin"], "warc-type": "response", "warc-target-uri": first["url"],
                   "warc-page-id": "" if pd.isna(first["page_id"]) else str(int(first["page_id"])), "warc-payload-digest": f"sha256:{first['payload_digest']}"}
        out = pd.DataFrame([_whole(headers, block)], columns=[c.split()[0] for c in _WHOLE.split(", ")])
        return out.astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes")})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    read_in = files.mapInPandas(read, _READ)
    whole_columns = [c.split()[0] for c in _WHOLE.split(", ")]
    # one scan of the archives feeds both branches: whole records as they are, segments grouped
    rows = cut_lineage(read_in)
    whole = rows.where("segment is null").select(*whole_columns)
    joined = rows.where("segment is not null").groupBy("origin").applyInPandas(reassemble, _WHOLE)
    return whole.unionByName(joined).drop("origin")


def warc_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                    segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Writes the archives to the shared checkpoint folder and reads them back: the contract's columns.

    A null page is an empty payload.  Pages with equal ids are records of their own (all with the smallest id of a
    payload are responses); a null id is never the stored one unless all are null.  An empty table writes an empty
    archive and gives no row; other columns are not read.
    """
    spark = pages.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"warc-{uuid.uuid4().hex}")
    write_archives(pages, path, key, url, html, segment_bytes)
    out = read_archives(spark, path)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
