import gzip
import hashlib
import random

import pytest

from rareclass.llm import warc as W


def test_chunk_framing():
    for n in (0, 1, 4095, 4096, 4097, 20_000):
        data = bytes(random.Random(n).randrange(256) for _ in range(n))
        assert W.dechunked(W.chunked(data)) == data
    assert W.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        W.dechunked(b"5\r\nabc")
    assert W.http_payload(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nplain") == b"plain"


def test_archives_gzipped_member_by_member_or_plain():
    a = W.record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>")], b"HTTP/1.1 200 OK\r\n\r\n\r\n\r\nWARC/1.1") + b"\r\n\r\n"
    for data in (a * 2, gzip.compress(a * 2), gzip.compress(a) * 2):
        got = list(W.parse_archive(data))
        assert len(got) == 2 and got[0][1].endswith(b"WARC/1.1") and got[0][0]["warc-type"] == "response"
    with pytest.raises(ValueError):
        list(W.parse_archive(a[:-9]))


def pages():
    rng = random.Random(4)
    long = "".join(rng.choice("abcdé中 \r\n") for _ in range(60_000))
    rows = [(i, f"http://h/{i}", f"<p>{rng.random()}</p>" * 5, "x") for i in range(30)]
    return rows + [(100, "http://h/a", long, "x"), (90, "http://h/b", long, "x"), (95, None, long, "x"), (101, "u\r\nX: y", "s" * 100, "x"),
                   (102, "u", "s" * 100, "x"), (103, "u", "t" * 99, "x"), (104, "u", "t" * 99, "x"), (105, "", None, "x"), (106, "", "", "x"),
                   (107, "u", "WARC/1.1\r\n\r\n" * 40, "x"), (None, "n", "null id " * 30, "x"), (108, "n", "null id " * 30, "x"), (109, "d", "same row", "x"), (109, "d", "same row", "x")]


def brute(rows):
    first = {}
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        ref = first.get(b) if first.get(b) != i else None
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment_bytes", [W.SEGMENT_BYTES, 150])
def test_round_trip(spark, segment_bytes):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string, digest string").repartition(3)
    got = W.warc_round_trip(df, segment_bytes=segment_bytes).collect()
    assert sorted([tuple(r[:5]) for r in got], key=str) == brute(pages())
    assert {r["page_id"]: r["url"] for r in got}[101] == "u X: y"


def test_repeated_rows_longer_than_a_segment(spark):
    long = "".join(random.Random(8).choice("abc \n") for _ in range(40_000))
    rows = [(1, "u", long), (1, "u", long), (1, "v", long), (2, "u", long), (None, "u", "n" + long), (None, "u", "n" + long), (None, None, "m" + long), (None, "None", "m" + long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = W.warc_round_trip(df).collect()
    assert sorted([tuple(r[:5]) for r in got], key=str) == brute(rows)


def test_lost_and_changed_segments_are_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc" * 500)], "page_id long, url string, html string")
    W.write_archives(df, str(tmp_path / "a"), segment_bytes=200)
    files = [f for f in (tmp_path / "a").iterdir() if f.name.endswith(".gz")]
    records = [r for f in files for r in W.parse_archive(f.read_bytes())]
    assert len(records) > 3 and {h["warc-type"] for h, _ in records} == {"response", "continuation"}
    for name, keep in (("lost", records[:1] + records[2:]), ("cut", records[:-1]), ("twice", records + records[1:2])):
        (tmp_path / name).mkdir()
        body = b"".join(W.record([(k.title().replace("Warc", "WARC").replace("Id", "ID").replace("Uri", "URI"), v) for k, v in h.items() if k != "content-length"], b) + b"\r\n\r\n" for h, b in keep)
        (tmp_path / name / "x.gz").write_bytes(gzip.compress(body))
        with pytest.raises(Exception, match="missing or repeated|add up"):
            W.read_archives(spark, str(tmp_path / name)).collect()


def test_empty_table(spark):
    assert W.warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
