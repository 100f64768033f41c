import gzip
import hashlib
import random

import pytest

from tidemark.llm import warc as W

BIG = "x" * 1500
ROWS = [
    (1, "http://a.b/c d", BIG),
    (2, "http://a/x", BIG),
    (3, None, BIG),
    (3, None, BIG),
    (None, "http://q", BIG),
    (None, None, None),
    (5, "u", None),
    (6, "u", ""),
    (7, "u", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (8, "u", "short"),
    (9, "u", "short"),
    (10, "u\nv", "long " * 100_000),
    (11, "u", "é" * 500),
    (12, "u", "é" * 500),
    (13, "u", "e" * 999),
    (14, "u", "e" * 999),
]


def pages(spark, rows=ROWS):
    wide = [(*r, "clash", "clash", 1) for r in rows]
    return spark.createDataFrame(wide, "page_id long, url string, html string, digest string, payload string, rank int")


def slow(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        twins = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = max(twins, default=None)
        revisit = len(data) >= 1000 and first is not None and page != first
        out.append(
            (page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
             first if revisit else None)
        )
    return sorted(out, key=str)


def test_round_trip(spark):
    got = W.round_trip(pages(spark)).collect()
    assert sorted(map(tuple, got), key=str) == slow(ROWS)
    assert W.round_trip(pages(spark).limit(0)).count() == 0


def test_small_files_and_hot_payloads(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", BIG if i % 3 == 0 else f"{i} " * rng.randrange(800)) for i in range(300)]
    files = W.write_archives(pages(spark, rows), f"file://{tmp_path}/w", file_bytes=2000)
    files = spark.createDataFrame(files.collect())
    assert files.count() > 20
    got = W.captures(W.read_archives(files)).collect()
    assert len(got) == 300
    payloads = {int(r["metadata"]["page_id"]): r["response"] and bytes(r["response"]["payload"]) for r in got}
    for i, _, html in rows:
        assert payloads[i] == (None if i % 3 == 0 and i != 297 else html.encode())
    assert all(r["request"]["record_id"] == r["capture"] for r in got)


def test_foreign_records(spark, tmp_path):
    """Any order, a plain hub record, a missing partner, another type, damaged files."""
    def rec(kind, own, to=None, body=b"H\r\n\r\nbody"):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {own}\r\n"
        head += f"WARC-Concurrent-To: {to}\r\n" if to else ""
        return gzip.compress(f"{head}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")

    data = rec("metadata", "<m>", "<r>", b"page-id: 4\r\n") + rec("warcinfo", "<i>") + rec("request", "<q>", "<r>")
    data += rec("response", "<r>") + rec("request", "<alone>")
    (tmp_path / "a.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "path string")
    got = {r["capture"]: r for r in W.captures(W.read_archives(files)).collect()}
    assert set(got) == {"<r>", "<alone>"}
    assert bytes(got["<r>"]["response"]["payload"]) == b"body" and got["<r>"]["metadata"]["page_id"] == "4"
    assert got["<r>"]["request"]["record_id"] == "<q>" and got["<alone>"]["response"] is None
    (tmp_path / "b.warc.gz").write_bytes(data[:-20])
    files = spark.createDataFrame([(f"file://{tmp_path}/b.warc.gz",)], "path string")
    with pytest.raises(Exception, match="ends inside a record"):
        W.read_archives(files).count()
