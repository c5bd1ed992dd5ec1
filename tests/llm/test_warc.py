import gzip
import hashlib
from collections import Counter

import pytest

from viewlens.llm import warc

ROWS = [
    (3, "http://a/ü\r\n", "x" * 99),
    (4, None, "x" * 99),
    (9, "http://b", "y" * 100),
    (5, "http://b", "y" * 100),
    (7, "http://c", "y" * 100),
    (5, "http://b", "y" * 100),
    (None, "http://d", "y" * 100),
    (11, None, None),
    (12, "http://e", ""),
    (13, "http://f", "é\r\n\r\nWARC/1.1\r\n" * 5000),
    (14, "http://f", "é\r\n\r\nWARC/1.1\r\n" * 5000),
]


def round_trip(spark, scratch, rows, chunk_bytes):
    df = spark.createDataFrame(
        [(*r, "extra") for r in rows], "page_id long, url string, html string, digest string"
    )
    chunks = warc.chunk_table(df, f"{scratch}/first", chunk_bytes)
    warc.write_archives(chunks, f"{scratch}/warc")
    read = warc.read_archives(spark, f"{scratch}/warc")
    return read, warc.payload_digests(read, f"{scratch}/read")


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 1000, 64])
def test_round_trip(spark, scratch, chunk_bytes):
    read, result = round_trip(spark, scratch, ROWS, chunk_bytes)
    rows = result.collect()
    payloads = Counter((r[0], hashlib.sha256((r[2] or "").encode()).hexdigest(), len((r[2] or "").encode())) for r in ROWS)
    assert Counter((r["page_id"], r["payload_digest"], r["payload_bytes"]) for r in rows) == payloads
    revisits = Counter((r["page_id"], r["refers_to"]) for r in rows if r["record_type"] == "revisit")
    assert revisits == Counter({(9, 5): 1, (7, 5): 1, (None, 5): 1, (14, 13): 1})
    assert all(r["refers_to"] is None for r in rows if r["record_type"] == "response")
    assert read.selectExpr("max(length(chunk))").first()[0] <= chunk_bytes


def test_running_digests(spark, scratch):
    df = spark.createDataFrame([(1, "u", "abcdefghij")], "page_id long, url string, html string")
    rows = warc.chunk_table(df, f"{scratch}/first", 4).orderBy("chunk_no").collect()
    assert [bytes(r["chunk"]) for r in rows] == [b"abcd", b"efgh", b"ij"]
    text = b"abcdefghij"
    assert [r["running_digest"] for r in rows] == [hashlib.sha256(text[:n]).hexdigest() for n in (4, 8, 10)]
    assert [r["last"] for r in rows] == [False, False, True]


def test_archive_is_plain_warc(spark, scratch, tmp_path):
    df = spark.createDataFrame([(1, "http://a/b", "<p>é</p>")], "page_id long, url string, html string")
    warc.write_archives(warc.chunk_table(df.coalesce(1), f"{scratch}/first"), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("*.gz")
    head, body = gzip.decompress(file.read_bytes()).split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert b"Content-Length: 9" in head and body == "<p>é</p>".encode() + b"\r\n\r\n"


def test_lost_chunk_is_noticed(spark, scratch):
    df = spark.createDataFrame([(1, "u", "z" * 300)], "page_id long, url string, html string")
    chunks = warc.chunk_table(df, f"{scratch}/first", 100).where("chunk_no <> 2")
    with pytest.raises(Exception, match="missing"):
        warc.payload_digests(chunks, f"{scratch}/read").collect()


def test_no_pages(spark, scratch):
    assert round_trip(spark, scratch, [], 100)[1].count() == 0
