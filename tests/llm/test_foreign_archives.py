"""WARC archives of other writers, damaged ones, and what the operator leaves on the session."""

import base64
import hashlib
import struct

import pytest
import zstandard

from corpusflow.llm import warc

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def record(kind, block, *heads, version=b"WARC/1.0", name="<urn:uuid:1>"):
    lines = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", "2020-02-02T02:02:02Z"), *heads, ("Content-Length", str(len(block)))]
    return version + b"\r\n" + b"".join(f"{a}: {b}\r\n".encode() for a, b in lines) + b"\r\n" + block + b"\r\n\r\n"


def streamed(block):
    """A frame as a streaming writer makes it: without its content size."""
    z = zstandard.ZstdCompressor(write_content_size=False).compressobj()
    return z.compress(block) + z.flush()


def rows(data):
    return list(warc.read_archive(data))


HTTP = ("Content-Type", "application/http; msgtype=response")
PAGE = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
HEX = hashlib.sha1(b"hello").hexdigest()
B32 = base64.b32encode(bytes.fromhex(HEX)).decode()


def test_frames_of_unknown_size_and_skippable_frames_between():
    skip = struct.pack("<II", 0x184D2A51, 3) + b"abc"
    one, two = record("response", PAGE, HTTP), record("metadata", b"a: b")
    got = rows(streamed(one) + skip + streamed(two) + skip)
    assert [error for _, error in got] == [None, None]
    assert [row[3] for row, _ in got] == ["response", "metadata"]
    assert rows(streamed(one) + skip[:-1])[-1] == (None, "skippable frame is cut off")


def test_headers_of_other_writers():
    twice = [("WARC-Concurrent-To", "<urn:uuid:7>"), ("WARC-Concurrent-To", "<urn:uuid:8>"), ("X-Long", "a\r\n  b")]
    (row, error), = rows(streamed(record("response", PAGE, HTTP, *twice, ("WARC-Target-URI", "http://a/"))))
    assert error is None and row == (None, 5, HEX, "response", None, b"hello", "<urn:uuid:1>", "http://a/", None)
    for digest in (HEX, HEX.upper(), B32, B32.lower()):
        assert rows(streamed(record("response", PAGE, HTTP, ("WARC-Payload-Digest", "sha1:" + digest))))[0][1] is None
    assert rows(streamed(record("response", PAGE, HTTP, ("WARC-Payload-Digest", "sha256:00"))))[0][1] is None


def test_payloads_without_one_plain_length():
    none = record("response", b"HTTP/1.1 200 OK\r\n\r\nhello", HTTP)
    dns = record("response", b"20200202\r\nx. 1 IN A 1.2.3.4", ("Content-Type", "text/dns"))
    chunked = record("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n0\r\n\r\n", HTTP, ("WARC-Payload-Digest", "sha1:" + B32))
    cut = record("response", PAGE[:-2], HTTP, ("WARC-Truncated", "length"), ("WARC-Payload-Digest", "sha1:" + B32))
    got = rows(b"".join(map(streamed, (none, dns, chunked, cut))))
    assert [error for _, error in got] == [None] * 4
    assert [row[1] for row, _ in got] == [5, 27, 15, 3]
    again = record("revisit", b"", ("WARC-Refers-To", "<urn:uuid:9>"), ("WARC-Payload-Digest", "sha1:" + B32))
    (row, error), = rows(streamed(again))
    assert error is None and row[1:5] == (None, HEX, "revisit", None) and row[8] == "<urn:uuid:9>"


@pytest.mark.parametrize("bad", [
    record("response", PAGE, HTTP, ("WARC-Payload-Digest", "sha1:" + "A" * 32)),
    record("response", PAGE, HTTP, ("WARC-Block-Digest", "sha1:" + B32)),
    record("response", PAGE[:-1], HTTP),
    record("response", PAGE, HTTP, ("WARC-Type", "request")),
    record("response", PAGE, HTTP, version=b"WARC/0.9"),
    record("response", PAGE, HTTP)[:-1],
    b"WARC/1.0\r\nWARC-Type: response\r\n\r\n",
    b"",
])
def test_invalid_records_are_named_and_the_next_is_read(bad):
    got = rows(streamed(bad) + streamed(record("response", PAGE, HTTP)))
    assert got[0][0] is None and got[0][1] and got[1][1] is None


def test_folder_of_another_writer(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(b"".join(streamed(record("response", PAGE, HTTP, name=f"<urn:uuid:{i}>")) for i in range(5)))
    (tmp_path / "b.warc.zst").write_bytes(streamed(record("request", b"GET / HTTP/1.1\r\n\r\n", HTTP)) + b"junk")
    got = warc.read_folder(spark, str(tmp_path)).collect()
    assert sorted((r.archive, r.record_type, r.error is None) for r in got if r.record_type) == [("a.warc.zst", "response", True)] * 5 + [("b.warc.zst", "request", True)]
    assert [(r.archive, r.record_id) for r in got if r.error] == [("b.warc.zst", None)]
    assert sorted(r.record_id for r in got if r.archive == "a.warc.zst") == [f"<urn:uuid:{i}>" for i in range(5)]


def test_missing_and_damaged_records_fail(spark):
    # a null and a repeated id, and a text of two million characters
    pages = spark.createDataFrame([(1, "u", "x" * 2_000_000), (None, "u", "y"), (2, None, "z"), (2, None, "z")], "page_id long, url string, html string")
    before = spark.conf.get(SETTING)
    folder, manifest = warc.write_archives(pages, key="page_id", url="url", payload="html")
    spark.conf.set(SETTING, "777")
    try:
        read = warc.checked(warc.read_archives(folder, manifest), manifest)
        assert spark.conf.get(SETTING) == "777"
    finally:
        spark.conf.set(SETTING, before)
    assert sorted((r.page_id or 0, r.payload_bytes) for r in read.collect()) == [(0, 1), (1, 2_000_000), (2, 1), (2, 1)]
    more = manifest.selectExpr("name", "records + 1 AS records", "bytes")
    with pytest.raises(ValueError, match="records"):
        warc.checked(read, more)
    with pytest.raises(ValueError, match="damaged"):
        warc.checked(read.selectExpr("archive", "IF(page_id = 1, 'damaged', error) AS error"), manifest)
