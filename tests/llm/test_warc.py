import gzip
import hashlib
import random
import zlib

import cases
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from formflow.llm import warc

SCHEMA = "page_id long, url string, html string"


def read(spark, pages, split_bytes=16 << 20, **how):
    df = spark.createDataFrame(pages, SCHEMA) if isinstance(pages, list) else pages
    return warc.read_archives(spark, warc.write_archives(df, **how), split_bytes).collect()


def test_round_trip_over_any_split(spark):
    rng = random.Random(6)
    pages = [(i, f"http://h/{i}?a\r\nb%41", "".join(rng.choices("ab<>\n é𝒳", k=rng.choice((0, 10, 900, 5000))))) for i in range(60)]
    for split in (1, 37, 1000, 50_000, 1 << 24):
        if split == 1:
            rows = read(spark, pages[:3], split)
            assert len(rows) == 3
            continue
        rows = read(spark, pages, split)
        assert sorted((r.page_id, r.url, bytes(r.payload).decode()) for r in rows if r.payload is not None) == sorted(pages)
        assert all(r.payload_digest == hashlib.sha1(pages[r.page_id][2].encode()).hexdigest() for r in rows)


def test_every_record_belongs_to_one_range(tmp_path):
    records = [warc.record_bytes(i, None, bytes([65 + i]) * (50 * i), hashlib.sha1(bytes([65 + i]) * (50 * i)).hexdigest()) for i in range(20)]
    data = b"".join(gzip.compress(r) for r in records)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    assert gzip.decompress(data) == b"".join(records)
    for width in (1, 7, 100, 333, len(data)):
        found = [r for s in range(0, len(data), width) for r in warc.records_in(fs.LocalFileSystem(), str(path), len(data), s, min(len(data), s + width))]
        assert found == records, width


def test_magic_bytes_inside_members_are_no_records(tmp_path):
    # stored, not compressed: the payload's own gzip magic stands in the file
    payload = warc.MAGIC * 200 + gzip.compress(b"no archive")
    record = warc.record_bytes(1, None, payload, hashlib.sha1(payload).hexdigest())
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = packer.compress(record) + packer.flush()
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    for width in (5, 64, len(data)):
        assert [r for s in range(0, len(data), width) for r in warc.records_in(fs.LocalFileSystem(), str(path), len(data), s, min(len(data), s + width))] == [record]


def test_damage_is_an_error():
    record = warc.record_bytes(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest())
    assert warc.parse_record(record)["payload"] == b"abc"
    for broken in (record.replace(b"abc", b"abd"), record[:-1], record.replace(b"Content-Length: 3", b"Content-Length: 4")):
        with pytest.raises(ValueError):
            warc.parse_record(broken)


def test_revisits(spark):
    big, small, wide = "x" * 1000, "y" * 999, "é" * 500
    rows = read(spark, [(1, "a", big), (5, "b", big), (3, "c", big), (2, "d", small), (4, "e", small), (7, "f", wide), (6, "g", wide), (None, "h", big), (9, "i", "z" * 2000)])
    got = {r.url: (r.record_type, r.refers_to, r.payload_bytes) for r in rows}
    assert got["b"] == ("response", None, 1000)
    assert got["a"] == got["c"] == got["h"] == ("revisit", 5, 1000)
    assert got["d"] == got["e"] == ("response", None, 999)
    assert got["f"] == ("response", None, 1000) and got["g"] == ("revisit", 7, 1000) and got["i"][0] == "response"


def test_edge_cases(spark):
    pages = [(1, None, None), (None, None, None), (2, "u", ""), (3, "u", "q" * 1500), (3, "u", "q" * 1500), (4, "u", "long é " * 300_000)]
    df = cases.with_clashes(spark.createDataFrame(pages, SCHEMA)).withColumns({"digest": F.lit("d"), "refers_to": F.lit(1), "payload": F.lit(2)})
    rows = read(spark, df, 10_000)
    assert len(rows) == 6 and sorted(r.payload_bytes for r in rows) == [0, 0, 0, 1500, 1500, 2_400_000]
    assert all(r.record_type == "response" for r in rows)
    assert read(spark, spark.createDataFrame([], SCHEMA)) == []
    both_null = read(spark, [(None, "a", "n" * 1200), (None, "b", "n" * 1200)])
    assert [r.record_type for r in both_null] == ["response"] * 2


def foreign(kind, block, *headers):
    head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID:<urn:uuid:1>", *headers, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_of_other_writers(spark, tmp_path):
    http = "Content-Type: application/http; msgtype=response"
    sha = lambda b: hashlib.sha1(b).hexdigest()
    records = [
        (foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"), ("warcinfo", None, 13, sha(b"software: x\r\n"))),
        (foreign("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", "Content-Type: application/http; msgtype=request", "WARC-Target-URI: http://h/a%25b"), ("request", "http://h/a%25b", 0, sha(b""))),
        (foreign("response", b"HTTP/1.1 200 OK\r\n\r\nbody", http, "warc-target-uri:http://h/"), ("response", "http://h/", 4, sha(b"body"))),
        (foreign("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nbody\r\n0\r\n\r\n", http, f"WARC-Payload-Digest: sha1:{sha(b'body')}"), ("response", None, 14, sha(b"body"))),
        (foreign("response", b"HTTP/1.1 200 OK\r\nContent-Length: 900\r\n\r\ncut", http, "WARC-Truncated: length"), ("response", None, 3, sha(b"cut"))),
        (foreign("response", b"HTTP/1.1 200 OK\r\n\r\nbody", http, "WARC-Payload-Digest: md5:00"), ("response", None, 4, sha(b"body"))),
        (foreign("revisit", b"", "WARC-Target-URI: http://h/"), ("revisit", "http://h/", None, None)),
        (foreign("metadata", b"", "WARC-Target-URI: "), ("metadata", "", 0, sha(b""))),
    ]
    path = tmp_path / "other.warc.gz"
    path.write_bytes(b"".join(gzip.compress(r) for r, _ in records))
    listed = spark.createDataFrame([(f"file://{path}", path.stat().st_size, len(records))], warc.ARCHIVES)
    for split in (50, 1 << 20):
        rows = warc.read_archives(spark, listed, split).collect()
        assert sorted(map(str, [(r.record_type, r.url, r.payload_bytes, r.payload_digest) for r in rows])) == sorted(str(w) for _, w in records)
        assert all(r.page_id is None and (r.payload is None) == (r.record_type == "revisit") for r in rows)
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(foreign("response", b"HTTP/1.1 200 OK\r\n\r\nbody", http, f"WARC-Payload-Digest: sha1:{sha(b'other')}"))


def test_a_large_member_beyond_its_range_is_read_once(tmp_path):
    payload = random.Random(2).randbytes(3_000_000)
    record = warc.record_bytes(1, "u", payload, hashlib.sha1(payload).hexdigest())
    data = gzip.compress(record) + gzip.compress(warc.record_bytes(2, "u", b"x", hashlib.sha1(b"x").hexdigest()))
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    found = [len(list(warc.records_in(fs.LocalFileSystem(), str(path), len(data), s, min(len(data), s + 1_000_000)))) for s in range(0, len(data), 1_000_000)]
    assert found == [1, 0, 0, 1]
