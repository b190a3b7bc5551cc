"""WARC archives: one gzip member per record, payloads stored once, and a splittable reader.

Writing. Payload digests are computed in the JVM; one row per repeated digest names the response that the others revisit.
Each task writes archives of its own under a fresh name in a shared folder and returns their names; only the names that
successful tasks returned are in the list of archives, so a lost or repeated task leaves nothing that is read.

Reading. Archives are cut into byte ranges. A task scans its range for the gzip magic, takes a candidate for a record if
the first bytes decode to a WARC header, and owns exactly the records that start inside its range, reading on beyond its
end where the last one needs it. Checksums, lengths and payload digests are verified. Archives of other writers are read
too (``parse_record`` states the rules); an archive that stands uncompressed inside a member's payload is taken for records
of its own if a range starts inside that member.

Edge cases: a null or empty payload is a record of 0 bytes; a null url has no target header; a null id has no id header;
rows with the same id are separate records (if it is the largest id of equal payloads, each is a response); equal payloads
without any id are all responses; an empty table gives an empty list; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formflow.session import materialise, work_dir

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PROBE, _STEP = 4096, 1 << 16

ARCHIVES = "path string, bytes long, records long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _line(value: str) -> str:
    """A header value on one line; carriage returns, line feeds and per cent signs are escaped."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to=None, revisit: bool = False, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record as it stands in the archive before compression. ``digest`` is the payload's SHA-1 in hex."""
    named = lambda x: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{x}:{digest}')}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {named(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
        if _line(url) != url:
            head.append("X-Target-Escaped: percent")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {named(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (x.decode("utf-8", "replace").partition(":") for x in lines)
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def _sha1_of(stated: str | None) -> str | None:
    """A stated SHA-1 as hex, from base 32 or hex; None for none or another algorithm."""
    algorithm, _, value = (stated or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def parse_record(record: bytes) -> dict:
    """The fields of ``RECORDS`` of one record. Fails if a length or a digest does not hold.

    Records of other writers: ``record_type`` is the record's own (warcinfo, request, metadata, ...). The payload is what
    follows the HTTP head where the block is an HTTP message, else the whole block. Without a SHA-1 payload digest in the
    record it is worked out (a revisit has none then). A payload's length and digest are not judged where the record says
    that it was cut off (WARC-Truncated) or sent in chunks (Transfer-Encoding); the block's length always is.
    """
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _headers(head.split(b"\r\n")[1:])
    block = rest[: int(fields["content-length"])]
    if len(block) != int(fields["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')}: wrong length")
    http, payload = {}, block
    if fields.get("content-type", "").lower().startswith("application/http"):
        lines, _, payload = block.partition(b"\r\n\r\n")
        http = _headers(lines.split(b"\r\n")[1:])
    kind, stated = fields["warc-type"], _sha1_of(fields.get("warc-payload-digest"))
    revisit = kind == "revisit"
    judged = not (revisit or "warc-truncated" in fields or "transfer-encoding" in http)
    size = int(http["content-length"]) if http.get("content-length", "").isdigit() else None if revisit else len(payload)
    digest = stated if revisit or stated else hashlib.sha1(payload).hexdigest()
    if judged and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields.get('warc-record-id')}: payload does not match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    url = fields.get("warc-target-uri")
    return {"page_id": number("x-page-id"), "url": _unline(url) if url and "x-target-escaped" in fields else url, "record_type": kind,
            "refers_to": number("x-refers-to-page"), "payload_bytes": size if judged or revisit else len(payload), "payload_digest": digest,
            "payload": None if revisit else payload}


def with_responses(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, html, digest and ``refers_to``: the id of the response to revisit, null for a response.

    Only one row per repeated digest is joined to the pages; it is written before, so that a digest that very many pages
    share is split among tasks.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = F.octet_length("html") >= least
    kept = rows.where(large).groupBy("digest").agg(F.max("page_id").alias("__largest"), F.count("*").alias("__n"))
    kept = materialise(kept.where("__n > 1 and __largest is not null").select(F.col("digest").alias("__digest"), "__largest"), "warc-responses")
    joined = rows.join(kept, (F.col("digest") == F.col("__digest")) & large, "left")
    other = F.col("page_id").isNull() | (F.col("page_id") < F.col("__largest"))
    return joined.select("page_id", "url", "html", "digest", F.when(other, F.col("__largest")).alias("refers_to"))


def _write(folder: str, level: int, date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        done, out, name, size, n = [], None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                record = record_bytes(row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"], row["refers_to"] is not None, date)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(record) + packer.flush()
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= archive_bytes:
                    out.close()
                    done, out = [*done, (f"{folder}/{name}", size, n)], None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, n))
        if done:
            path, sizes, records = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(sizes, pa.int64()), pa.array(records, pa.int64())], ["path", "bytes", "records"])

    return run


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 1000, level: int = 6, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = 1 << 30) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``folder`` and give their list: path, bytes, records."""
    folder = folder or work_dir(pages.sparkSession, "warc")
    return materialise(with_responses(pages, least).mapInArrow(_write(folder, level, date, archive_bytes), ARCHIVES), "warc-list")


def records_in(store, path: str, size: int, start: int, end: int) -> Iterator[bytes]:
    """The uncompressed records whose gzip members start in [start, end) of a file."""
    with store.open_input_file(path) as f:
        buffer = f.read_at(min(size, end + _PROBE) - start, start)
        at = buffer.find(MAGIC)
        while 0 <= at < end - start:
            try:
                valid = zlib.decompressobj(31).decompress(memoryview(buffer)[at : at + _PROBE], 7) == b"WARC/1."
            except zlib.error:
                valid = False
            if not valid:
                at = buffer.find(MAGIC, at + 1)
                continue
            packed, parts, place = zlib.decompressobj(31), [], at
            while not packed.eof:  # beyond the range the member is read block by block, and no block is kept
                block = buffer[place : place + _STEP] if place < len(buffer) else f.read_at(min(_STEP, size - start - place), start + place)
                if not block:
                    raise ValueError(f"{path}: the record at {start + at} is cut off")
                parts.append(packed.decompress(block))
                place += len(block) - len(packed.unused_data)
            yield b"".join(parts)
            at = buffer.find(MAGIC, place)


def _read(with_payload: bool):
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(split["path"])
                rows, held = [], 0
                for record in records_in(store, path, split["bytes"], split["start"], split["end"]):
                    row = parse_record(record)
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held > 1 << 22:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def read_archives(spark: SparkSession, archives: DataFrame, split_bytes: int = 16 << 20, with_payload: bool = True) -> DataFrame:
    """The records of the listed archives (path, bytes), one row each, read in ranges of ``split_bytes``."""
    if split_bytes < 1:
        raise ValueError("split_bytes must be positive")
    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + split_bytes, F.col("bytes")))
    total = archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    ranges = ranges.repartition(int(total))  # a task per range; a number given keeps small rows from being put together
    return ranges.mapInArrow(_read(with_payload), RECORDS)
