"""WARC archives: a writer with payload deduplication, and a splittable reader of gzip members.

The reader's tasks take byte ranges. A task scans its range for the gzip magic, validates each candidate by decoding its
header and the first bytes of the record, and owns the records that start inside; the last one is read past the range's
end. No index and no pass over the whole file is needed.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import listed, open_in, open_out, scratch, small_batches, table

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 64 << 20
ROTATE_BYTES = 1 << 30
#: Payloads shorter than this are never written as revisits.
LEAST_SHARED = 1000
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def member(head: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    text = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + f"Content-Length: {len(block)}\r\n\r\n"
    data = text.encode() + block + b"\r\n\r\n"
    z = zlib.compressobj(4, zlib.DEFLATED, -15)
    return MAGIC + b"\0\0\0\0\0\0\xff" + z.compress(data) + z.flush() + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(key: str, url: str | None, payload: bytes, digest: str, refers: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", f"<urn:page:{key}>"), ("WARC-Date", "2024-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("Content-Type", "application/http; msgtype=response")]
    if url:
        head.append(("WARC-Target-URI", "".join(url.split("\r")).replace("\n", "")))
    if refers:
        head += [("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", PROFILE)]
    return member(head, http if refers else http + payload)


def plan_revisits(pages: DataFrame, key: str, payload: str, least: int = LEAST_SHARED) -> DataFrame:
    """pages with _digest and _refers: of equal payloads of at least `least` bytes, the largest key stays a response.

    Repeated rows of that key are all responses. The grouped side has a row per digest that occurs twice, and the pages'
    side of the join may be split wherever one payload fills a third of it.
    """
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), "utf-8")
    with_digest = pages.withColumn("_digest", F.sha1(data))
    long_ = pages.select(key, F.sha1(data).alias("_digest"), F.length(data).alias("_n")).filter(F.col("_n") >= least)
    shared = long_.groupBy("_digest").agg(F.max(key).alias("_top"), F.count("*").alias("_c")).filter("_c > 1")
    out = with_digest.join(shared, "_digest", "left")
    return out.withColumn("_refers", F.when(~F.col(key).eqNullSafe(F.col("_top")), F.col("_top"))).drop("_top", "_c")


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", rotate: int = ROTATE_BYTES) -> list[tuple[str, int]]:
    """Write a record per row into folder; the (path, size) of each finished archive.

    A task streams rows into files of its own attempt and reports them only when they are whole, so a lost or doubled
    attempt leaves files that nobody reads. As many entries reach the driver as there are archives.
    """
    small_batches(pages.sparkSession)
    planned = plan_revisits(pages.select(key, url, payload), key, payload).select(F.col(key).cast("string").alias("k"), F.col(url).alias("u"), F.coalesce(F.col(payload), F.lit("")).alias("p"), "_digest", F.col("_refers").cast("string").alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, done = None, "", 0, []
        for batch in batches:
            for k, u, p, d, r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or size >= rotate:
                    if out is not None:
                        out.close()
                        done.append((path, size))
                    path, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    out = open_out(path)
                data = record(k or "null", u, p.encode(), d, r)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            done.append((path, size))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], pa.int64())], ["path", "size"])

    return [tuple(r) for r in planned.mapInArrow(run, "path string, size long").collect()]


def _parse(data: bytes) -> dict | None:
    """A decoded member as its headers and block; None if it isn't a WARC record."""
    if not data.startswith(b"WARC/"):
        return None
    head, sep, rest = data.partition(b"\r\n\r\n")
    if not sep:
        return None
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    n = int(fields.get("content-length", "-1")) if fields.get("content-length", "").isdigit() else -1
    if n < 0 or n > len(rest):
        return None
    return {"fields": fields, "block": rest[:n]}


class _Range:
    """A window on a file that grows to the right as members need it."""

    def __init__(self, file, size: int, start: int):
        self.file, self.size, self.start, self.data = file, size, start, b""

    def more(self, step: int = 1 << 20) -> bool:
        at = self.start + len(self.data)
        if at >= self.size:
            return False
        self.file.seek(at)
        self.data += self.file.read(min(step, self.size - at))
        return True

    def drop(self, upto: int) -> None:
        self.data, self.start = self.data[upto - self.start :], upto


def _decode(window: _Range, at: int) -> tuple[bytes, int] | None:
    """The member at a place of the file and where it ends; None if it doesn't decode to a WARC record with a right checksum."""
    z, out, pos, checked = zlib.decompressobj(31), [], at, False
    while True:
        have = window.data[pos - window.start :]
        if not have:
            if not window.more():
                return None
            continue
        try:
            piece = z.decompress(have)
        except zlib.error:
            return None
        if piece:
            out.append(piece)
        if not checked and sum(map(len, out)) >= 5:
            checked = True
            if not b"".join(out)[:5] == b"WARC/":
                return None
        pos = window.start + len(window.data) - len(z.unused_data)
        if z.eof:
            return b"".join(out), pos


def read_range(file, size: int, start: int, end: int) -> Iterator[tuple[int, int, dict]]:
    """(offset, length, record) of each record that starts in [start, end)."""
    window, at = _Range(file, size, start), start
    while at < end:
        while len(window.data) < at - window.start + 3 and window.more():
            pass
        found = window.data.find(MAGIC, at - window.start)
        if found < 0:
            at = max(at, window.start + len(window.data) - 2)
            if at >= end or not window.more():
                return
            window.drop(at)
            continue
        at = window.start + found
        if at >= end:
            return
        got = _decode(window, at)
        parsed = got and _parse(got[0])
        if not parsed:
            at += 1
            continue
        # a member inside another's stored data isn't followed by a member or the file's end
        while len(window.data) < got[1] - window.start + 3 and window.more():
            pass
        follow = window.data[got[1] - window.start : got[1] - window.start + 3]
        if follow and follow != MAGIC[: len(follow)]:
            at += 1
            continue
        yield at, got[1] - at, parsed
        at = got[1]
        window.drop(at)


SCHEMA = "path string, offset long, length long, record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary, digest_ok boolean"


def _row(path: str, offset: int, length: int, rec: dict) -> tuple:
    f, block = rec["fields"], rec["block"]
    kind = f.get("warc-type", "")
    payload, stated = None, None
    if f.get("content-type", "").startswith("application/http"):
        head, _, body = block.partition(b"\r\n\r\n")
        stated = next((int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:") and x.partition(b":")[2].strip().isdigit()), None)
        payload = body if kind == "response" else None
    elif kind in ("resource", "conversion"):
        payload = block
    want = f.get("warc-payload-digest", "").partition("sha1:")[2]
    try:
        want = base64.b32decode(want).hex() if len(want) == 32 else want.lower()
    except ValueError:
        want = ""
    digest = hashlib.sha1(payload).hexdigest() if payload is not None else want or None
    ident = lambda x: x.strip("<>") if x else None
    return (path, offset, length, kind, ident(f.get("warc-record-id")), f.get("warc-target-uri"), ident(f.get("warc-refers-to")), digest, len(payload) if payload is not None else stated, payload, payload is None or not want or digest == want)


def archives(folder: str) -> list[tuple[str, int]]:
    """(path, size) of the .warc.gz files of a folder."""
    return [(p, n) for p, n in listed(folder) if p.endswith(".warc.gz")]


def read_warc(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """A row per record of the archives, in SCHEMA's columns; damaged members are skipped and reading resumes at the next magic."""
    splits = [(p, n, a, min(a + split_bytes, n)) for p, n in files for a in range(0, n, split_bytes)]
    small_batches(spark)
    parts = max(1, min(len(splits), 64 * spark.sparkContext.defaultParallelism))
    ranges = spark.createDataFrame(spark.sparkContext.parallelize(splits, parts), "path string, size long, start long, end long")
    kinds = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("digest_ok", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, kinds, strict=True)], schema=kinds)

        for batch in batches:
            for path, size, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open_in(path) as file:
                    rows, held = [], 0
                    for offset, length, rec in read_range(file, size, start, end):
                        row = _row(path, offset, length, rec)
                        if not with_payload:
                            row = (*row[:9], None, row[10])
                        rows.append(row)
                        held += len(row[9] or b"") + 200
                        if held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    return ranges.mapInArrow(run, SCHEMA)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a record per page, reads the archives back. Null html: an empty payload; a null page_id reads back as null."""
    files = write_warc(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    ident = lambda c: F.try_to_number(F.nullif(F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1), F.lit("")), F.lit("S9999999999999999999")).cast("long")
    return read_warc(spark, files, with_payload=False).select(
        ident("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", ident("refers_to").alias("refers_to")
    )


QUERIES = {"op2_warc": op2_warc}
ORACLE = {
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS top FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest, CASE WHEN g.top <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.top <> d.page_id THEN g.top END AS refers_to
FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND d.payload_bytes >= 1000"""
}
