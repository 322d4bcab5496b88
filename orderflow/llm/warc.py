"""WARC archives: writer with revisits, and a splittable reader.

A record is one gzip member.  Of records with equal payloads the one with
the largest page id is written as a response, the others as revisits that
name it and carry only its HTTP header.

Readers split archives into byte ranges.  A task scans its range for the
gzip magic; a candidate counts if a member can be decoded there whose
plain text opens with a WARC header.  A record belongs to the range its
member starts in, and a task reads on past its range's end to finish the
last one.  Magic bytes inside compressed data fail the header check, and
a task that starts inside a member skips ahead to the next.

Archives live in the shared scratch folder and are opened through
``pyarrow.fs`` (local and shared folders, HDFS, object stores).  A task
writes a file under a name of its own and renames it when complete; only
files named in the written manifest are read, so retried or lost tasks
leave nothing that is read.

Defined cases: NULL html is an empty payload; empty payloads count as
equal like any others; a NULL page id is written, never preferred to
another id, and read back as NULL; rows that repeat id and payload are
revisits of the one written first in the files' order of pages, except
that all carry the same id; no pages give no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import left_join_nonnull
from ..session import scratch_path
from .common import checkpoint_root, stored, texts_of

#: Bytes of archive one reading task owns.
RANGE_BYTES = 16 << 20
#: An archive file is closed beyond this size.
FILE_BYTES = 64 << 20
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
#: Bytes fetched at a time.
FETCH = 1 << 20


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    own = "" if page_id is None else str(page_id)
    lines = [
        "WARC-Type: " + ("revisit" if revisit else "response"),
        f"WARC-Record-ID: <urn:page:{own}>",
        "WARC-Date: 2000-01-01T00:00:00Z",
        "WARC-Target-URI: " + " ".join((url or "").split()),
        "WARC-Payload-Digest: sha1:" + payload_digest(payload),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    plain = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(plain) + z.flush()


def write(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write archives below ``path``; returns the stored manifest (file, size).

    ``pages``: page_id, url, html, refers_to, revisit.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        out, names = None, []

        def close():
            nonlocal out
            if out is not None:
                out[0].close()
                name = f"{uuid.uuid4().hex}.warc.gz"
                fs.move(out[1], f"{root}/{name}")
                names.append((name, out[2]))
                out = None

        for batch in batches:
            for r in zip(*(texts_of(batch, c) for c in ("page_id", "url", "html", "refers_to", "revisit"))):
                payload = (r[2] or "").encode("utf-8", "surrogatepass")
                member = record(r[0], r[1], payload, r[3], r[4])
                if out is None:
                    part = f"{root}/_writing-{uuid.uuid4().hex}"
                    out = [fs.open_output_stream(part), part, 0]
                out[0].write(member)
                out[2] += len(member)
                if out[2] >= file_bytes:
                    close()
        close()
        if names:
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in names]),
                                              pa.array([s for _, s in names], pa.int64())],
                                             names=["file", "size"])

    return stored(pages.select("page_id", "url", "html", "refers_to", "revisit")
                  .mapInArrow(run, "file string, size bigint"), "warc-manifest")


def splits(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, start, end) byte ranges, dealt evenly over tasks."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)),
                        F.lit(range_bytes).cast("bigint"))
    ranges = manifest.select("file", "size", F.explode(starts).alias("start")).select(
        "file", "start", F.least(F.col("start") + range_bytes, F.col("size")).alias("end"))
    return ranges.repartition(max(1, ranges.count()), "file", "start")


class Window:
    """Bytes of a file from a position on, fetched piece by piece."""

    def __init__(self, file, start: int, size: int):
        self.file, self.base, self.size, self.data = file, start, size, bytearray()

    def upto(self, end: int) -> bool:
        """Hold bytes up to ``end``; False if the file ends before."""
        while self.base + len(self.data) < end:
            at = self.base + len(self.data)
            got = self.file.read_at(min(FETCH, self.size - at), at) if at < self.size else b""
            if not got:
                return False
            self.data += got
        return True

    def drop(self, before: int) -> None:
        if before > self.base:
            del self.data[:before - self.base]
            self.base = before


def inflate(window: Window, at: int) -> tuple[bytes, int] | None:
    """Plain bytes and end position of the member at ``at``; None if none is there."""
    z, parts, pos = zlib.decompressobj(31), [], at
    opened = False
    while not z.eof:
        window.upto(pos + 1 if pos > at else at + 64)
        piece = bytes(window.data[pos - window.base:pos - window.base + FETCH])
        if not piece:
            return None
        try:
            plain = z.decompress(piece)
        except zlib.error:
            return None
        pos += len(piece)
        parts.append(plain)
        if not opened:
            head = b"".join(parts)[:len(VERSION)]
            if not VERSION.startswith(head):
                return None
            opened = len(head) == len(VERSION)
    return (b"".join(parts), pos - len(z.unused_data)) if opened else None


def records_in(file, start: int, end: int, size: int) -> Iterator[bytes]:
    """Plain records whose member starts in [start, end)."""
    window, at = Window(file, start, size), start
    while at < end:
        window.drop(at)
        found = window.data.find(MAGIC, at - window.base)
        while found < 0:
            held = window.base + len(window.data)
            if held >= end + len(MAGIC) or not window.upto(held + 1):
                return
            found = window.data.find(MAGIC, max(0, held - window.base - len(MAGIC)))
        at = window.base + found
        if at >= end:
            return
        got = inflate(window, at)
        if got is None:
            at += 1
        else:
            yield got[0]
            at = got[1]


def parse(plain: bytes) -> dict:
    """Headers, block and payload of a record."""
    head, _, rest = plain.partition(b"\r\n\r\n")
    headers = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    block = rest[:int(headers[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])
    return {"headers": headers, "payload": payload, "length": int(fields[b"Content-Length"])}


def _page(value: bytes | None) -> int | None:
    digits = (value or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(digits) if digits else None


def read(spark: SparkSession, manifest: DataFrame, path: str, with_payload: bool = False,
         range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of the archives; payloads on request.

    Sizes and digests of responses are those of the payload as read; a
    revisit has those that its headers name.
    """
    def run(batches) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name, start, end in zip(*(texts_of(batch, c) for c in ("file", "start", "end"))):
                with fs.open_input_file(f"{root}/{name}") as file:
                    rows = []
                    for plain in records_in(file, start, end, file.size()):
                        r = parse(plain)
                        h = r["headers"]
                        kind = h[b"WARC-Type"].decode()
                        digest = h[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
                        if kind == "response" and (payload_digest(r["payload"]) != digest
                                                   or len(r["payload"]) != r["length"]):
                            raise ValueError(f"damaged record in {name}")
                        rows.append((_page(h[b"WARC-Record-ID"]), h[b"WARC-Target-URI"].decode(), kind,
                                     r["length"], digest, _page(h.get(b"WARC-Refers-To")),
                                     r["payload"] if with_payload and kind == "response" else None))
                        if len(rows) >= 256:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    return splits(manifest, range_bytes).mapInArrow(
        run, "page_id bigint, url string, record_type string, payload_bytes bigint, "
             "payload_digest string, refers_to bigint, payload binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to, revisit: who refers to whom.

    Payloads are equal when length and SHA-256 are.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html") \
        .withColumn("_key", F.when(F.octet_length(html) >= least_bytes,
                                   F.concat(F.sha2(html, 256), F.octet_length(html).cast("string"))))
    groups = (rows.filter(F.col("_key").isNotNull()).groupBy("_key")
              .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") > 1).select(F.col("_key").alias("_group"), "refers_to"))
    joined = left_join_nonnull(rows, stored(groups, "warc-groups"), "_key", "_group")
    revisit = F.col("_group").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("refers_to")).alias("refers_to"),
                         revisit.alias("revisit"))


def op2(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, "llm-warc")
    manifest = write(with_revisits(pages), path)
    return read(spark, manifest, path).select("page_id", "payload_bytes", "payload_digest",
                                              "record_type", "refers_to")
