"""WARC archives: writing them, and reading them by byte ranges.

Each record is a gzip member of its own, so an archive can be read from any byte.
A reading task gets a range, scans it for the gzip magic, takes a candidate for a
member only if it inflates to a WARC header, and owns the records that start in
its range: it reads the last one to its end beyond the range, and leaves a record
that began earlier to the range before.  After a record, the next is expected
where it ended; a damaged one is skipped by scanning on.

Payloads that equal another page's are written as revisits of it.  Pages are
grouped by digest on narrow rows; texts are not shuffled if the list of revisits
is small enough to be broadcast.

Tasks reach archives through ``pyarrow.fs`` by the folder's URI (local or shared
mounts, and the object stores and HDFS for which it has clients).  A file's name
is new for every attempt, and the manifest that Spark writes lists only the files
of attempts that succeeded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import bounded_batches, broadcast_if_small, col, stored
from matchlake.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
MIN_REVISIT = 1000  # bytes; smaller payloads are always written
SPLIT_BYTES = 16 << 20
ARCHIVE_BYTES = 1 << 30
BROADCAST_REVISITS = 200_000  # rows of some 70 bytes: 14 MB
CHUNK = 1 << 18
HEADER_BYTES = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One gzip member.  A revisit has the HTTP header of its response, with the
    length of the full payload, but no body."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>", f"WARC-Profile: {PROFILE}"]
    block = http if revisit else http + payload
    head.append(f"Content-Length: {len(block)}")
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (x.partition(b":") for x in lines.split(b"\r\n")[1:])
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def _member(f: pa.NativeFile, at: int) -> tuple[bytes, bytes, int] | None:
    """Header, block and end of the record whose member starts at ``at``, or None
    if there is none or it is damaged."""
    z, out, place, head, left = zlib.decompressobj(31), bytearray(), at, None, None
    try:
        while not z.eof:
            f.seek(place)
            chunk = f.read(CHUNK)
            if not chunk:
                return None
            place += len(chunk)
            out += z.decompress(chunk)
            if not out.startswith(b"WARC/"[:len(out)]):
                return None
            if head is None:
                end = out.find(b"\r\n\r\n")
                if end < 0:
                    if len(out) > HEADER_BYTES:
                        return None
                    continue
                head, left = bytes(out[:end]), int(_fields(out[:end])["content-length"])
        if head is None or len(out) != len(head) + 4 + left + 4:
            return None
        return head, bytes(out[len(head) + 4:len(head) + 4 + left]), place - len(z.unused_data)
    except (zlib.error, ValueError, KeyError):
        return None


def records_in(f: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(offset, header, block) of the records that start in [start, end)."""
    at, buffer, base = start, b"", start
    while at < end:
        if not base <= at <= base + len(buffer) - len(MAGIC):
            f.seek(at)
            buffer, base = f.read(CHUNK + len(MAGIC) - 1), at
            if len(buffer) < len(MAGIC):
                return
        found = buffer.find(MAGIC, at - base)
        if found < 0:
            at = base + len(buffer) - len(MAGIC) + 1
            continue
        at = base + found
        if at >= end:
            return
        got = _member(f, at)
        if got is None:
            at += 1
        else:
            yield at, got[0], got[1]
            at = got[2]


def _urn(value: str | None) -> int | None:
    tail = (value or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail else None


_RECORD = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.int64()),
                     ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
RECORD_DDL = "file string, offset long, page_id long, record_type string, url string, refers_to long, digest string, payload_bytes long, payload binary"


def _row(file: str, offset: int, head: bytes, block: bytes) -> tuple:
    h = _fields(head)
    http, _, body = block.partition(b"\r\n\r\n")
    revisit = h["warc-type"] == "revisit"
    declared = int(_fields(http)["content-length"])
    digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
    return (file, offset, _urn(h["warc-record-id"]), h["warc-type"], h.get("warc-target-uri"), _urn(h.get("warc-refers-to")) if revisit else None, digest, declared, None if revisit else body)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        for r in batch.to_pylist():
            fs, path = file_system(r["file"])
            with fs.open_input_file(path) as f:
                for x in records_in(f, r["start"], r["end"]):
                    rows.append(_row(r["file"], *x))
                    size += len(x[2])
                    if size > CHUNK * 32:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RECORD.types, strict=True)], schema=_RECORD)
                        rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RECORD.types, strict=True)], schema=_RECORD)


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of ``files(file, bytes)``: file, offset, page_id, record_type,
    url, refers_to, digest (hex, as declared), payload_bytes (of the full payload)
    and payload (NULL for revisits)."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.filter("bytes > 0").select("file", starts.alias("start"), "bytes")
    ranges = stored(ranges.select("file", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end")), "ranges")
    tasks = max(1, ranges.count())
    return ranges.repartitionByRange(tasks, "file", "start").mapInArrow(_read, RECORD_DDL)


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        task, attempt, out, name, done = TaskContext.get().partitionId(), uuid.uuid4().hex, None, "", []
        size = count = files = 0
        try:
            for batch in batches:
                for r in batch.to_pylist():
                    if out is None:
                        name, size, count, files = f"part-{task:05d}-{attempt}-{files:03d}.warc.gz", 0, 0, files + 1
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    data = record(r["page_id"], r["url"], r["payload"] or b"", r["refers_to"], r["revisit"])
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= archive_bytes:
                        out.close()
                        out = done.append((f"{folder}/{name}", size, count))
        finally:
            if out is not None:
                out.close()
                done.append((f"{folder}/{name}", size, count))
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "bytes", "records"), x, strict=True)) for x in done], pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return run


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", *, min_revisit: int = MIN_REVISIT,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record for each row of ``pages`` below ``folder`` (which must exist)
    and returns the manifest ``(file, bytes, records)``.

    Of the rows with equal payloads of at least ``min_revisit`` bytes the one with
    the largest id is written in full, and the others as revisits of it.  Defined
    results: a NULL payload is empty; a NULL id is smaller than any other, and
    stays NULL in the record; rows that repeat the largest id are each written in
    full; a NULL URL is left out.  Extra columns are not written.  An empty table
    writes no archive.
    """
    bounded_batches(pages)
    rows = pages.select(col(page_id).cast("long").alias("page_id"), col(url).cast("string").alias("url"), F.coalesce(col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"sha": F.sha1("payload"), "h": F.xxhash64("payload"), "n": F.octet_length("payload")})
    key = ["sha", "h", "n"]
    narrow = stored(rows.select("page_id", *key).filter(F.col("n") >= min_revisit), "digests")
    groups = narrow.groupBy(*key).agg(F.max("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    again = narrow.join(groups, key).filter(~F.col("page_id").eqNullSafe(F.col("first")))
    again = stored(again.select(F.col("page_id").alias("id"), *key, F.col("first").alias("refers_to"), F.lit(True).alias("revisit")).distinct(), "revisits")
    same = [rows[k].eqNullSafe(again[k]) for k in key]
    joined = rows.join(broadcast_if_small(again, BROADCAST_REVISITS), [rows["page_id"].eqNullSafe(again["id"]), *same], "left")
    joined = joined.select("page_id", "url", "payload", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))
    return stored(joined.mapInArrow(_writer(folder, archive_bytes), "file string, bytes long, records long"), "manifest")


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives below the shared checkpoint folder."""
    uri = scratch_dir(spark, f"warc-{uuid.uuid4().hex}")
    fs, path = file_system(uri)
    fs.create_dir(path, recursive=True)
    return uri
