"""Operator 3: WARC archives and a reader that salvages damaged ones.

``write_archives`` turns pages into WARC 1.1 records, one gzip member each: a response with
the full payload, or a revisit that refers to the response with an equal payload.
``read_archives`` streams archives (gzip members or plain text) from any store that pyarrow
reaches and checks every record: version line, headers, content length, end of record, block
digest and payload digest. Where a check fails it searches on, byte by byte, for the next
gzip member or version line whose record passes all checks, goes on from there, and reports
the bytes in between as a quarantined gap. Nothing behind a damaged place is lost.

Tasks write an archive under a temporary name and then move it to a name that is fixed by
partition and number, so a retried task overwrites its own archives. A task holds one record
and one read buffer at a time.

Defined results: a null payload is an empty one; a null url has no target header; a page
without page_id is always a response; rows alike in page_id and payload are both responses
(the smallest page_id); empty tables write no archive and read back as empty; extra columns
are ignored.
"""
from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strivelake.llm.common import python_batches, stage
from strivelake.session import scratch_path

ARCHIVE_BYTES = 64 << 20       # an archive is closed once it holds this much
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20          # payload bytes per Arrow batch handed back to Spark
# The crawl time is not in the table; archives of equal pages are equal bytes.
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head + (payload if refers_to is None else b"")
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response",
              f"WARC-Payload-Digest: sha1:{digest32(payload)}",
              f"WARC-Block-Digest: sha1:{digest32(block)}", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` as gzip WARC archives into ``folder``; (archive, records, bytes) of each."""
    spark = pages.sparkSession
    python_batches(spark, rows=500)
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    slim = slim.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    first = (slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("digest", "first"))
    later = stage(slim.select("page_id", "digest").join(first, "digest")
                  .filter(F.col("page_id") > F.col("first"))
                  .select("page_id", "digest", F.col("first").alias("refers_to")).distinct(), "revisits")
    rows = slim.join(later.hint("shuffle_hash"), ["page_id", "digest"], "left").select(
        "page_id", "url", "html", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder if "://" in folder or ":" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        done, out, name, size, count = [], None, "", 0, 0

        def close() -> None:
            out.close()
            store.move(f"{root}/.{name}.{attempt}", f"{root}/{name}")
            done.append((name, count, size))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, count = f"part-{part:05d}-{len(done):05d}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/.{name}.{attempt}", compression=None)
                data = _member(record_bytes(row["page_id"], row["url"],
                                            row["html"].encode("utf-8", "surrogatepass"), row["refers_to"]))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({
            "archive": pa.array([f"{folder}/{d[0]}" for d in done], pa.string()),
            "records": pa.array([d[1] for d in done], pa.int64()),
            "bytes": pa.array([d[2] for d in done], pa.int64())})

    return stage(rows.mapInArrow(write, "archive string, records long, bytes long"), "archives")


class _Stream:
    """A forward window over an archive: bytes from ``base`` on, dropped once accounted for."""

    def __init__(self, source) -> None:
        self.source, self.base, self.data, self.ended = source, 0, bytearray(), False

    def get(self, start: int, length: int) -> bytes:
        while not self.ended and self.base + len(self.data) < start + length:
            chunk = self.source.read(READ_BYTES)
            self.ended = not chunk
            self.data += chunk
        return bytes(self.data[start - self.base:start - self.base + length])

    def drop(self, before: int) -> None:
        del self.data[:max(0, before - self.base)]
        self.base = max(self.base, before)


def _parse(take) -> tuple[dict, int]:
    """A checked record; ``take(start, length)`` gives its bytes. Raises ValueError."""
    head = b""
    while b"\r\n\r\n" not in head:
        more = take(len(head), 4096)
        if not more or len(head) > 1 << 20:
            raise ValueError("no end of headers")
        head += more
    head = head[:head.index(b"\r\n\r\n")]
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.\d+", first):
        raise ValueError("no version line")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        raise ValueError("headers incomplete")
    start, length = len(head) + 4, int(fields["content-length"])
    block = take(start, length)
    if len(block) < length:
        raise ValueError("block cut off")
    if take(start + length, 4) != b"\r\n\r\n":
        raise ValueError("no end of record")
    want = fields.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != digest32(block):
        raise ValueError("block digest differs")
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    kind = fields["warc-type"]
    want = fields.get("warc-payload-digest", "")
    digest = digest32(payload) if kind != "revisit" else want.removeprefix("sha1:")
    if kind != "revisit" and want.startswith("sha1:") and want[5:] != digest:
        raise ValueError("payload digest differs")
    return {"record_type": kind, "record_id": fields.get("warc-record-id", "").strip("<>"),
            "target_uri": fields.get("warc-target-uri"),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "payload": payload if kind != "revisit" else None, "payload_digest": digest}, start + length + 4


def _unpack(stream: _Stream, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at`` and its end. Raises ValueError."""
    unpacker, out, pos = zlib.decompressobj(31), [], at
    while not unpacker.eof:
        part = stream.get(pos, READ_BYTES)
        if not part:
            raise ValueError("member cut off")
        try:
            out.append(unpacker.decompress(part))
        except zlib.error:
            raise ValueError("member damaged") from None
        pos += len(part)
    return b"".join(out), pos - len(unpacker.unused_data)


def _rows_at(stream: _Stream, at: int, starts: tuple[bytes, ...]) -> tuple[list[dict], int]:
    """The record at ``at``, or what can be read of a member there, and its end."""
    start = stream.get(at, 7)
    if start[:3] == GZIP_MAGIC and GZIP_MAGIC in starts:
        whole, end = _unpack(stream, at)
        place = {"start": at, "end": end}
        try:
            record, used = _parse(lambda s, n: whole[s:s + n])
            if used == len(whole):
                return [{"kind": "record", **place, **record}], end
            failed = None
        except ValueError as reason:
            failed = reason
        # several records, or a damaged one before others: read on by version lines
        rows = list(salvage(io.BytesIO(whole), (VERSION,)))
        if failed and all(r["kind"] == "gap" for r in rows):
            raise failed
        for r in rows:
            if r["kind"] == "gap":
                r["reason"] = f"bytes {r['start']} to {r['end']} of a member: {r['reason']}"
            r.update(place)
        return rows, end
    if start == VERSION:
        record, used = _parse(lambda s, n: stream.get(at + s, n))
        return [{"kind": "record", "start": at, "end": at + used, **record}], at + used
    raise ValueError("neither a member nor a version line")


def _next_start(stream: _Stream, at: int, starts: tuple[bytes, ...]) -> int | None:
    """The next place at or behind ``at`` that may start a record."""
    while True:
        window = stream.get(at, READ_BYTES)
        if not window:
            return None
        found = [k for k in map(window.find, starts) if k >= 0]
        if found:
            return at + min(found)
        if len(window) < READ_BYTES:
            return None
        at += len(window) - len(VERSION) + 1


def salvage(source, starts: tuple[bytes, ...] = (GZIP_MAGIC, VERSION)) -> Iterator[dict]:
    """Records and gaps of an archive, in order; ``source`` has read(n).

    Records of one gzip member have the member's place; a damaged stretch inside a member
    that holds a valid record is a gap at that place, its bytes in the member named by the
    reason. A member is unpacked whole.
    """
    stream, at, gap, reason = _Stream(source), 0, None, ""
    while True:
        stream.drop(at if gap is None else max(gap, at - 1))
        if not stream.get(at, 1):
            break
        try:
            rows, end = _rows_at(stream, at, starts)
        except ValueError as failed:
            if gap is None:
                gap, reason = at, str(failed)
            jump = _next_start(stream, at + 1, starts)
            if jump is None:
                break
            at = jump
            continue
        if gap is not None:
            yield {"kind": "gap", "start": gap, "end": at, "reason": reason}
            gap = None
        yield from rows
        at = end
    if gap is not None:
        while chunk := stream.get(at, READ_BYTES):
            at += len(chunk)
            stream.drop(at)
        yield {"kind": "gap", "start": gap, "end": at, "reason": reason}


READ_SCHEMA = ("archive string, kind string, start long, end long, reason string, record_type string, "
               "record_id string, target_uri string, refers_to string, payload binary, "
               "payload_digest string, payload_bytes long")
_ARROW = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                    for n, t in (x.split() for x in READ_SCHEMA.split(", "))])


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, name = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
            with store.open_input_stream(name, compression=None) as source:
                for row in salvage(source):
                    payload = row.get("payload")
                    row |= {"archive": path, "payload_bytes": None if payload is None else len(payload)}
                    held.append(row)
                    size += len(payload or b"")
                    if size >= BATCH_BYTES or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def read_archives(archives: DataFrame) -> DataFrame:
    """Records and gaps of the archives listed in column ``archive`` (kind: record or gap).

    A gap row has the first and the last-plus-one byte that no valid record covers, and why
    reading failed at its start.
    """
    python_batches(archives.sparkSession, rows=500)
    # a list of paths is tiny: without a number of its own AQE would give it to one task
    tasks = max(1, archives.count())
    return (archives.select("archive").repartition(tasks, "archive")
            .mapInArrow(_read_batches, READ_SCHEMA))


def archive_list(spark: SparkSession, folder: str) -> DataFrame:
    """Column ``archive``: the files of a folder (their contents are not read here)."""
    return spark.read.format("binaryFile").load(folder).select(F.col("path").alias("archive"))


def round_trip(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write pages to archives and read them back: (records, gaps).

    records: page_id, payload_bytes, payload_digest, record_type, refers_to; the size of a
    revisit is that of the response it refers to.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    found = read_archives(write_archives(pages, folder))
    number = F.regexp_extract("record_id", r"^urn:page:(-?\d+)$", 1)
    rows = stage(found.select(
        "archive", "kind", "start", "end", "reason", "record_type", "payload_digest", "payload_bytes",
        F.when(number != "", number.cast("long")).alias("page_id"),
        F.regexp_extract("refers_to", r"^urn:page:(-?\d+)$", 1).cast("long").alias("refers_to")),
        "warc-read")
    records = rows.filter("kind = 'record'")
    origin = (records.filter("record_type = 'response' and page_id is not null")
              .select(F.col("page_id").alias("refers_to"), "payload_digest",
                      F.col("payload_bytes").alias("_bytes")).distinct())
    named = (records.join(origin, ["refers_to", "payload_digest"], "left")
             .select("page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
                     "payload_digest", "record_type", "refers_to"))
    return named, rows.filter("kind = 'gap'").select("archive", "start", "end", "reason")
