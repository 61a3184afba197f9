"""WARC archives through a chunked record table.

``chunks`` streams each payload as rows (record id, chunk number) of at most
``CHUNK`` bytes that carry the SHA-1 and the byte count of the payload so far;
the last chunk's are those of the whole payload.  The writer takes chunk rows
in order and streams them into one archive per task, a gzip member per
record; the reader streams members back into chunk rows.  Neither holds a
record in memory.  The manifest names the archives of successful task
attempts only.

Of records with equal payloads (SHA-1 and length) of ``min_bytes`` or more,
that with the smallest id is the response; the others are revisit records,
which carry the digest, the length and the response's id in their headers and
no payload.

Defined results: a null payload is empty; records with a null id are always
responses, never referred to, and are read back with a null id; rows that
repeat the smallest id with the same payload are responses, too; line breaks
in a URL are written as blanks, a null URL reads back as null; an empty table
writes no archive; other input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import python_tasks, partitions, store
from .tokenfile import _open

CHUNK = 256 << 10
#: Bytes of chunk rows that a task collects before it hands them on.
BATCH = 4 << 20
#: sha1 and n_bytes are of the payload up to the chunk's end, in bare base 32; whole_sha1 and total of all of it.
CHUNK_SCHEMA = ("id long, url string, record_type string, refers_to long, chunk_no int, data binary, "
                "sha1 string, n_bytes long, total long, whole_sha1 string, last boolean")
_FIELDS = ["id", "url", "record_type", "refers_to", "chunk_no", "data", "sha1", "n_bytes", "total", "whole_sha1", "last"]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[5] or b"") + 200
        if size >= BATCH:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _FIELDS)


def decide(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """The stored (id, sha1, total, refers_to) of the revisit records."""
    seen = store(pages.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha1(F.coalesce(F.col(payload_col), F.lit("")))).alias("sha1"),
                              F.octet_length(F.coalesce(F.col(payload_col), F.lit(""))).cast("long").alias("total")), "payloads")
    first = seen.filter(F.col("total") >= min_bytes).groupBy("sha1", "total").agg(F.min("id").alias("refers_to"))
    # only payloads that more than one id has are shuffled on to the pages
    return store(seen.join(first, ["sha1", "total"]).filter("id > refers_to").select("id", "sha1", "total", "refers_to"), "revisits")


def chunks(pages: DataFrame, revisits: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """The chunk rows of every record; a revisit is one row without data."""
    python_tasks(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    marked = (rows.withColumn("sha1", F.unhex(F.sha1("payload")))
              .join(revisits.select("id", "sha1", "total", "refers_to").distinct(), ["id", "sha1"], "left")
              .select("id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "sha1", "total", "refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for i in range(b.num_rows):
                    key, url, data, sha1, total, refers = (b.column(k)[i] for k in range(6))
                    key, url = key.as_py(), url.as_py()
                    if refers.is_valid:
                        yield key, url, "revisit", refers.as_py(), 0, None, b32(sha1.as_py()), total.as_py(), total.as_py(), b32(sha1.as_py()), True
                        continue
                    view, so_far = memoryview(data.as_buffer()), hashlib.sha1()
                    for no, at in enumerate(range(0, max(len(view), 1), CHUNK)):
                        part = view[at:at + CHUNK]
                        so_far.update(part)
                        yield (key, url, "response", None, no, bytes(part), b32(so_far.digest()), at + len(part), len(view), b32(sha1.as_py()),
                               at + CHUNK >= len(view))

        yield from _batches(rows())

    return marked.mapInArrow(run, CHUNK_SCHEMA)


def write(chunk_rows: DataFrame, folder: str) -> DataFrame:
    """Stream chunk rows (each record's in order within its partition) into archives in
    ``folder`` on shared storage; the stored manifest (file, n_records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filesystem, top = _open(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        out, gz, n = None, None, 0
        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    filesystem.create_dir(top, recursive=True)
                    out = filesystem.open_output_stream(f"{top}/{name}", compression=None)
                if r["chunk_no"] == 0:
                    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
                    out.write(gz.compress(_head(r)))
                    n += 1
                if r["data"]:
                    out.write(gz.compress(r["data"]))
                if r["last"]:
                    out.write(gz.compress(b"\r\n\r\n") + gz.flush())
        if out is not None:
            out.close()
            yield pa.record_batch([pa.array([name]), pa.array([n], pa.int64())], ["file", "n_records"])

    return store(chunk_rows.mapInArrow(run, "file string, n_records long"), "warc-manifest")


def _head(r: dict) -> bytes:
    """A record's header block; its content is the payload alone."""
    named = "" if r["id"] is None else r["id"]
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <urn:page:{named}>",
             f"WARC-Payload-Digest: sha1:{r['whole_sha1']}", f"X-Payload-Length: {r['total']}",
             "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: text/html"]
    if r["url"] is not None:
        lines.append("WARC-Target-URI: " + " ".join(r["url"].splitlines()))
    if r["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <urn:page:{r['refers_to']}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {r['total'] if r['record_type'] == 'response' else 0}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _members(stream) -> Iterator[bytes | None]:
    """Decompressed pieces of each gzip member, then None at its end."""
    rest = b""
    while True:
        inflate, begun, piece = zlib.decompressobj(31), False, b""
        while not inflate.eof:
            # after a full piece there may be more output without new input
            data = inflate.unconsumed_tail or rest or (b"" if len(piece) == CHUNK else stream.read(CHUNK))
            rest = b""
            if not data and len(piece) < CHUNK:
                if begun:
                    raise ValueError("the archive ends inside a record")
                return
            begun = True
            piece = inflate.decompress(data, CHUNK)
            if piece:
                yield piece
        rest = inflate.unused_data
        yield None


def _records(stream) -> Iterator[tuple]:
    """The chunk rows of an archive."""
    held, head, so_far, total, done, no = b"", None, None, 0, 0, 0
    for piece in _members(stream):
        if piece is None:
            if head is None or done != int(head["content-length"]):
                raise ValueError("a record's length differs from its header's")
            held, head = b"", None
            continue
        held += piece
        if head is None:
            if (end := held.find(b"\r\n\r\n")) < 0:
                continue
            head = {k.lower(): v for k, v in (x.split(": ", 1) for x in held[:end].decode().split("\r\n")[1:])}
            held, so_far, done, no = held[end + 4:], hashlib.sha1(), 0, 0
            key = head["warc-record-id"][len("<urn:page:"):-1]
            head["id"] = int(key) if key else None
            total = int(head["content-length"])
            if head["warc-type"] == "revisit":
                sha1 = head["warc-payload-digest"].partition(":")[2]
                n = int(head["x-payload-length"])
                yield (head["id"], head.get("warc-target-uri"), "revisit", int(head["warc-refers-to"][len("<urn:page:"):-1]), 0, None, sha1, n, n, sha1, True)
                continue
            if total == 0:
                yield _row(head, 0, b"", so_far, 0)
                continue
        while head["warc-type"] != "revisit" and done < total and (len(held) >= CHUNK or len(held) >= total - done):
            part, held = held[:min(CHUNK, total - done)], held[min(CHUNK, total - done):]
            so_far.update(part)
            done += len(part)
            yield _row(head, no, part, so_far, done)
            no += 1


def _row(head: dict, no: int, part: bytes, so_far, done: int) -> tuple:
    total = int(head["content-length"])
    whole, sha1 = head["warc-payload-digest"].partition(":")[2], b32(so_far.digest())
    if done == total and sha1 != whole:
        raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
    return head["id"], head.get("warc-target-uri"), "response", None, no, part, sha1, done, total, whole, done == total


def read(spark: SparkSession, folder: str, manifest: DataFrame, data: bool = True) -> DataFrame:
    """Chunk rows of the archives; without ``data`` their payload bytes stay in the readers."""
    files = manifest.select("file").repartitionByRange(partitions(spark), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for name in b.column(0).to_pylist():
                    filesystem, top = _open(folder)
                    with filesystem.open_input_stream(f"{top}/{name}", compression=None) as stream:
                        for r in _records(stream):
                            yield r if data else (*r[:5], None, *r[6:])

        yield from _batches(rows())

    return files.mapInArrow(run, CHUNK_SCHEMA)


def pages(chunk_rows: DataFrame, id_col: str = "page_id") -> DataFrame:
    """One row per record, from its last chunk: id, payload_bytes, payload_digest, record_type, refers_to."""
    return chunk_rows.filter("last").select(F.col("id").alias(id_col), F.col("n_bytes").alias("payload_bytes"),
                                            F.col("sha1").alias("payload_digest"), "record_type", "refers_to")
