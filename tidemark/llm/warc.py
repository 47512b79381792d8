"""WARC archives: a writer of one gzip member per record, and a sequential reader with digest verification.

Each task writes archives of its own under fresh names and reports them in a manifest, a Parquet table that Spark commits. Only archives of the
manifest count, so a task that is lost or runs twice leaves at most files that nobody reads. The reader goes through an archive in chunks:
one inflater per gzip member, a header up to the empty line, exactly Content-Length bytes of block, and the two line ends that close a record.
Digests are computed while the bytes pass.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, query, stored, table
from tidemark.session import scratch_dir

ARCHIVE_BYTES = 256 << 20  # an archive that has reached this size is closed and the next one begun
CHUNK = 1 << 16  # bytes read, and inflated, at once
HEADER_BYTES = 1 << 20  # longest WARC or HTTP header; beyond it a record counts as malformed

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORD = (
    "archive string, position long, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)


def sha1_name(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def one_line(value: str) -> str:
    """A header value: line ends, other control characters and percent signs are percent-encoded, so any text comes back."""
    return "".join(f"%{ord(c):02X}" if c == "%" or ord(c) < 32 or ord(c) == 127 else c for c in value)


def plain(value: str) -> str:
    out = value.split("%")
    return out[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in out[1:])


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """A gzip member with one response or revisit record."""
    digest = sha1_name(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_name(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n"), packer.compress(block), packer.compress(b"\r\n\r\n"), packer.flush()])


def responses(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` (page_id, url, payload) with refers_to: for a payload that several records share, the largest page_id; null if it has no id.

    Payloads of fewer than ``least`` bytes refer to nothing. The narrow pairs (digest, largest id) are combined before they are shuffled; pages
    move once, in a join that AQE may split, so a payload that a third of the pages share does not stay in one task.
    """
    keyed = pages.withColumn("key", F.sha2("payload", 256))
    shared = stored(
        keyed.filter(F.length("payload") >= least).groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL").select("key", "refers_to"), "payloads")
    return keyed.join(shared, "key", "left").drop("key")


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write a record per row of ``pages`` (page_id long, url string, html string) under ``folder``; returns the manifest (archive, records, bytes).

    The payload is the html in UTF-8; a null html is empty, a null url or page_id is left out of the header. Of records with equal payloads of at least
    ``least`` bytes, that with the largest page_id is the response and the others revisit it; repeated rows of that page_id are responses all,
    a null id is the smallest, and rows with null ids only are all responses. Other columns of ``pages`` are not read. A page is held whole, once.
    An empty table writes nothing. ``folder`` is a local path that all executors share, or a URI that pyarrow.fs can open.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        out, name, done, records = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [records], "bytes": [done]})

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i) for i in range(4))):
                own, to = page_id.as_py(), refers_to.as_py()
                if out is None:
                    name, done, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                member = record(own, url.as_py(), html.as_buffer().to_pybytes(), to, to is not None and own != to, date)
                out.write(member)
                done, records = done + len(member), records + 1
                if done >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    made = responses(rows, least).select("page_id", "url", "payload", "refers_to").mapInArrow(write, "archive string, records long, bytes long")
    return stored(made, "manifest")


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a local folder or a URI."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    store, base = fs.FileSystem.from_uri(folder)
    return store, base.rstrip("/")


class Malformed(Exception):
    pass


class Members:
    """The gzip members of a stream one after the other, inflated piece by piece."""

    def __init__(self, stream):
        self.stream, self.raw, self.ready, self.unpacker = stream, b"", b"", None

    def next_member(self) -> bool:
        """Begin the next member; False at the end of the stream."""
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        self.ready, self.unpacker = b"", zlib.decompressobj(31) if self.raw else None
        return bool(self.raw)

    def more(self) -> bool:
        """Inflate at most CHUNK more bytes of this member; False at its end."""
        while not self.unpacker.eof:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    raise Malformed("truncated gzip member")
            try:
                got = self.unpacker.decompress(self.raw, CHUNK)
            except zlib.error as e:
                raise Malformed(f"broken gzip member: {e}") from None
            self.raw = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            if got:
                self.ready += got
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """What comes before ``mark``; the mark is taken too."""
        while (at := self.ready.find(mark)) < 0:
            if len(self.ready) > HEADER_BYTES or not self.more():
                raise Malformed("header without an end")
        found, self.ready = self.ready[:at], self.ready[at + len(mark) :]
        return found

    def pieces(self, size: int) -> Iterator[bytes]:
        """Exactly ``size`` bytes in pieces."""
        while size:
            if not self.ready and not self.more():
                raise Malformed("record shorter than its Content-Length")
            piece, self.ready = self.ready[:size], self.ready[size:]
            size -= len(piece)
            yield piece

    def rest(self) -> bytes:
        """All that is left of this member, at most a few bytes in a sound archive."""
        while len(self.ready) <= 4 and self.more():
            pass
        return self.ready


def fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Malformed("header line without a colon")
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def number(value: str | None) -> int:
    if value is None or not value.isascii() or not value.isdigit() or len(value) > 18:
        raise Malformed("length that is not a number")
    return int(value)


def read_record(members: Members, keep: bool) -> dict:
    """The record of the member just begun. A wrong digest is told as a problem, wrong framing raises Malformed."""
    head = members.until(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise Malformed("no WARC version")
    warc = fields(head)
    size = number(warc.get("content-length"))
    block, payload, length, held = hashlib.sha1(), hashlib.sha1(), 0, []
    http, inner = b"", None
    for piece in members.pieces(size):
        block.update(piece)
        if inner is None:
            http += piece
            inner, gap, piece = http.partition(b"\r\n\r\n")
            if not gap:
                if len(http) > HEADER_BYTES:
                    raise Malformed("HTTP header without an end")
                inner = None
                continue
        payload.update(piece)
        length += len(piece)
        if keep:
            held.append(piece)
    if members.rest() != b"\r\n\r\n":
        raise Malformed("record longer than its Content-Length")
    if inner is None:
        raise Malformed("HTTP header without an end")
    kind, told = warc.get("warc-type", ""), warc.get("warc-payload-digest", "").removeprefix("sha1:")
    said = number(fields(inner).get("content-length"))
    problem = None
    if warc.get("warc-block-digest", "").removeprefix("sha1:") != sha1_name(block.digest()):
        problem = "block digest differs"
    elif kind == "response" and told != sha1_name(payload.digest()):
        problem = "payload digest differs"
    elif kind == "response" and said != length:
        problem = "payload length differs"
    url = warc.get("warc-target-uri")
    return {
        "page_id": int(warc["x-page-id"]) if "x-page-id" in warc else None, "url": None if url is None else plain(url), "record_type": kind,
        "refers_to": int(warc["x-refers-to-page-id"]) if "x-refers-to-page-id" in warc else None,
        "payload_bytes": said, "payload_digest": told, "payload": b"".join(held) if keep and kind == "response" else None, "problem": problem,
    }


def records_of(stream, archive: str, keep: bool) -> Iterator[dict]:
    """Every record of one archive by position. Wrong framing ends the archive with a row that has the problem and no page."""
    members, position = Members(stream), 0
    try:
        while members.next_member():
            yield {"archive": archive, "position": position, **read_record(members, keep)}
            position += 1
    except (Malformed, ValueError) as e:
        yield {"archive": archive, "position": position, **dict.fromkeys(
            ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")), "problem": str(e) or "malformed"}


def read_archives(manifest: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """One row per record of the archives of ``manifest``: archive, position, page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload, problem.

    ``payload`` holds the bytes of responses if asked for; else a record is never whole in memory. payload_bytes is that of the full payload, of revisits
    too. ``problem`` is null for a sound record; a digest or length that differs is named there. Archives are dealt to tasks by name, and an archive is
    read by one task from its start to its end, as its records have no other index. No archives, no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        kinds = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in RECORD.split(", "))])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held, size = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for row in records_of(stream, name, payload):
                        held.append(row)
                        size += len(row["payload"] or b"")
                        if len(held) == 4096 or size > 1 << 23:
                            yield pa.RecordBatch.from_pylist(held, kinds)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, kinds)

    many = partitions(manifest.sparkSession)
    return manifest.select("archive").repartition(many, "archive").mapInArrow(read, RECORD)


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS x FROM pages
), h AS (
  SELECT page_id, strlen(x)::BIGINT AS n, sha1(x) AS d, max(page_id) OVER (PARTITION BY x) AS last FROM p
)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(d, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN last IS NULL OR page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS NULL OR page_id = last THEN NULL ELSE last END AS refers_to
FROM h
"""


@query("op11_warc", SQL)
def warc(spark, sf_dir):
    """All pages written as WARC records and read back; a record that does not verify stops the query."""
    folder = scratch_dir(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    read = read_archives(manifest, folder)
    sound = F.when(F.col("problem").isNull(), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("record: "), F.col("problem"))))
    return read.select("page_id", "payload_bytes", sound.alias("payload_digest"), "record_type", "refers_to")
