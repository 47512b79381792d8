"""Archives: exact round trips, revisits, odd rows, and archives that do not verify."""

import gzip
import hashlib
import io
import os
import zlib

import pyarrow as pa

from odd import both
from tidemark.llm import warc
from tidemark.session import scratch_dir

PAGES = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/y", "<p>two é</p>"), (7, None, "<p>one</p>"), (5, "http://a.example/z\r\nWARC-Type: 100%", "<p>one</p>"),
    (3, "", None), (4, "u", ""), (None, "v", "<p>one</p>"), (None, "v", None), (6, "w", "x" * 3_000_000 + "\r\n\r\nWARC/1.1\r\n\r\n"), (8, "s", "solo \x00\r\n\r\n"),
]


def frame(spark, rows=PAGES, extra=True):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "1 AS refers_to", "'k' AS key", "2 AS payload") if extra else df


def test_round_trip(spark):
    folder = scratch_dir(spark, "warc")
    manifest = warc.write_archives(frame(spark), folder, archive_bytes=200)
    assert manifest.count() > 2 and manifest.agg({"records": "sum"}).first()[0] == len(PAGES)
    rows = warc.read_archives(manifest, folder, payload=True).collect()
    assert not [r for r in rows if r["problem"]] and len(rows) == len(PAGES)
    want = {}
    for page_id, url, html in PAGES:
        last = max((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        want[(page_id, url, len((html or "").encode()))] = ("revisit", last) if last is not None and page_id != last else ("response", None)
    got = {(r["page_id"], r["url"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in rows}
    assert got == want
    for r in rows:
        if r["record_type"] == "response":
            assert (r["page_id"], r["url"], bytes(r["payload"]).decode()) in [(p, u, h or "") for p, u, h in PAGES]


def test_least_payload(spark):
    folder = scratch_dir(spark, "warc")
    rows = warc.read_archives(warc.write_archives(frame(spark), folder, least=1), folder).collect()
    assert {r["record_type"] for r in rows if r["payload_bytes"] == 0} == {"response"}
    assert sum(r["record_type"] == "revisit" for r in rows) == 3


def test_repeated_rows_of_the_largest_id_are_responses(spark):
    folder = scratch_dir(spark, "warc")
    rows = warc.read_archives(warc.write_archives(frame(spark, [(1, "u", "t"), (2, "u", "t"), (2, "u", "t")], False), folder), folder).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in rows) == [(1, "revisit", 2), (2, "response", None), (2, "response", None)]


def test_empty_table(spark):
    folder = scratch_dir(spark, "warc")
    manifest = warc.write_archives(frame(spark).limit(0), folder)
    assert manifest.count() == 0 and warc.read_archives(manifest, folder).count() == 0


def test_members_are_plain_gzip(spark):
    """Any gzip reader sees the records one after the other, each with its length."""
    folder = scratch_dir(spark, "warc")
    warc.write_archives(frame(spark).coalesce(1), folder).count()
    base = folder.removeprefix("file://")
    text = b"".join(gzip.decompress(open(f"{base}/{f}", "rb").read()) for f in sorted(os.listdir(base)))
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES)


def parsed(data: bytes, keep=False):
    return list(warc.records_of(io.BytesIO(data), "a", keep))


def test_broken_archives():
    one, two = warc.record(1, "u", b"hello" * 40, None, False), warc.record(2, "u", b"there", 9, True)
    assert [r["problem"] for r in parsed(one + two)] == [None, None]
    assert [r["payload_bytes"] for r in parsed(one + two)] == [200, 5]
    assert parsed(two)[0]["refers_to"] == 9 and parsed(two)[0]["payload_digest"] == warc.sha1_name(hashlib.sha1(b"there").digest())
    cut = parsed(one + two[:-9])
    assert [bool(r["problem"]) for r in cut] == [False, True] and cut[1]["page_id"] is None
    assert parsed(one + b"junk")[1]["problem"].startswith("broken")

    def repacked(old: bytes, new: bytes) -> bytes:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        return packer.compress(gzip.decompress(one).replace(old, new)) + packer.flush()

    assert parsed(repacked(b"hellohello", b"hellohellO"))[0]["problem"] == "block digest differs"
    digest = warc.sha1_name(hashlib.sha1(b"hello" * 40).digest()).encode()
    assert parsed(repacked(b"Payload-Digest: sha1:" + digest, b"Payload-Digest: sha1:" + b"A" * 32))[0]["problem"] == "payload digest differs"
    size = len(gzip.decompress(one).split(b"\r\n\r\n", 1)[1]) - 4
    for wrong, problem in ((size - 1, "longer"), (size + 5, "shorter"), ("x", "not a number")):
        assert problem in parsed(repacked(f"Content-Length: {size}".encode(), f"Content-Length: {wrong}".encode()))[0]["problem"]
    assert "version" in parsed(repacked(b"WARC/1.1", b"HTTP/1.1"))[0]["problem"]


def test_odd_rows_against_sql(spark, tmp_path):
    rows = [r for r in PAGES]
    got, want = both(spark, tmp_path, "op11_warc", "pages", pa.table({
        "page_id": pa.array([r[0] for r in rows], pa.int64()), "url": [r[1] for r in rows], "html": [r[2] for r in rows], "record_type": [1] * len(rows)}))
    assert got == want
