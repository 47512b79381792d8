"""Listings with a directory: every page, what a page opens, and the last page; the index map read entry by entry."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_dir
from tidemark.sources import listing, readers


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_dir(spark, "listing")
    df = spark.range(2000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id"), F.lit(1).alias("place")).drop("place")
    listing.write_listing(df, path, [F.desc("k"), F.asc("id")], ranges=16)
    want = sorted(((str(i % 7), i) for i in range(2000)), key=lambda r: (-int(r[0]), r[1]))
    return df, path, want


def test_every_page(table):
    df, path, want = table
    for number, size in ((1, 50), (2, 50), (7, 137), (40, 50), (41, 50), (1, 5000), (3, 999), (0, 10)):
        got = [(r["k"], r["id"]) for r in listing.listing_page(df, path, number, size).collect()]
        start = (max(1, number) - 1) * size
        assert got == want[start : start + size], (number, size)
    assert [r["id"] for r in listing.listing_page(df, path, 99, 300, within=True).collect()] == [i for _, i in want[1800:]]
    assert [r["id"] for r in listing.listing_page(df, path, 1, 500, max_size=20).collect()] == [i for _, i in want[:20]]


def test_a_page_opens_one_or_two_ranges(table):
    df, path, _ = table
    for number in (1, 20, 40):
        found = listing.listing_page(df, path, number, 50)
        assert 1 <= len(found.inputFiles()) <= 2
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Limit" not in plan and "Offset" not in plan and "GreaterThanOrEqual(place" in found._jdf.queryExecution().toString()


def test_totals_and_an_empty_listing(spark, table):
    df, path, _ = table
    assert tuple(listing.listing_info(spark, path, 300).first()) == (2000, 7)
    empty = scratch_dir(spark, "listing")
    listing.write_listing(df.limit(0), empty, [F.col("id")])
    assert listing.listing_page(df, empty, 3, 10, within=True).count() == 0 and tuple(listing.listing_info(spark, empty, 10).first()) == (0, 1)


INDEX = {f"Bug_Tracker a{i}": f"{i:064x}" for i in range(500)} | {'Ünï "quoted" b1': "x\\y", "T c__2": "h"}


def imported(spark, path):
    return {f"{r['type_key']} {r['id']}": r["metadata_hash"] for r in readers.hash_index_entries(spark, path).collect()}


def test_a_map_is_read_entry_by_entry(spark, tmp_path):
    for name, style in (("a.json", {"separators": (",", ":")}), ("b.json", {}), ("c.json", {"indent": 2})):
        (tmp_path / name).write_text(json.dumps(INDEX, **style))
        assert imported(spark, str(tmp_path / name)) == INDEX, name
        assert imported(spark, str(tmp_path / name)) == {f"{r['type_key']} {r['id']}": r["metadata_hash"] for r in readers.hash_index_file(spark, str(tmp_path / name)).collect()}
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        json.dump(INDEX, f)
    assert imported(spark, str(tmp_path / "d.json.gz")) == INDEX
    (tmp_path / "e.json").write_text("{}")
    assert imported(spark, str(tmp_path / "e.json")) == {}


def test_one_map_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(INDEX, separators=(",", ":")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = readers.hash_index_entries(spark, str(tmp_path / "a.json"))
        assert df.rdd.getNumPartitions() > 5 and imported(spark, str(tmp_path / "a.json")) == INDEX
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_what_is_no_map_of_texts_is_refused(spark, tmp_path):
    for i, text in enumerate(('{"T a":"x\\",y","T b":"z"}', '{"T a":1,"T b":"x"}', '["a","b"]')):
        (tmp_path / f"{i}.json").write_text(text)
        with pytest.raises(Exception, match="not an entry"):
            imported(spark, str(tmp_path / f"{i}.json"))


def test_written_entries_come_back(spark):
    path = scratch_dir(spark, "map")
    rows = [("T", "a 1", "h1"), ('Q"uo', "b\\2", "h\n2"), ("Ü", "ж", "h3")]
    readers.write_hash_index_entries(spark.createDataFrame(rows, "type_key string, id string, metadata_hash string").repartition(2), path)
    assert imported(spark, path) == {f"{t} {i}": h for t, i, h in rows}
