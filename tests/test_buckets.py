"""Bucketed state tables: what a commit rewrites, what a diff reads, retries, and digests."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import KEY, diff
from tidemark.session import scratch_dir
from tidemark.sources import buckets

COLUMNS = "type_key string, id string, metadata_hash string, content_hash string, modified_ms long, body_error string"
STAMPS = ["first_seen_run", "last_seen_run", "last_changed_run"]


def rows(n=2000, seed=1):
    r = random.Random(seed)
    return [(f"t{i % 3}", f"a{i}", f"m{r.randrange(10**9)}", f"c{r.randrange(10**9)}", i, None) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def stamped(df):
    for c in STAMPS:
        df = df.withColumn(c, F.lit("r0"))
    return df.withColumn("first_removed_run", F.lit(None).cast("string"))


def folders(path, commit):
    base = f"{path.removeprefix('file://')}/data/commit={commit}"
    return sorted(int(d.partition("=")[2]) for d in os.listdir(base) if d.startswith("bucket="))


def collected(df):
    return sorted(tuple(r) for r in df.select("type_key", "id", "metadata_hash", "content_hash", "modified_ms", "body_error").collect())


@pytest.fixture
def table(spark):
    path = scratch_dir(spark, "state")
    df = frame(spark, rows())
    buckets.create(df, path, "r1", buckets=64)
    return path, df


def test_a_commit_rewrites_touched_buckets_only(spark, table):
    path, df = table
    old = rows()
    new = [(*r[:3], "new", *r[4:]) for r in old[:10]] + [("t9", f"z{i}", "m", "c", 0, "e") for i in range(2)]
    buckets.upsert(path, "r1", "r2", frame(spark, new), buckets=64)
    touched = {r[0] for r in frame(spark, new).select(buckets.bucket_of(64)).collect()}
    assert set(folders(path, "r2")) == touched and len(touched) <= 12 < len(folders(path, "r1"))
    assert collected(buckets.read(df, path, "r2")) == sorted(new + old[10:], key=lambda r: r[:2])
    assert collected(buckets.read(df, path, "r1")) == sorted(old)
    files = buckets.read(df, path, "r2").inputFiles()
    assert {f.split("/bucket=")[1].split("/")[0] for f in files if "commit=r2" in f} == {str(b) for b in touched}
    # The tree kept with the commit is that of its rows.
    again = scratch_dir(spark, "state")
    buckets.create(buckets.read(df, path, "r2").drop("bucket"), again, "x", buckets=64)
    have, want = (sorted(tuple(r) for r in buckets.pointers(spark, p, c).select("bucket", "type_key", *buckets.DIGEST).collect()) for p, c in ((path, "r2"), (again, "x")))
    assert have == want


def test_a_commit_without_pointers_does_not_exist_and_can_be_run_again(spark, table):
    path, df = table
    change = frame(spark, [("t0", "a0", "changed", "c", 1, None)])
    for _ in range(2):
        buckets.upsert(path, "r1", "r2", change, buckets=64)
    assert collected(buckets.read(df, path, "r2").filter("id = 'a0'")) == [("t0", "a0", "changed", "c", 1, None)]
    # Data of an attempt that died before its pointers were written, with other rows in it.
    frame(spark, [("t0", "a0", "half", "c", 1, None)]).withColumn("bucket", buckets.bucket_of(64)).write.partitionBy("bucket").parquet(f"{path}/data/commit=r3")
    assert collected(buckets.read(df, path, "r2").filter("id = 'a0'"))[0][2] == "changed"
    buckets.upsert(path, "r2", "r3", frame(spark, [("t0", "a0", "whole", "c", 1, None)]), buckets=64)
    assert collected(buckets.read(df, path, "r3").filter("id = 'a0'"))[0][2] == "whole" and buckets.read(df, path, "r3").count() == 2000


def test_deletions_and_nothing_to_do(spark, table):
    path, df = table
    buckets.upsert(path, "r1", "r2", frame(spark, []), frame(spark, rows()[:500]), buckets=64)
    assert collected(buckets.read(df, path, "r2")) == sorted(rows()[500:])
    buckets.upsert(path, "r2", "r3", frame(spark, []), buckets=64)
    assert folders(path, "r3") == [] and buckets.read(df, path, "r3").count() == 1500
    buckets.upsert(path, "r3", "r4", frame(spark, []), df, buckets=64)
    assert buckets.read(df, path, "r4").count() == 0 and buckets.pointers(spark, path, "r4").count() == 0
    assert buckets.differing(spark, path, "r2", "r3").count() == 0


def test_the_diff_reads_differing_buckets_only(spark):
    path = scratch_dir(spark, "state")
    old = rows()
    new = [(*r[:2], "m2", *r[3:]) if i in (7, 8) else r for i, r in enumerate(old) if i != 30] + [("t1", "b1", "m", "c", 0, "")]
    tracked, current = stamped(frame(spark, old)), frame(spark, new)
    compared = [c for _, c in diff.DIFF_COLUMNS if c in current.columns]
    buckets.create(tracked, path, "r1", compared, 64)
    buckets.create(current, path, "r2", compared, 64)
    delta, marked = buckets.tree_diff(tracked, current, path, "r1", "r2", F.lit("r2"))
    assert marked.count() <= 4
    read = {f.split("/bucket=")[1].split("/")[0] for f in delta.inputFiles() if "/bucket=" in f}
    assert read == {str(r["bucket"]) for r in marked.collect()} and len(read) <= 4
    whole = diff.snapshot_diff(tracked, current, F.lit("r2"))
    changes = lambda d: sorted((*r[:2], r["change_type"], r["reasons"]) for r in d.filter("change_type <> 'unchanged'").collect())
    assert changes(delta) == changes(whole) and len(changes(whole)) == 4
    counts = lambda d: sorted(tuple(r) for r in d.select("type_key", "scanned", "new", "changed", "unchanged", "removed").collect())
    assert counts(buckets.tree_summary(delta, marked, path, "r2")) == counts(diff.track_summary(whole))


def test_equal_snapshots_read_nothing(spark, table):
    path, df = table
    buckets.create(df.repartition(7), path, "r2", buckets=64)
    delta, marked = buckets.tree_diff(stamped(df), df, path, "r1", "r2", F.lit("r2"))
    assert marked.count() == 0 and not [f for f in delta.inputFiles() if "/bucket=" in f] and delta.count() == 0


def test_digests_tell_places_of_nulls_and_types_apart(spark):
    one = frame(spark, [("t", "a", "x", None, 1, None)])
    two = frame(spark, [("t", "a", None, "x", 1, None)])
    path = scratch_dir(spark, "state")
    buckets.create(one, path, "r1", buckets=4)
    buckets.create(two, path, "r2", buckets=4)
    assert buckets.differing(spark, path, "r1", "r2").count() == 1
    top = buckets.fold(buckets.pointers(spark, path, "r1")).first()
    assert top["n"] == 1 and buckets.fold(buckets.pointers(spark, path, "r1"), "type_key").first()["one"] == top["one"]


def test_bucket_of_uses_the_whole_key():
    assert KEY == ["type_key", "id"]


def test_a_consumer_of_many_epochs_keeps_few_folders(spark):
    """Many epochs, some of them replayed: the store is that of a plain upsert, and old deltas and commits go."""
    from tidemark.streaming import arrivals

    r, path = random.Random(3), scratch_dir(spark, "store")
    schema = "type_key string, id string, content_hash string"
    store = {f"a{i}": "h" for i in range(50)}
    initial = spark.createDataFrame([("t", i, h) for i, h in store.items()], schema).coalesce(1)
    live: dict[str, str] = {}
    run = arrivals.consume_compacted(spark, path, lambda: spark.createDataFrame([("t", i, h) for i, h in live.items()], schema).coalesce(1), initial, 4, 8)
    most = 0
    for epoch in range(14):
        keys = [f"a{r.randrange(70)}" for _ in range(3)]
        live.update({k: f"h{epoch}" for k in keys})
        batch = spark.createDataFrame([("t", k) for k in [*keys, *keys]], "type_key string, id string")
        for _ in range(2 if epoch in (3, 5, 7) else 1):
            run(batch, epoch)
        store.update({k: live[k] for k in keys})
        got = {x["id"]: x["content_hash"] for x in arrivals.compacted_store(initial, path, epoch, 4).collect()}
        assert got == store, epoch
        most = max(most, len(buckets.folders(spark, f"{path}/delta", "epoch")))
    assert most <= 8 and set(buckets.folders(spark, f"{path}/base/pointers", "commit")) == {"7", "11"}
    assert len(buckets.folders(spark, f"{path}/delta", "epoch")) <= 8
