"""Streams against a replay in plain Python, whatever the batches are."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import KEY
from tidemark.streaming import arrivals, gates, jobs

T0 = dt.datetime(2024, 1, 1)


def files(spark, path, rows, schema, parts):
    """Write rows in order as ``parts`` files, and stream them one file per batch."""
    n = (len(rows) + parts - 1) // parts
    for i in range(parts):
        chunk = spark.createDataFrame(rows[i * n : (i + 1) * n], schema).coalesce(1)
        chunk.write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def replay(rows, hours, watermark):
    """What must be escalated once the watermark has reached ``watermark``."""
    wait, out = dt.timedelta(hours=hours), []
    by = {}
    for kind, key, action, ts in sorted(rows, key=lambda r: (r[3], r[2])):
        held = by.get((kind, key))
        if held is not None and ts >= held + wait:
            out.append((kind, key, held))
            held = None
        if action == "held" and held is None:
            held = ts
        elif action == "resolved":
            held = None
        by[(kind, key)] = held
    out += [(k[0], k[1], h) for k, h in by.items() if h is not None and h + wait <= watermark]
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 4])
def test_holds_time_out(spark, tmp_path, parts):
    gates.use_rocksdb(spark)
    rnd = random.Random(7)
    rows = sorted(
        (("T", f"k{rnd.randrange(8)}", rnd.choice(["held", "held", "resolved"]), T0 + dt.timedelta(minutes=rnd.randrange(12000)))
         for _ in range(120)),
        key=lambda r: r[3],
    )
    s = files(spark, str(tmp_path / "in"), rows, "type_key string, id string, action string, ts timestamp", parts)
    out = jobs.run_available(gates.escalate_holds(s, 24, "1 hour"), spark, f"holds{parts}")
    got = sorted((r.type_key, r.id, r.held_at) for r in out.collect())
    assert got == replay(rows, 24, max(r[3] for r in rows) - dt.timedelta(hours=1))


@pytest.mark.parametrize("parts", [1, 5])
def test_gate_opens_once_whatever_the_batches(spark, tmp_path, parts):
    rows = []
    for run, types in (("r1", 3), ("r2", 2), ("r3", 3)):
        for repeat in range(3):
            rows += [(run, f"t{i}", T0 + dt.timedelta(minutes=len(rows) + i)) for i in range(types)]
    s = files(spark, str(tmp_path / "in"), rows, "run_date string, type_key string, ts timestamp", parts)
    out = jobs.run_available(gates.gate_once(s, 3), spark, f"gate_test{parts}", "update", ["run_date"])
    assert sorted((r.run_date, r.types) for r in out.collect()) == [("r1", 3), ("r3", 3)]


def test_redelivery_across_batches(spark, tmp_path):
    rows = [("T", str(i % 5), "h", T0 + dt.timedelta(days=i)) for i in range(20)]
    s = files(spark, str(tmp_path / "in"), rows, "type_key string, id string, content_hash string, ts timestamp", 4)
    assert jobs.run_available(jobs.drop_redeliveries(s), spark, "dedup_test").count() == 5


def test_windows_in_update_mode_match_batch(spark, tmp_path):
    rows = [(T0 + dt.timedelta(minutes=i % 37), "m", str(i % 3)) for i in range(200)]
    s = files(spark, str(tmp_path / "in"), rows, "ts timestamp, metric string, dim string", 5)
    out = jobs.run_available(jobs.metric_windows(s), spark, "win_test", "update", ["window_start", "metric", "dim"])
    batch = spark.createDataFrame(rows, "ts timestamp, metric string, dim string").groupBy(
        F.window("ts", "5 minutes").start.alias("w"), "dim").count()
    assert sorted((r.window_start, r.dim, r.n) for r in out.collect()) == sorted(tuple(r) for r in batch.collect())


def test_arrivals_and_replayed_epoch(spark, tmp_path):
    idx = spark.createDataFrame([("A", "1", "h1"), ("A", "2", "h2")], "type_key string, id string, metadata_hash string")
    run = arrivals.classify_epoch(spark, str(tmp_path / "i"), str(tmp_path / "s"), idx)
    batch = lambda *r: spark.createDataFrame(list(r), "type_key string, id string, metadata_hash string, ts int")
    first = batch(("A", "1", "h1", 1), ("A", "2", "x", 1), ("A", "3", "n", 1), ("A", "3", "n2", 2))
    for _ in range(2):  # the second call replays the epoch
        run(first, 0)
    run(batch(("A", "3", "n2", 3), ("A", "2", "h2", 3)), 1)
    for e in (None, 1):
        after = arrivals.index_after(spark, str(tmp_path / "i"), str(tmp_path / "s"), e)
        assert sorted((r.id, r.metadata_hash) for r in after.collect()) == [("1", "h1"), ("2", "h2"), ("3", "n2")]
    got = sorted((r.epoch, r.id, r.metadata_hash, r.op) for r in spark.read.parquet(str(tmp_path / "s")).collect())
    assert got == [(0, "2", "x", "changed"), (0, "3", "n2", "new"), (1, "2", "h2", "changed")]


def test_json_source_reads_growing_manifest(spark, tmp_path):
    (tmp_path / "m").mkdir()
    schema = "op string, id string, type_key string, run_date string"
    (tmp_path / "m" / "a.jsonl").write_text('{"op":"new","id":"1","type_key":"T","run_date":"d"}\n')
    (tmp_path / "m" / "b.jsonl").write_text('{"op":"changed","id":"2","type_key":"T","run_date":"d"}\n')
    s = jobs.json_source(spark, str(tmp_path / "m"), schema, 1)
    out = jobs.run_available(jobs.run_counters(s), spark, "count_test", "update", ["run_date", "type_key"])
    assert [tuple(r) for r in out.collect()] == [("d", "T", 1, 1, 0)]


def test_nothing_arrived(spark, tmp_path):
    (tmp_path / "e").mkdir()
    s = jobs.json_source(spark, str(tmp_path / "e"), "type_key string, id string")
    assert jobs.run_available(s.select(*KEY), spark, "empty_test").count() == 0


def test_index_snapshots_and_deltas_agree(spark, tmp_path):
    idx = spark.createDataFrame([("A", "0", "h")], "type_key string, id string, metadata_hash string")
    ends = []
    for every in (1, 2, 64):
        base = tmp_path / str(every)
        run = arrivals.classify_epoch(spark, str(base / "i"), str(base / "s"), idx, every)
        for e in range(4):
            run(spark.createDataFrame([("A", str(e % 3), f"v{e}", e)], "type_key string, id string, metadata_hash string, ts int"), e)
        after = arrivals.index_after(spark, str(base / "i"), str(base / "s"), 3, every)
        ends.append(sorted((r.id, r.metadata_hash) for r in after.collect()))
    assert ends[0] == ends[1] == ends[2] == [("0", "v3"), ("1", "v1"), ("2", "v2")]


def test_parquet_source_reads_one_name_only(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "e.parquet"))
    spark.range(9).coalesce(1).write.parquet(str(tmp_path / "e.parquet_old"))
    s = jobs.parquet_source(spark, str(tmp_path / "e.parquet"))
    assert jobs.run_available(s, spark, "one_name").count() == 3


@pytest.mark.parametrize("parts", [1, 3])
def test_holds_of_many_keys_in_any_state_store(spark, tmp_path, parts):
    """No call to the store per key: state travels with the rows, so that no store with timers is needed. One deadline is the last watermark itself."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    rnd = random.Random(11)
    rows = sorted(
        (("T", f"k{rnd.randrange(1500)}", rnd.choice(["held", "resolved"]), T0 + dt.timedelta(seconds=rnd.randrange(600_000), microseconds=rnd.randrange(1_000_000)))
         for _ in range(6000)),
        key=lambda r: r[3],
    )
    end = T0 + dt.timedelta(days=8)
    rows += [("T", "at", "held", end - dt.timedelta(hours=25)), ("T", "after", "held", end - dt.timedelta(hours=25) + dt.timedelta(milliseconds=1)), ("T", "last", "resolved", end)]
    s = files(spark, str(tmp_path / "in"), rows, "type_key string, id string, action string, ts timestamp", parts)
    try:
        out = jobs.run_available(gates.escalate_holds(s, 24, "1 hour"), spark, f"many{parts}")
        got = sorted((r.type_key, r.id, r.held_at) for r in out.collect())
    finally:
        spark.conf.set(name, before)
    want = replay(rows, 24, end - dt.timedelta(hours=1))
    assert got == want and ("T", "at", end - dt.timedelta(hours=25)) in got and len(got) > 1000
