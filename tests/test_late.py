"""Late rows, exact quantiles and deliveries told from an index, against plain Python."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import buckets
from tidemark.streaming import arrivals, late, quantiles

T0 = dt.datetime(2024, 1, 1)
POINT = "ts timestamp, metric string"
def count():
    return [F.count(F.lit(1)).alias("n")]



def stream(spark, path, batches, schema):
    """One file per batch."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(frame, store, base, mode="update"):
    query = frame.writeStream.outputMode(mode).foreachBatch(store).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def in_batch(spark, rows):
    made = spark.createDataFrame(rows, POINT).groupBy(F.window("ts", "5 minutes")["start"].alias("w"), "metric").count()
    return sorted(map(str, (tuple(r) for r in made.filter("w is not null").collect())))


def test_rows_behind_the_watermark_are_repaired(spark, tmp_path):
    rnd, batches = random.Random(3), []
    for day in range(0, 40, 10):
        start = T0 + dt.timedelta(days=day)
        batch = [(start + dt.timedelta(minutes=rnd.randrange(600)), rnd.choice(["a", "b", None])) for _ in range(150)]
        # 50 hours behind what came before, in windows of their own and in windows that are closed.
        batch += [(start - dt.timedelta(days=10, hours=50), "a")] * 3 if day else []
        batch += [(batches[0][i][0], batches[0][i][1]) for i in range(4)] if day else []
        batches.append(batch + [(None, "a")])
    base, rows = str(tmp_path / "late"), [r for b in batches for r in b]
    frame = late.windows_with_rows(stream(spark, str(tmp_path / "in"), batches, POINT), ["metric"], count())
    run(frame, late.store_epoch(spark, base), base)
    schema, full = frame.schema, spark.createDataFrame(rows, POINT)
    got = lambda upto: sorted(map(str, (tuple(r) for r in late.windows_after(spark, base, schema, ["metric"], upto).collect())))
    assert got([]) != in_batch(spark, rows)  # the stream alone has lost some
    aside = late.late_rows(spark, base, schema)
    # When the second file comes the watermark is 48 hours before the first one's end, so only its three oldest rows are late.
    assert aside.count() == 3 + 7 + 7
    touched = aside.select("window_start", "metric").distinct().count()
    again = late.repair(spark, base, schema, full, ["metric"], count(), 9)
    assert again.count() == touched < len(in_batch(spark, rows))
    assert got([9]) == in_batch(spark, rows)
    # Two repairs, the first before the last rows came, and one that is run again.
    for after, upto in ((-1, 1), (1, 9), (1, 9)):
        late.repair(spark, base, schema, full, ["metric"], count(), upto, after)
    assert got([1, 9]) == in_batch(spark, rows)


def test_late_store_without_rows_and_replayed(spark, tmp_path):
    base = str(tmp_path / "late")
    frame = late.windows_with_rows(stream(spark, str(tmp_path / "in"), [[(T0, "a")]], POINT), ["metric"], count())
    assert late.windows_after(spark, base, frame.schema, ["metric"]).count() == 0
    store = late.store_epoch(spark, base)
    cells = "kind string, window_start timestamp, window_end timestamp, metric string, value struct<n:bigint>, ts timestamp"
    at = lambda h: T0 + dt.timedelta(hours=h)
    batch = lambda h: spark.createDataFrame([("late", at(h), at(h + 1), "a", None, at(h))], cells)
    for epoch, hour in ((0, 100), (1, 10), (1, 10), (2, 100)):  # epoch 1 is replayed
        store(batch(hour), epoch)
    assert [(r["epoch"], r["ts"]) for r in late.late_rows(spark, base, batch(0).schema).collect()] == [(1, at(10))]


def least(values, q):
    values = sorted(values)
    return values[max(math.ceil(round(q * len(values), 6)), 1) - 1]


@pytest.mark.parametrize("q", ["0.99", "0.5", "0", "1"])
def test_quantiles_are_exact(spark, q):
    rnd = random.Random(5)
    kinds = {
        "steady": [rnd.uniform(0, 1000) for _ in range(3000)], "equal": [7.0] * 500, "one": [3.5], "none": [None, None],
        "close": [1000 + i * 1e-9 for i in range(700)], "signs": [rnd.gauss(0, 1) * 10 ** rnd.randrange(-200, 200) for _ in range(900)] + [0.0, -0.0],
        "odd": [float("inf"), float("-inf"), 1.0, 5e-324, 1.7e308, None, float("inf")],
    }
    rows = [(T0 + dt.timedelta(days=d), v) for d, values in enumerate(kinds.values()) for v in values]
    lines = spark.createDataFrame(rows, "ts timestamp, duration_ms double").repartition(5)
    bins = quantiles.latency_bins(lines, "duration_ms", "1 day", lateness=None)
    found = quantiles.exact_quantile(bins, lines, "duration_ms", q, "1 day").collect()
    want = {}
    for day, values in enumerate(kinds.values()):
        known = [v for v in values if v is not None]
        if known:
            want[T0 + dt.timedelta(days=day)] = (least(known, float(q)), len(known))
    assert {r["window_start"]: (r["value"], r["n"]) for r in found} == want


def test_hot_window_has_bounded_bins(spark):
    """A window of 10 million different values: exact, and counted in some thousand rows."""
    n = 10_000_000
    lines = spark.range(n).select(F.lit(T0).alias("ts"), ((F.col("id") * 7_654_321 % n) * 0.01).alias("v"))
    bins = quantiles.latency_bins(lines, "v", "1 day", lateness=None)
    assert bins.count() < 2600
    assert quantiles.exact_quantile(bins, lines, "v", "0.99", "1 day").collect()[0]["value"] == (n * 99 // 100 - 1) * 0.01


def test_bins_never_fall(spark):
    values = sorted(random.Random(1).uniform(0, 2) * 10 ** e for e in range(-320, 308) for _ in range(20))
    rows = [(float("-inf"),)] + [(-v,) for v in reversed(values)] + [(0.0,)] + [(v,) for v in values] + [(float("inf"),), (float("nan"),)]
    got = [r[0] for r in spark.createDataFrame(rows, "v double").coalesce(1).select(quantiles.fine_bin(F.col("v"))).collect()]
    assert got == sorted(got) and None not in got


VERSIONS = "ts timestamp, type_key string, id string, content_hash string"


@pytest.mark.parametrize("parts", [1, 10])
def test_versions_are_delivered_once_without_state(spark, tmp_path, parts):
    rnd = random.Random(9)
    # Redelivered days later and out of order, with nulls; one article holds a third of the rows.
    rows = [(T0 + dt.timedelta(hours=rnd.randrange(-500, 500)), rnd.choice(["A", "B", None]), "hot" if i % 3 else f"k{i % 7}", rnd.choice(["x", "y", None]))
            for i in range(300)]
    base, n = str(tmp_path / "store"), (len(rows) + parts - 1) // parts
    frame = stream(spark, str(tmp_path / "in"), [rows[i * n : (i + 1) * n] for i in range(parts)], VERSIONS)
    query = run(frame, arrivals.deliver_once(spark, base, compact_every=2, many=4), base, "append")
    out = [tuple(r)[1:4] for r in spark.read.schema(VERSIONS).parquet(f"{base}/out").collect()]
    assert sorted(map(str, out)) == sorted(map(str, {r[1:] for r in rows}))
    assert all(not p.stateOperators for p in query.recentProgress)
    assert len(buckets.folders(spark, f"{base}/index/delta", "epoch")) <= 4
    assert len(buckets.folders(spark, f"{base}/index/base/pointers", "commit")) <= 2
