"""Resampling: the SQL on odd rows, and runs of several words against a brute-force count."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq

from odd import both
from tidemark.llm import resample

LINES = ["The cat sat", "", "on the mat. The end", "x", "é à b", "\x00 n9", "a\rb\x0bc"]
TEXTS = (
    ["\n".join(LINES), "\n".join(LINES[::-1]), None, "", "\n\n\n", "one", "The cat sat\nThe cat sat\nThe cat sat", "ÉCOLE École école A1 a1"]
    + [" ".join(f"w{(i * j) % 37}" for j in range(15 + i)) + "\nThe cat sat\nshared line of words" for i in range(30)]
    + ["long " * 120_000]
)


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]


def brute(docs, target, run, buckets=10000, percent=10, least=20):
    def features(text):
        found = words(text)
        return [zlib.crc32(b" ".join(found[i : i + k])) % buckets for k in range(1, run + 1) for i in range(len(found) - k + 1)]

    s = Counter(b for _, t in docs for b in features(t))
    t = Counter(b for x in target for b in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        own = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in own)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i for i, r in enumerate(able[: len(able) * percent // 100], 1)}
    return sorted(((r[0], r[1], r[2], r[3], rank.get(id(r))) for r in out), key=str)


def test_runs_of_words_against_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    target = ["the cat sat\non the mat", None, "w1 w2\n\nw3 shared", ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS weight", "2 AS score", "'k' AS line", "3 AS words").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for run in (1, 2, 4):
        got = sorted((tuple(r) for r in resample.resample(frame, goal, percent=30, run=run).collect()), key=str)
        assert got == brute(docs, target, run, percent=30)


def test_across_counts_each_run_once():
    f = resample.Features(run=3)
    lines = [[b"a"], [], [b"b", b"c"], [b"d"], [b"e", b"f", b"g", b"h"]]
    flat = [w for line in lines for w in line]
    inner = Counter(b for line in lines for b in f.whole(line).tolist())
    assert inner + Counter(f.across(lines).tolist()) == Counter(f.whole(flat).tolist())


def test_odd_rows_against_sql(spark, tmp_path):
    texts = [*TEXTS, TEXTS[12], TEXTS[12]]
    ids = [*range(len(TEXTS) - 2), None, None, 12, 12]
    pq.write_table(pa.table({"item_id": [1, 2], "text": ["the cat w1 w2 w3", None]}), f"{tmp_path}/benchmark.parquet")
    rows = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts, "rank": [1] * len(ids)})
    got, want = both(spark, tmp_path, "op12_resample", "documents", rows, more=["benchmark"])
    assert got == want and len(got) == len(ids)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resample.resample(none, none).count() == 0
    assert [r["rank"] for r in resample.resample(some, none, percent=50, least_words=1).collect()] == [None, None]
    assert [r["rank"] for r in resample.resample(some, none, percent=100, least_words=0).orderBy("rank").collect()] == [1, 2]


def test_ranks_are_dense_over_many_partitions(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.common import numbered

    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("i"))
    got = [(r["k"], r["i"], r["n"]) for r in numbered(rows, "n", [F.desc("k"), F.asc("i")]).collect()]
    want = sorted(((i % 7, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    assert sorted(got, key=lambda r: r[2]) == [(*r, n) for n, r in enumerate(want, 1)]
