"""Top-k against brute force: ties, odd vectors, and the bound that prunes."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import topk


def test_block_keeps_every_member():
    rng = np.random.default_rng(4)
    for trial in range(60):
        n, d = int(rng.integers(130, 900)), int(rng.integers(1, 40))
        values = np.floor(rng.normal(size=(n, d)) * rng.choice([3, 60, 300])).astype(np.int64)
        values[rng.integers(0, n, 20)] = values[0]
        block = topk.Block(values)
        for q in (values[1], -values[2], np.zeros(d, np.int64), np.floor(rng.normal(size=d) * 900).astype(np.int64)):
            scores = values @ q
            kept = set(block.best(q, 11).tolist())
            assert set(np.flatnonzero(scores >= np.sort(scores)[-11]).tolist()) <= kept


def test_stops_early():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 64))
    values = np.floor((centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 64)) * 0.2) * 100).astype(np.int64)
    assert len(topk.Block(values).best(values[7], 11)) < 2000


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 2.0]), (200, [1.0, None]), (300, None), (400, [nan, 1.0]), (500, [inf, 1.0]), (1, [3.0, 1.0]), (2, [3.0, 1.0]),
            (2, [3.0, 1.0]), (None, [3.0, 1.0]), (600, [1.0]), (7, [-2.0]), (100, [1.0, 2.0]), (800, []), (5, [0.0005, -0.0005])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = topk.top_k(df, F.col("vec_id") % 100 == 0, k=4).collect()
    mine = {}
    for r in got:
        mine.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    s = 1024 * 1024
    # Both rows with id 100 ask; each meets the other. Five rows tie for four places, the null id is last.
    assert sorted(mine[100]) == sorted(2 * [(1, 1, 5 * s), (2, 2, 5 * s), (3, 2, 5 * s), (4, 100, 5 * s)])
    whole = [(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") == 600, k=9).collect()]
    assert whole == [(1, 7, -2 * s)]
    every = {(r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") == 100, k=9).collect()}
    assert every == {(1, 1, 5 * s), (2, 2, 5 * s), (3, 2, 5 * s), (4, 100, 5 * s), (5, None, 5 * s), (6, 5, -2048)}
    assert mine[600] == [(1, 7, -2 * s)] and 800 not in mine and set(mine) == {100, 600}
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_large_components_do_not_wrap(spark):
    """64 components of up to 1,500 each: products add up beyond 2^47."""
    import numpy as np

    from tidemark.llm import topk

    values = np.random.default_rng(3).normal(0, 1500, (600, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, df["vec_id"] % 100 == 0).collect())
    whole = np.floor(values.astype(np.float64) * 1024).astype(np.int64)
    want = []
    for q in range(0, 600, 100):
        scores = whole @ whole[q]
        best = sorted((i for i in range(600) if i != q), key=lambda i: (-int(scores[i]), i))[:10]
        want += [(q, n, i, int(scores[i])) for n, i in enumerate(best, 1)]
    assert got == sorted(want) and max(w[3] for w in want) > 1 << 46
