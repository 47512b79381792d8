"""Repeated strings against brute force over all windows."""

import hashlib
import random
from collections import Counter

import pytest

from tidemark.llm import repeats


def brute(rows):
    w = repeats.WINDOW
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + w] for t in texts for i in range(len(t) - w + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - w + 1):
            if seen[t[i : i + w]] > 1:
                gone[i : i + w] = b"\x01" * w
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((str(d), len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)

    def text(n):
        return "".join(rng.choice("abcdefg hijklmnop qrstuvwxyzéß") for _ in range(n))

    shared = [text(n) for n in (199, 200, 201, 230, 400, 900)]
    rows = []
    for i in range(30):
        body = text(rng.choice([0, 10, 150, 300, 1500]))
        for _ in range(rng.choice([0, 1, 1, 2])):
            p = rng.choice(shared)
            if rng.random() < 0.4:
                a = rng.randrange(len(p) // 2)
                p = p[a : a + rng.choice([180, 200, 260, 500])]
            if rng.random() < 0.3:
                k = rng.randrange(len(p))
                p = p[:k] + "#" + p[k + 1 :]
            at = rng.randrange(len(body) + 1)
            body = body[:at] + p + body[at:]
        rows.append((i, body))
    rows += [(50, "ab" * 700), (51, "x" * 450), (52, rows[3][1]), (52, text(260)), rows[7], (None, rows[5][1]), (None, None), (60, ""), (61, "y" * 199),
             (62, text(300) + "z" * 210 + text(90))]
    return rows


@pytest.mark.parametrize("seed,chunk,limit", [(1, 1 << 19, 20_000), (2, 700, 20_000), (3, 1 << 19, 2)])
def test_against_brute_force(spark, monkeypatch, seed, chunk, limit):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    monkeypatch.setattr(repeats, "GROUP_LIMIT", limit)
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, h int").repartition(3)
    got = repeats.without_repeats(df).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got) == brute(rows)


def test_empty(spark):
    assert repeats.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_interval_tree():
    # The suffix array of "abracadabra": lengths of common prefixes 0 1 4 1 1 0 3 0 0 0 2.
    tree = list(repeats.intervals([0, 1, 4, 1, 1, 0, 3, 0, 0, 0, 2]))
    assert sorted(tree) == [(0, 0, 10), (1, 0, 4), (2, 9, 10), (3, 5, 6), (4, 1, 2)]


def test_judging_in_any_batches():
    import pyarrow as pa

    rng = random.Random(8)
    rows = sorted((m, rng.randrange(3) if m % 3 else 0, i) for i, m in enumerate(rng.choices(range(12), k=80)))

    def batches(size):
        for i in range(0, len(rows), size):
            part = rows[i : i + size]
            yield pa.RecordBatch.from_pydict({
                "m": pa.array([r[0] for r in part], pa.int64()), "c": pa.array([r[1] for r in part], pa.int64()),
                "doc_id": pa.array([r[2] for r in part], pa.int64()), "h": pa.array([0] * len(part), pa.int64()),
                **{k: pa.array([1] * len(part), pa.int32()) for k in ("at", "x", "n")}, "twice": pa.array([False] * len(part))})

    spans = Counter(r[:2] for r in rows)
    kinds = Counter(m for m, _ in spans)
    for size in (1, 2, 3, 7, 100):
        plain, asked = [], []
        for b in repeats.judge_runs(batches(size)):
            for r in b.to_pylist():
                (asked if r["ask"] else plain).append(r)
        assert sorted(r["doc_id"] for r in plain) == sorted(i for m, c, i in rows if spans[m, c] > 1)
        assert sorted((r["m"], r["c"], r["twice"]) for r in asked) == sorted((m, c, n > 1) for (m, c), n in spans.items() if kinds[m] > 1)
