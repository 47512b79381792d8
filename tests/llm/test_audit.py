"""Filter audit: the matrix against a count in plain Python, every order by running the filters, and odd rows against the SQL."""

import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from odd import both
from tidemark.llm import audit

TEXTS = [
    "a b a", "", None, "ÀÉ à b", "A" * 300, "one two # three", "word " * 250, " ".join(f"w{i}" for i in range(250)), "x\x00y\t\x0bz  ", "word " * 250,
    "one two # three", "", " ".join(f"w{i % 90}" for i in range(250)) + " $ A", "|", "Ab Cd", "　a b",
]
DOCS = [(i if i != 7 else None, t, ["s", "t", None, ""][i % 4]) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "s"), (4, TEXTS[4], "s"), (None, TEXTS[7], None)]
LABELS = [(0, 1, 0), (0, 0, 1), (4, 1, None), (6, None, 1), (9, 1, 1), (None, 1, 1), (99, 1, 1)]


def frame(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS part", "'k' AS key", "2 AS good", "3 AS failed").repartition(3)


def failed(doc_id, text, docs):
    x = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", x)
    same = [d for d, t, _ in docs if (t or "") == x and d is not None]
    return "".join(f for f, bad in zip("ABCDE", (
        len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", x)) > 2 * len(x), bool(re.search(r"[#$%&*|]", x)),
        doc_id is not None and min(same) < doc_id)) if bad)


def brute(docs, labels):
    """Runs the filters in every order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out, by_filter = {}, Counter()
    for part in {s or "" for _, _, s in docs}:
        rows = [(d, failed(d, t, docs)) for d, t, s in docs if (s or "") == part]
        for order in audit.ORDERS:
            left = rows
            for i, f in enumerate(order, 1):
                hit, stay = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                out[part, order, i] = [
                    len(stay), len(hit), sum(f in r[1] for r in rows) - len(hit), sum(r[1] == f for r in rows), sum(d in good for d, _ in hit), sum(d in toxic for d, _ in hit)]
                by_filter[part, f] += len(hit)
                left = stay
    return {k: (*v, by_filter[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_all_orders_against_running_the_filters(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit.audit(frame(spark), labels).collect()}
    assert got == brute(DOCS, LABELS) and len(got) == 3 * 600


def test_odd_rows_against_sql(spark, tmp_path):
    pq.write_table(pa.table({n: pa.array([r[i] for r in LABELS], pa.int64()) for i, n in enumerate(("doc_id", "quality", "toxic"))}), f"{tmp_path}/labels.parquet")
    rows = pa.table({"doc_id": pa.array([r[0] for r in DOCS], pa.int64()), "text": [r[1] for r in DOCS], "source": [r[2] for r in DOCS], "part": [1] * len(DOCS)})
    got, want = both(spark, tmp_path, "op13_filter_audit", "documents", rows, more=["labels"])
    assert got == want


def test_matrix_counts_every_word(spark, monkeypatch):
    """Global word numbers: one number per word over all shards, one word per number."""
    words, names = {}, {}
    monkeypatch.setattr(audit, "BLOCK_DOCS", 4)
    made = audit.numbered_blocks(audit.blocks(frame(spark)))
    for r in audit.blocks(frame(spark)).collect():
        names[r["block"]] = [bytes(t) for t in r["terms"]]
    seen = []
    for r in made.collect():
        own = {p: i for x in r["ids"] or [] for p, i in zip(x["places"], x["ids"])}
        assert sorted(own) == list(range(len(names[r["block"]])))
        for place, number in own.items():
            assert words.setdefault(names[r["block"]][place], number) == number
    assert len(set(words.values())) == len(words)
    for r in audit.matrix(frame(spark)).collect():
        for i, doc_id in enumerate(r["doc_id"]):
            own = slice(r["starts"][i], r["starts"][i + 1])
            assert r["columns"][own] == sorted(set(r["columns"][own]))
            seen.append((doc_id, sorted(r["counts"][own])))
    want = [(d, sorted(Counter((t or "").encode().split()).values())) for d, t, _ in DOCS]
    assert sorted(seen, key=str) == sorted(want, key=str)


def test_a_block_is_unpacked_in_stretches(monkeypatch):
    """Measures of a block of 1.6 million entries in a few MB; a row above the limit stays whole."""
    block = audit.Block()
    for i in range(8_000):
        block.add(i, "s", b"k", b" ".join(b"w%d" % (i * 7 % 900 + j) for j in range(200)))
    block.add(8_000, "s", b"k", b"")
    block.add(8_001, "s", b"k", b" ".join(b"v%d" % j for j in range(5_000)) + b" v1")
    made = block.batch(0)
    size, kinds = len(block.book), pa.struct([("places", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64()))])
    ids = pa.array([[{"places": np.arange(size, dtype=np.int32), "ids": np.arange(size) + 10}]], pa.list_(kinds))
    batch = made.drop_columns(["terms"]).append_column("ids", ids)
    del block
    for limit in (1 << 17, 3_000):
        monkeypatch.setattr(audit, "UNPACKED", limit)
        words, distinct, docs = [], [], []
        tracemalloc.start()
        for _, _, own, starts, columns, counts in audit.shards(iter([batch])):
            docs += range(own.start, own.stop)
            distinct += np.diff(starts).tolist()
            words += [int(counts[a:b].sum()) for a, b in zip(starts[:-1], starts[1:])]
            assert columns.min(initial=10) >= 10
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert docs == list(range(8_002))
        assert words == [200] * 8_000 + [0, 5_001] and distinct == [200] * 8_000 + [0, 5_000]
        assert peak < 24 << 20


def test_canonical_rows_merge_entries():
    starts, columns, counts = audit.canonical(np.array([0, 3, 3, 5]), np.array([9, 2, 9, 4, 1]), np.array([1, 2, 3, 4, 5]))
    assert (starts.tolist(), columns.tolist(), counts.tolist()) == ([0, 2, 2, 4], [2, 9, 1, 4], [2, 4, 5, 4])
    empty = audit.canonical(np.array([0, 0]), np.zeros(0, np.int64), np.zeros(0, np.int32))
    assert [a.tolist() for a in empty] == [[0, 0], [], []]


def test_empty_and_wordless_tables(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audit.audit(frame(spark).limit(0), labels).count() == 0
    rows = audit.audit(frame(spark, [(1, None, "s"), (2, " \n", "s")]), labels.limit(0)).filter("filter_order = 'ABCDE' AND step = 1").collect()
    assert [(r["kept"], r["removed"]) for r in rows] == [(0, 2)]
