"""Fingerprints, links and components against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash


def brute(rows, n=4, bits=4):
    prints = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        s = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        prints.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted((str(d), f"{prints[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(rows))


def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}É" if i % 9 == 0 else f"W{i}" for i in range(300)]
    rows = []
    for base in range(25):
        w = rng.choices(vocab, k=rng.choice([1, 3, 5, 40, 200]))
        for _ in range(rng.choice([1, 2, 6])):
            v = list(w)
            for _ in range(rng.choice([0, 0, 1, 2])):
                v[rng.randrange(len(v))] = rng.choice(vocab)
            rows.append((len(rows) * 3, " ".join(v)))
    rows += [(900, None), (901, ""), (902, " \t\n"), (None, rows[0][1]), (None, "only nameless here"), rows[4], (903, "long " * 90_000)]
    return rows


def test_near_duplicates(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, print int").repartition(5)
    got = simhash.near_duplicates(df).select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0"), "component_id").collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == brute(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_links_of_planted_distances(spark, monkeypatch):
    """Dense clusters and pairs at every distance up to 4 and beyond; crowded anchors are split."""
    rng = random.Random(3)
    prints = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        prints.add(x)
        for d in range(1, 7):
            y = x
            for b in rng.sample(range(64), d):
                y ^= 1 << b
            prints.add(y)
    x = rng.getrandbits(64)
    prints |= {x ^ 1 << i ^ 1 << j for i in range(30) for j in range(i)}
    values = sorted(prints)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    want = {}
    for v in values:
        want.setdefault(root(v), set()).add(v)
    want = sorted(sorted(g) for g in want.values() if len(g) > 1)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(s, s, 0, s, 0) for s in signed], "node long, k0 long, k1 long, c0 long, c1 long")
    for limit in (4096, 7):
        monkeypatch.setattr(simhash, "HOME_LIMIT", limit)
        member = simhash.components(simhash.near_links(df, simhash.EXACT, 4)).collect()
        got = {}
        for r in member:
            got.setdefault(r["root"], set()).add(r["node"] % 2**64)
        assert sorted(sorted(g) for g in got.values()) == want


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_first_of_each(spark):
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(2000)]
    rows, want = [], set()
    for g in range(60):
        w = rng.choices(vocab, k=150)
        want.add(len(rows))
        rows.append((len(rows), " ".join(w), "a"))
        for _ in range(3 if g % 2 else 0):
            v = list(w)
            v[rng.randrange(150)] = "edit"
            v[rng.randrange(150)] = "edit"
            rows.append((len(rows), " ".join(v), "b"))
    rows += [(None, rows[0][1], "c"), (500, None, "c"), (501, "", "c"), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, _x string")
    out = simhash.first_of_each(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want | {500})
    assert simhash.first_of_each(df.limit(0)).count() == 0


def shingle_set(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_similarities_from_07_to_09(spark):
    """Copies cut, lengthened and edited to similarities around 0.8: what stays is what brute force over all sets leaves."""
    rng = random.Random(12)
    vocab = [f"u{i}" for i in range(3000)]
    texts = []
    for g in range(240):
        w = rng.choices(vocab, k=rng.choice([30, 120, 400]))
        share = rng.uniform(0.68, 0.92)
        if g % 3 == 0:
            v = w[: round(len(w) * share)]
        elif g % 3 == 1:
            v = w + rng.choices(vocab, k=round(len(w) * (1 / share - 1)))
        else:
            v = list(w)
            for i in rng.sample(range(len(w)), round(len(w) * (1 - share) / 9)):
                v[i] = "edit"
        texts += [" ".join(w), " ".join(v)]
    texts += [" ".join(["same line again and again"] * 50 + rng.choices(vocab, k=40)) for _ in range(30)]
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))
    near = []
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            union = len(sets[i]) + len(sets[j]) - shared
            if shared * 10 >= union * 6:
                near.append(shared / union)
            if shared * 5 >= union * 4:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert sum(0.7 <= x < 0.8 for x in near) > 40 and sum(0.8 <= x < 0.9 for x in near) > 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert sorted(r["doc_id"] for r in simhash.first_of_each(df).collect()) == sorted(set(root))


def test_a_group_that_its_smallest_node_does_not_hold_together(spark, monkeypatch):
    """Texts that each resemble the first one too little, but one another enough; also with crowded bands."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(200)]
    other = base[:172] + [f"c{i}" for i in range(28)]
    texts = [base] + [other[:i] + [f"d{i}"] + other[i + 1 :] for i in range(174, 194)]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    want = sorted({texts.index(base), min(i for i, t in enumerate(texts) if t is not base)})
    for limit in (4096, 5):
        monkeypatch.setattr(simhash, "HOME_LIMIT", limit)
        assert sorted(r["doc_id"] for r in simhash.first_of_each(df).collect()) == want


def test_a_full_anchor_is_compared_in_little_memory():
    """4,096 homes of one anchor and 6,000 copies, all of them near: no link is lost, and a worker holds few comparisons at once."""
    n, size = simhash.HOME_LIMIT + 6000, 512
    node, prints, home = np.arange(n), np.random.default_rng(3).integers(0, 16, n), np.arange(n) < simhash.HOME_LIMIT
    zero = np.zeros(n, np.int64)
    rows = pa.RecordBatch.from_arrays([pa.array(x) for x in (zero, zero, node, prints, zero, home)], ["anchor", "part", "node", "c0", "c1", "home"])
    tracemalloc.start()
    links = list(simhash.compared(simhash.within(4))(rows.slice(i, size) for i in range(0, n, size)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    a, b = (np.concatenate([x.column(i).to_numpy() for x in links]) for i in range(2))
    assert len(simhash.stars(a, b)[0]) == n - 1 and (simhash.stars(a, b)[1] == 0).all()
    assert peak < 64e6
