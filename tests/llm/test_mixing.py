"""Source mixing: targets by a plain loop, what the mix takes, odd rows."""

import random

import pyarrow as pa
import pytest

from odd import both
from tidemark.llm import mixing

SHAPE = "doc_id long, text string, source string, size int, target int, taken int, rank int, part int, block int"


def filled(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets per source: what is over a cap goes to the others by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        rest = [s for s in names if s not in capped]
        left = share * sum(sizes.values()) - sum(capped.values())
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return {**capped, **{s: left * weight[s] / total for s in rest}}
        capped.update({s: cap * sizes[s] for s in over})


def corpus(seed):
    rng = random.Random(seed)
    names = ["b", "a", None, "ß", "B", ""]
    # One source holds more than a third of the rows.
    rows = [(i, " ".join("w" for _ in range(rng.choice([1, 5, 80, 400]))), "hot" if i % 3 else rng.choice(names)) for i in range(1500)]
    rows += [(5000, None, "a"), (5001, "", "b"), (5002, " \t\n", "hot"), (None, "no id here", "a"), (None, "no id here", "a"), rows[4], rows[4],
             (-7, "minus seven", None), (5003, "long " * 60_000, "ß"), (5004, None, "only nulls")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, *[0] * 6) for r in rows], SHAPE).repartition(6)
    got = [tuple(r) for r in mixing.mix_sources(df).collect()]
    key = lambda r: tuple(str(x) for x in r)
    count = lambda t: len((t or "").split())
    assert sorted((r[0], r[1], r[2]) for r in got if r[0] is not None and r[2] is not None) == sorted(
        (i, count(t), s) for i, t, s in rows if i is not None and s is not None)
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for _, size, source, _, _, took in got:
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + took
        assert 0 <= took <= 2 * size
    aim = filled(sizes)
    for _, _, source, whole, target, _ in got:
        assert whole == sizes[source] and abs(target - aim[source]) < 1e-6 * max(1, aim[source])
    for s in sizes:
        assert abs(taken[s] - aim[s]) <= 0.03 * aim[s] + 96, s
    again = mixing.mix_sources(df.repartition(3)).collect()
    assert sorted(map(key, got)) == sorted(key(tuple(r)) for r in again)


def test_small_tables(spark):
    df = spark.createDataFrame([(*r, *[0] * 6) for r in corpus(3)], SHAPE)
    assert mixing.mix_sources(df.limit(0)).count() == 0
    one = mixing.mix_sources(df.filter("source = 'hot'")).collect()
    assert abs(sum(r["taken"] for r in one) / one[0]["target"] - 1) < 0.03 and abs(one[0]["target"] - 1.5 * one[0]["source_size"]) < 1e-6
    nothing = mixing.mix_sources(df.filter("doc_id in (5000, 5001, 5004)")).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in nothing) == [(i, 0, 0, 0.0, 0) for i in (5000, 5001, 5004)]


def test_query_on_odd_rows(spark, tmp_path):
    rows = corpus(4)
    table = pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
        "source": pa.array([r[2] for r in rows], pa.string()), "taken": pa.array([0] * len(rows))})
    got, want = both(spark, tmp_path, "op9_source_mix", "documents", table)
    assert got == want and len(got) == len(rows)
    got, want = both(spark, tmp_path, "op9_source_mix", "documents", table.slice(0, 0))
    assert got == want == []
