"""Classifier and language profiles: accuracy outside the learned fold, and odd rows."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import catalog, langid, quality

SF = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    got = catalog.QUERIES["op2_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93
    again = catalog.QUERIES["op2_quality"](spark, SF)
    assert got.exceptAll(again).count() == 0


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good text here", "k"), (1, "good text here", "k"), (2, None, "k"), (3, "", "k"), (None, "x" * 700_000, "k"), (4, "a b " * 300_000, "k")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (9, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs.drop("score"), model, ["doc_id"]).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    flat = quality.fit(docs, labels.limit(0))
    assert not flat.any()
    assert quality.score(docs.drop("score").limit(0), flat, ["doc_id"]).count() == 0


def test_pieces_equal_whole():
    """Features of a text read in one go equal those of the same words in several texts, but for pairs across."""
    seen, share = quality.counted("alpha beta alpha")
    assert abs(share.sum() - 1) < 1e-6 and len(seen) > 5
    assert quality.counted("")[0].size == 0 and quality.counted("   ")[0].size >= 0


def test_language_held_out(spark):
    got = catalog.QUERIES["op4_language"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "the cat and the hat", "en", 1), (2, "der hund und die katze", "de", 1), (3, None, "en", 1), (4, "123 !?", "en", 1),
         (None, "", None, 1), (6, "der und " * 100_000, None, 1), (7, "мама мыла раму", "ru", 1), (8, "раму мыла", None, 1), (8, "раму мыла", None, 1)],
        "doc_id long, text string, lang string, score int")
    names, profiles = langid.learn(docs)
    assert names == ["de", "en", "ru"]
    out = [(r["doc_id"], r["lang_pred"]) for r in langid.predict(docs, names, profiles, ["doc_id"]).collect()]
    assert dict(out) == {1: "en", 2: "de", 3: "und", 4: "und", None: "und", 6: "de", 7: "ru", 8: "ru"} and len(out) == 9
    nothing = langid.learn(docs.limit(0))
    assert nothing[0] == [] and {r["lang_pred"] for r in langid.predict(docs, *nothing, ["doc_id"]).collect()} == {"und"}


def test_bundle_is_the_sum_of_bound_letters():
    import pyarrow as pa

    p = langid.Profiler()
    made, lettered = p.bundles(pa.array(["abé c", None, "9"]))
    v = langid.letter_vectors().astype(int)
    sym = [0, *p.symbol("abé c").tolist(), 0]
    want = sum(
        np.roll(v[a], 2) * np.roll(v[b], 1) * v[c] for a, b, c in zip(sym, sym[1:], sym[2:]) if b)
    assert (made[0] == want).all() and lettered.tolist() == [True, False, False] and not made[1:].any()


def test_bundles_of_scripts_with_many_letters_take_bounded_memory():
    """512 texts of 170 random Han characters, by chunks of trigrams and by one: equal sums, without a large matrix."""
    import random
    import tracemalloc

    import pyarrow as pa

    r = random.Random(1)
    texts = pa.array(["".join(chr(0x4E00 + r.randrange(20_000)) for _ in range(170)) for _ in range(512)])
    profiler = langid.Profiler()
    tracemalloc.start()
    made, _ = profiler.bundles(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6, peak
    one = langid.Profiler().bundles(texts.slice(7, 1))[0]
    assert (made[7] == one[0]).all()
