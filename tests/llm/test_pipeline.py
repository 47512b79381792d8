"""The pipeline on a small table: every stage keeps the columns, takes effect, and the last mixes what is left."""

import random

import corpus_pipeline
from tidemark.llm import simhash

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bad = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
    ids = [r["doc_id"] for r in docs.collect()]
    assert len(bad) > 10
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert new.columns == docs.columns
        seen.append({r["doc_id"]: r["text"] for r in new.collect()})
        assert len(seen[-1]) == new.count()
        docs = new
    quality, first, clean, private = seen
    assert len(bad & set(quality)) <= 0.1 * len(bad) and len(quality) > 0.75 * len(ids)
    texts = list(first.values())
    assert set(first) < set(quality) and len(texts) == len(set(texts))
    assert set(clean) < set(first) and set(private) == set(clean)
    assert any("@" in t for t in clean.values()) and not any("@example" in (t or "") for t in private.values())
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in mixed} == set(private)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in mixed)
    per, aim = {}, {}
    for r in mixed:
        per[r["source"]] = per.get(r["source"], 0) + r["taken"]
        aim[r["source"]] = r["target"]
    assert all(abs(per[s] - aim[s]) <= 0.05 * aim[s] + 64 for s in per)


def write(spark, folder, documents, labels, benchmark):
    for name, df in (("documents", documents), ("labels", labels), ("benchmark", benchmark)):
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, _spot string, _text string, found int, spans string, size int, `a b` int"


def test_odd_rows_through_all_stages(spark, tmp_path):
    """Nulls in any column, repeated rows, long texts and further columns with names the stages use."""
    prose = ["plain words of text number %d that nobody repeats %s" % (i, " ".join(f"x{i * j % 89}" for j in range(40))) for i in range(12)]
    rows = [(i, t, "en", "s" if i % 3 else None, len(t), 0.5, "k", "t", 1, "p", 2, 3) for i, t in enumerate(prose)]
    rows += [rows[3], rows[3], (None, None, None, None, None, None, None, None, None, None, None, None), (50, "", "en", "s", 0, 1.0, "", "", 0, "", 0, 0)]
    rows += [(60, "word " * 60_000 + "mail me@example.com now", None, "s", None, None, "", None, 0, "", 0, 0), (61, " ".join(f"z{i}" for i in range(60)) + " exactly the passage of a benchmark, word by word", "en", "s", 1, 0.1, "", "", 0, "", 0, 9)]
    docs = spark.createDataFrame(rows, ODD)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)] + [(3, 1, 0), (None, 0, 0), (60, None, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "exactly the passage of a benchmark, word by word"), (2, None)], "item_id long, text string")
    write(spark, tmp_path, docs, labels, bench)
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before, seen = now.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stored(stage(spark, now, str(tmp_path)), name)
        assert now.columns == before and now.dtypes == docs.dtypes
        seen[name] = now.collect()
    ids = {name: sorted(str(r["doc_id"]) for r in found) for name, found in seen.items()}
    assert len(ids["quality"]) == len(rows)
    assert ids["near_copies"] == sorted([*map(str, range(12)), "50", "60", "61"])
    assert ids["decontamination"] == sorted(set(ids["near_copies"]) - {"61"})
    assert ids["personal_data"] == ids["decontamination"]
    last = {r["doc_id"]: r for r in seen["personal_data"]}
    assert "@" not in last[60]["text"] and last[60]["n_chars"] == len(last[60]["text"]) and last[2]["a b"] == 3 and last[2]["score"] == 0.5
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in mixed) == ids["personal_data"]


def test_empty_tables_through_all_stages(spark, tmp_path):
    write(spark, tmp_path, spark.createDataFrame([], ODD), spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_are_those_of_op5_and_of_equal_shingles(spark):
    """No two documents of one op5 component stay, whatever their sets, nor two of similar sets, whatever their fingerprints; chains of both kinds hold."""
    rng = random.Random(14)
    vocab = [f"y{i}" for i in range(3000)]
    line = ["same", "line", "again", "and", "again"]
    texts = [line * 40 + rng.choices(vocab, k=60) for _ in range(6)]  # equal fingerprints, sets of 0.1 or less
    for _ in range(12):  # sets of 0.83, fingerprints further apart
        w = rng.choices(vocab, k=240)
        texts += [w, w[:200]]
    texts += [texts[0] + texts[-1][:4]]
    w = line * 40 + rng.choices(vocab, k=400)  # similar sets next to the repeated line, one chain
    texts += [w, w[:-20], rng.choices(vocab, k=150), rng.choices(vocab, k=150)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    component = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    sets = [{" ".join(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root, only_prints, only_sets = list(range(len(texts))), 0, 0
    for i in range(len(texts)):
        for j in range(i):
            by_print, by_set = component[i] == component[j], len(sets[i] & sets[j]) * 5 >= len(sets[i] | sets[j]) * 4
            only_prints += by_print and not by_set
            only_sets += by_set and not by_print
            if by_print or by_set:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert only_prints > 10 and only_sets > 5
    got = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(root))
