"""Q-gram search against plain edit distance, with planted passages."""

import random

import numpy as np

from tidemark.llm import catalog, decontam


def distance(item, text):
    """Least edits of the whole item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["the", "and", "of", "tion", "Ing", "haérea", "stand", "whole", "other", "re", "in"]

    def text(n):
        return " ".join(rng.choice(vocab) + rng.choice(["", "", "er", "ly", "."]) for _ in range(n))

    items = [(i, text(rng.choice([3, 12, 40]))) for i in range(8)]
    docs = []
    for i in range(60):
        body = text(rng.choice([0, 5, 60]))
        if i % 2:
            p = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8, 20])):
                k = rng.randrange(len(p))
                what = rng.randrange(3)
                if what == 0:
                    p[k] = "#"
                elif what == 1 and len(p) > 5:
                    del p[k]
                else:
                    p.insert(k, "~")
            p = "".join(p)
            at = rng.randrange(len(body) + 1)
            body = body[:at] + (p.upper().replace("É", "é") if i % 4 == 1 else p).replace(" ", rng.choice([" ", "\n"])) + body[at:]
        docs.append((i, body))
    return items, docs


def test_against_edit_distance(spark, monkeypatch):
    for seed, chunk, held in ((1, 1 << 19, 1 << 20), (2, 900, 1 << 20), (3, 1 << 19, 300)):
        monkeypatch.setattr(decontam, "CHUNK", chunk)
        monkeypatch.setattr(decontam, "ITEM_BYTES", held)
        items, docs = corpus(seed)
        df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, found int")
        bench = spark.createDataFrame(items + [(90, None), (91, ""), (92, "short")], "item_id long, text string")
        got = {r["doc_id"]: {f["item"]: f["edits"] for f in r["found"]} for r in decontam.matches(df, bench, ["doc_id"]).collect()}
        lower = lambda t: bytes(decontam.LOWER[np.frombuffer(t.encode(), np.uint8)])
        hits = 0
        for d, t in docs:
            want = {}
            for i, x in items:
                size = len(x.encode())
                if size >= decontam.GRAM:
                    e = distance(lower(x), lower(t))
                    if e <= decontam.budget(size):
                        want[i] = e
            assert got[d] == want, (seed, d)
            hits += len(want)
        assert hits > 10


def test_odd_rows(spark):
    item = "exactly the passage of a benchmark, word by word"
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "a" * 1_200_000 + item + "b" * 900_000, "x"), (3, item, "x"), (3, item, "x"), (None, item.upper(), "x")],
        "doc_id long, text string, item string")
    bench = spark.createDataFrame([(5, item), (5, item), (6, "nowhere to be found in any text")], "item_id long, text string")
    rows = decontam.matches(docs, bench, ["doc_id"]).collect()
    assert sorted((str(r["doc_id"]), len(r["found"])) for r in rows) == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("3", 1), ("None", 1)]
    assert any(f["start"] == 1_200_000 and f["edits"] == 0 for r in rows for f in r["found"])
    left = decontam.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2]
    assert decontam.decontaminate(docs, bench.limit(0)).count() == 6
    assert decontam.decontaminate(docs.limit(0), bench).count() == 0


def test_rounds_and_long_items(spark, monkeypatch):
    """An item of 300,000 bytes, whole and in part (which does not count, whatever the length), and equal ids in several rounds."""
    rng = random.Random(4)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(1000)) for _ in range(33_000))[:300_000]
    short = ["the first passage of a benchmark item", "another passage with the very same id"]
    docs = [(1, "lead " + long + " tail"), (2, short[1] + " | " + short[0]), (3, long[:150_000]), (4, short[1][:-1] + "D"), (5, None), (6, long[:3000])]
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in docs], "doc_id long, text string, found int, _all int")
    bench = spark.createDataFrame([(7, short[0]), (7, short[1]), (8, long), (None, "an item that has no id of its own")], "item_id long, text string")
    for held in (1 << 23, 50):
        monkeypatch.setattr(decontam, "ITEM_BYTES", held)
        assert len(list(decontam.indexes(bench))) == (1 if held > 50 else 4)
        whole = (8, 0, 5, 5 + len(long))
        got = {r["doc_id"]: [tuple(f) for f in r["found"]] for r in decontam.matches(df, bench, ["doc_id"]).collect()}
        assert got == {1: [whole], 2: [(7, 0, 0, len(short[1]))], 3: [], 4: [(7, 0, 0, len(short[1]))], 5: [], 6: []}
        left = decontam.decontaminate(df, bench)
        assert left.columns == df.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 5, 6]


def test_banded_alignment_of_a_middling_item():
    """Edits in an item of 1,500 bytes: their number equals the plain edit distance within the budget."""
    rng = random.Random(6)
    item = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    text = list(item)
    for k in (100, 400, 401, 900, 1300):
        text[k] = "#"
    del text[700]
    text.insert(1100, "~")
    text = "lead " * 50 + "".join(text) + " tail" * 40
    index = decontam.Index([(1, item.encode())])
    raw = np.frombuffer(text.encode(), np.uint8)
    found = list(index.search(raw, np.array([0, len(raw)])))
    assert found and {f[2] for f in found} == {distance(item, text)} == {7}


def test_planted_passages(spark):
    got = catalog.QUERIES["op3_decontaminate"](spark, "/root/testdata/sf0.01").filter("contaminated")
    assert {29, 37, 39, 79, 95, 238, 248, 281, 339, 342} <= {r["doc_id"] for r in got.collect()}


def test_capitals_of_all_scripts(spark):
    """Passages in capitals are the passages, and places are those of the text as it stands."""
    items = [
        (1, "l'été dernier, la fenêtre fut brisée à côté du château"), (2, "σήμερα ο καιρός είναι καλός και ο ήλιος λάμπει"),
        (3, "сегодня хорошая погода и солнце светит весь день"), (4, "größere straßen führen über die brücken der stadt"),
    ]
    docs = [(i, "ⱥȺK É " + t.upper() + " É") for i, t in items] + [(9, "rien du tout, nichts, ничего"), (10, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items + [(7, "ΑΒΓΔΕ")], "item_id long, text string")
    got = {r["doc_id"]: [tuple(f) for f in r["found"]] for r in decontam.matches(df, bench, ["doc_id"]).collect()}
    lead = len("ⱥȺK É ".encode())
    assert got == {**{i: [(i, 0, lead, lead + len(t.upper().encode()))] for i, t in items}, 9: [], 10: []}


def test_not_utf8(spark):
    """A text with bytes that are no characters is searched with A-Z folded; the other texts of its batch are not touched by it."""
    item = "exactly the passage of a benchmark, word by word, é"
    df = spark.createDataFrame([(1, b"\xff\xc3 " + item.encode()), (2, item.upper().encode()), (3, b"\xc3")], "doc_id long, raw binary").coalesce(1)
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    got = {r["doc_id"]: [tuple(f) for f in r["found"]] for r in decontam.matches(df.selectExpr("doc_id", "cast(raw as string) text"), bench, ["doc_id"]).collect()}
    assert got == {1: [(5, 0, 3, 3 + len(item.encode()))], 2: [(5, 0, 0, len(item.encode()))], 3: []}


def test_passages_in_accented_capitals(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id in (1699, 6420)")
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    got = {r["doc_id"]: {f["item"] for f in r["found"]} for r in decontam.matches(docs, bench, ["doc_id"]).collect()}
    assert 130 in got[1699] and 37 in got[6420]


def search(items, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return sorted(decontam.Index.of(decontam.Index(items).arrays()).search(raw, np.array([0, len(raw)])))


def test_one_rule_for_every_length():
    """Whole items within 5 % edits count, halves do not, at lengths about a former limit and far beyond."""
    rng = random.Random(7)
    for size in (14, 100, 1500, 8191, 8192, 8193, 300_000):
        item = "".join(rng.choice("abcdefghijklmnop ") for _ in range(size))
        few = decontam.budget(size) * 2 // 3
        text = list(item)
        for k in rng.sample(range(size), min(few, 200)):
            text[k] = rng.choice(["#", "", text[k] + "~"])
        edited = "lead " + "".join(text) + " tail"
        assert search([(1, item.encode())], "lead " + item + " tail") == [(0, 1, 0, 5, 5 + size)]
        found = search([(1, item.encode())], edited)
        assert found and all(f[2] <= decontam.budget(size) for f in found), size
        if size <= 1500:
            assert min(f[2] for f in found) == distance(item, edited)
        assert search([(1, item.encode())], item[: size // 2] + " tail") == []
        many = list(item)
        for k in rng.sample(range(size), size // 9 + 1):
            many[k] = "#"
        assert size > 20_000 or search([(1, item.encode())], "".join(many)) == []


def test_items_shorter_than_a_gram():
    items = [(1, b"word by word!"), (2, b"cat"), (3, b"\xc3\xa9t\xc3\xa9"), (4, b"?"), (5, b"a passage longer than a gram")]
    text = "Cat, concatenate été étéx word  by word! word by word! a passage longer than a gram"
    plain = text.lower().encode().decode()
    at = {k: len(plain[: plain.index(v)].encode()) for k, v in ((3, "été "), (1, "word by word!"), (5, "a passage"))}
    assert search(items, text) == sorted([
        (0, 2, 0, 0, 3), (0, 3, 0, at[3], at[3] + 5), (0, 1, 0, at[1], at[1] + 13), (0, 5, 0, at[5], at[5] + 28)])
    assert search([(2, b"cat")], "concatenate") == [] and search([(2, b"cat")], "a") == []


def test_short_items_at_the_borders_of_pieces(monkeypatch):
    monkeypatch.setattr(decontam, "CHUNK", 64)
    text = "concat cat " * 60
    found = {(f[3], f[4]) for f in search([(2, b"cat")], text)}
    assert found == {(i * 11 + 7, i * 11 + 10) for i in range(60)}


def test_an_index_travels_as_plain_arrays():
    import pickle
    import pickletools

    made = pickle.dumps(decontam.Index([(1, b"a passage longer than a gram"), (2, b"cat")]).arrays())
    names = {str(arg) for _, arg, _ in pickletools.genops(made) if isinstance(arg, str)}
    assert not any("tidemark" in n for n in names)
