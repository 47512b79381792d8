"""Whole jobs on small worlds."""

import json

from pyspark.sql import functions as F

from tidemark.operators import KEY, ingest
from tidemark.plans import daily
from tidemark.plans.sync import sync
from tidemark.sources.config import type_table
from tidemark.streaming import arrivals

def at(kind):
    return F.lit("2024-01-05").cast(kind)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def world(spark, *docs):
    df = spark.createDataFrame([(t, json.dumps(d), i) for i, (t, d) in enumerate(docs)], "document_type string, j string, seq long")
    return df.select("document_type", F.parse_json("j").alias("hit"), "seq")


def doc(key, lang, url="https://d.example/a/x.html"):
    return {"title": key, "clickUri": url, "raw": {"permanentid": key, "lang": lang}}


def test_sync(spark):
    types = type_table(spark, {
        "Man": {"documentType": "Manual", "metadata": ["lang"], "enrichable": True}, "Pol": {"documentType": "Policy", "metadata": ["lang"]},
    })
    page = "<body><main>" + "word " * 30 + "</main></body>"
    pages = spark.createDataFrame([("https://d.example/a/x.html", None, page)], "url string, final_url string, html string")
    first = world(spark, ("Manual", doc("m1", "en")), ("Manual", doc("m2", "en", "https://d.example/none")), ("Policy", doc("p1", "en")))
    envelope = ingest.envelopes(first, types, at("timestamp"), at("date")).drop("seq")
    empty = envelope.limit(0)
    tracked0 = empty.select(*KEY, "metadata_hash", "content_hash", "has_body", "body_chars", "body_error", "modified_ms")
    one = sync(first, types, empty, tracked0, pages, F.lit("r1"), at("date"), at("timestamp"), full=True)
    assert rows(one.live, "id", "has_body") == [("m1", 1), ("m2", 0), ("p1", 0)]
    assert rows(one.changes, "id", "change_type") == [("m1", "new"), ("m2", "new"), ("p1", "new")]
    assert one.pending.count() == 0 and one.deletions.count() == 0
    assert rows(one.live, "id", F.col("body_error").isNotNull()) == [("m1", False), ("m2", True), ("p1", False)]
    assert rows(one.bodies, "id", "outcome") == [("m1", "ok"), ("m2", "raised")]
    assert one.live.filter("id = 'm1'").first().body_chars == len(("word " * 30).strip())

    assert rows(one.report, "type_key", "enriched", "failed", "skipped", "staged") == [("Man", 1, 1, 0, 0)]
    assert rows(one.errors, "id", "link") == [("m2", "https://d.example/none")]

    # Fetched again: the body that is there stays, the new one waits; m2 had none, so its error is written at once.
    new_page = spark.createDataFrame([("https://d.example/a/x.html", None, page.replace("word", "news"))], pages.schema)
    redo = sync(first, types, one.live, one.state, new_page, F.lit("r1b"), at("date"), at("timestamp"), refetch=True)
    assert rows(redo.pending, "id", "has_body") == [("m1", 1)]
    assert rows(redo.live, "id", "content_hash") == rows(one.live, "id", "content_hash")
    assert redo.pending.first().content_hash != one.live.filter("id = 'm1'").first().content_hash
    assert rows(redo.report, "type_key", "enriched", "failed", "skipped", "staged") == [("Man", 1, 1, 0, 1)]

    second = world(spark, ("Manual", doc("m1", "de")), ("Policy", doc("p1", "en")), ("Policy", doc("p2", "fr")))
    two = sync(second, types, one.live, one.state, pages, F.lit("r2"), at("date"), at("timestamp"), full=True)
    assert rows(two.pending, "id") == [("m1",)]  # the edit waits, the live row keeps its body
    assert rows(two.live, "id", "has_body") == [("m1", 1), ("m2", 0), ("p1", 0), ("p2", 0)]
    assert rows(two.changes, "id", "change_type") == [("p2", "new")]
    assert rows(two.deletions, "id") == [("m2",)]
    assert rows(two.state, "id", "first_seen_run", "last_changed_run") == [
        ("m1", "r1", "r1"), ("m2", "r1", "r1"), ("p1", "r1", "r1"), ("p2", "r2", "r2"),
    ]


def test_edit_articles(spark):
    shape = lambda lang: spark.createDataFrame([("A", "1", f'{{"lang":"{lang}"}}')], "type_key string, id string, j string").select(
        *KEY, F.parse_json("j").alias("metadata"), F.parse_json(F.lit("{}")).alias("content"))
    cols = [*KEY, "metadata", "content", "metadata_hash", "content_hash", "has_body", "body_chars", "body_error"]
    live = ingest.with_digest(shape("en")).select(*cols)
    out = daily.edit_articles(live, shape("de"), F.lit("ann"), F.lit("d"), at("timestamp"))
    assert rows(out["live"], F.to_json("metadata")) == [('{"lang":"de"}',)]
    assert rows(out["archive"], F.to_json("metadata")) == [('{"lang":"en"}',)]
    assert rows(out["approved"], "op", "approved_by") == [("edited", "ann")]
    assert out["approved"].first().hash == out["index"].first().metadata_hash


def test_polling_consumer(spark, tmp_path):
    cols = "type_key string, id string, content_hash string"
    live = [spark.createDataFrame([("A", "1", "h1"), ("A", "2", "h2")], cols)]
    store = str(tmp_path / "store")
    run = arrivals.consume_epoch(spark, store, lambda: live[0], spark.createDataFrame([("A", "1", "old")], cols))
    man = lambda *ids: spark.createDataFrame([("A", i) for i in ids], "type_key string, id string")
    run(man("1", "1", "2"), 0)
    live[0] = spark.createDataFrame([("A", "1", "h1"), ("A", "2", "h9")], cols)
    for _ in range(2):
        run(man("2"), 1)
    got = arrivals.store_after(spark, store)
    assert rows(arrivals.store_after(spark, store, 0), "id", "content_hash") == [("1", "h1"), ("2", "h2")]
    assert rows(got, "id", "content_hash") == [("1", "h1"), ("2", "h9")]


def test_unknown_types(spark):
    t = spark.createDataFrame([("A",)], "type_key string")
    assert rows(ingest.unknown_types(t, spark.createDataFrame([("A",), ("B",), ("B",)], "type_key string")), "type_key") == [("B",)]
