"""Scans and sinks on written files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import canon
from tidemark.operators import diff, ingest
from tidemark.sources import exports, readers, tables


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def tree(tmp_path):
    art = lambda **kw: json.dumps({"documentType": "Policy", "title": "t", "metadata": {"a": 1}, "content": {}, **kw}, indent=2)
    put(tmp_path / "Policy" / "K1.json", art(id="K1", modifiedMs=5))
    put(tmp_path / "Policy" / "K2.json", art(id="K2", modifiedMs="5", content={"body_text": "é"}))
    put(tmp_path / "Policy" / "K3.json", art(id=""))
    put(tmp_path / "Policy" / "K4.json", "{ not json")
    put(tmp_path / "Policy" / "_catalogue.json", art(id="no"))
    put(tmp_path / "_pending" / "Policy" / "K1.json", art(id="no"))
    put(tmp_path / "Bug_Tracker" / "B1.json", art(id="B1"))
    put(tmp_path / "Bug_Tracker" / "notes.txt", "x")
    return str(tmp_path)


def test_article_tree(spark, tree):
    good, bad = readers.article_tree(spark, tree)
    got = sorted((r.type_key, r.id, r.modified_ms) for r in good.collect())
    assert got == [("Bug_Tracker", "B1", None), ("Policy", "K1", 5), ("Policy", "K2", None)]
    assert [r.file_path.rsplit("/", 1)[1] for r in bad.collect()] == ["K4.json"]
    d = ingest.with_digest(good).filter("id = 'K2'").first()
    assert (d.has_body, d.body_chars, d.body_error) == (1, 1, None)


def test_json_lines(spark, tmp_path):
    put(tmp_path / "m.jsonl", '{"id":"1","n":1}\n\n{oops\n  \n{"id":"2","n":2}\n')
    path = str(tmp_path / "m.jsonl")
    assert sorted(r.id for r in readers.json_lines(spark, path, "id string, n int").collect()) == ["1", "2"]
    assert readers.json_lines(spark, path, "id string, n int").count() == 2
    assert [r[0] for r in readers.json_lines_rejects(spark, path).collect()] == ["{oops"]


def test_hash_index_file(spark, tmp_path):
    with gzip.open(tmp_path / "current.json.gz", "wt") as f:
        json.dump({"Policy K1": "h1", "Bug_Tracker a b": "h2", "odd": "h3"}, f)
    got = sorted(tuple(r) for r in readers.hash_index_file(spark, str(tmp_path / "current.json.gz")).collect())
    assert got == [("Bug_Tracker", "a b", "h2"), ("Policy", "K1", "h1")]
    assert readers.empty_index(spark).count() == 0


def test_article_export_reads_back(spark, tree, tmp_path):
    good, _ = readers.article_tree(spark, tree)
    out = str(tmp_path / "export")
    exports.write_article_json(good, out)
    back = readers.article_lines(spark, out)
    hashes = lambda df, m: sorted(r[0] for r in df.select(canon.canonical_hash(m)).collect())
    assert hashes(back, F.try_variant_get("v", "$.metadata", "variant")) == hashes(good, F.col("metadata"))


def test_csv(spark, tmp_path):
    df = spark.createDataFrame(
        [('a "q"', "l", "two\nlines, comma", "", None)],
        "name string, link string, summary string, publication_date string, modification_date string",
    )
    line = '"a ""q""","l","two lines, comma","",""'
    assert [r[0] for r in exports.csv_lines(df).collect()] == [line]
    exports.write_csv(df, str(tmp_path / "c"))
    text = "".join(p.read_text() for p in (tmp_path / "c").glob("part-*"))
    # Every part file has the header.
    assert set(text.splitlines()) == {'"Name","Link","Summary","Publication Date","Modification Date"', line}


def test_monthly_trail(spark, tmp_path):
    rec = spark.createDataFrame([("1", "T", "changed", "auto", "2024-01-31"), ("2", "T", "new", None, "2024-01-31")],
                                "id string, type string, op string, approved_by string, run_date string")
    base = str(tmp_path / "audit")
    for day in ("2024-01-31", "2024-02-01"):
        exports.write_audit(rec, base, "auto", "holds", F.lit(day).cast("timestamp"))
    read = lambda name: spark.read.json(f"{base}/{name}")
    assert read("changed_ids").count() == 4 and read("changes").count() == 2
    assert {r.actor for r in read("decisions").collect()} == {"auto"}
    assert read("decisions").filter("month = '2024-02'").count() == 2


def test_run_partitions_are_retried_alone(spark, tmp_path):
    path = str(tmp_path / "versions")
    v = lambda run, n: spark.createDataFrame([("A", str(i), run, n) for i in range(2)], "type_key string, id string, run_date string, n int")
    tables.append_versions(v("2024-01-01", 1), path)
    tables.append_versions(v("2024-01-02", 1), path)
    tables.append_versions(v("2024-01-02", 2), path)
    got = sorted((str(r.run_date), r.n) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-01", 1)] * 2 + [("2024-01-02", 2)] * 2
    snap = str(tmp_path / "state")
    tables.write_snapshot(v("x", 1), snap, "r1")
    tables.write_snapshot(v("x", 2), snap, "r2")
    assert {r.n for r in tables.read_snapshot(spark, snap, "r1").collect()} == {1}


def test_documents_of_reads_listed_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    cols = "type_key string, id string, run_date string, content_hash string, body_text string"
    tables.append_versions(spark.createDataFrame([("A", "1", "d1", "h1", "one"), ("A", "1", "d2", "h2", "two")], cols), path)
    state = spark.createDataFrame([("A", "1", "d2", "h2")], "type_key string, id string, run_date string, content_hash string")
    v = spark.read.schema("id string, content_hash string, body_text string, run_date string, type_key string").parquet(path)
    assert [r.body_text for r in tables.documents_of(state, v).collect()] == ["two"]


def test_bucketed_diff_needs_no_exchange_of_the_table(spark, tmp_path):
    live = spark.createDataFrame([("A", str(i), "h") for i in range(50)], "type_key string, id string, metadata_hash string")
    spark.sql("DROP TABLE IF EXISTS tidemark_live")
    try:
        tables.write_bucketed(live, "tidemark_live", 4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = diff.classify_incoming(live.withColumn("metadata_hash", F.lit("x")), spark.table("tidemark_live"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert out.filter("op = 'edited'").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS tidemark_live")


def test_enrich_report_document(spark):
    r = spark.createDataFrame([("A", 1, 2, 3, 6, 1)], "type_key string, enriched int, failed int, skipped int, total int, staged int")
    doc = json.loads(exports.enrich_report_document(r, F.lit("now")).first()[0])
    assert doc == {"generatedAt": "now", "types": [{"type_key": "A", "enriched": 1, "failed": 2, "skipped": 3, "total": 6, "staged": 1}]}
