"""Operators on small frames that carry the awkward rows, against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import diff, ingest, logs, ordering, profile, reads, review, runs, zones
from tidemark.plans import daily, tracking
from tidemark.sources.config import readable, type_table

KEYS = "type_key string, id string"
DIGEST = f"{KEYS}, metadata_hash string, content_hash string, has_body int, body_chars int, body_error string"


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def digest(spark, *items):
    return spark.createDataFrame([tuple(i) for i in items], DIGEST)


# ── ordering ──


def skewed(spark, n=4000, seed=1):
    """One key owns over half of the rows."""
    rnd = random.Random(seed)
    data = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(50)}", i) for i in range(n)]
    rnd.shuffle(data)
    return data, spark.createDataFrame(data, "k string, o long").repartition(8)


@pytest.mark.parametrize("width", [1, 7, 500, 10**6])
def test_numbered_is_row_number(spark, width):
    data, df = skewed(spark)
    out = ordering.numbered(df, ["k"], [F.col("o")], F.floor(F.col("o") / width), "n")
    seen, want = defaultdict(int), []
    for k, o in sorted(data, key=lambda x: x[1]):
        seen[k] += 1
        want.append((k, o, seen[k]))
    assert rows(out, "k", "o", "n") == sorted(want)


def test_latest_by_key(spark):
    data, df = skewed(spark)
    best = {}
    for k, o in data:
        best[k] = max(o, best.get(k, -1))
    assert rows(ordering.latest_by_key(df, ["k"], F.col("o"))) == sorted(best.items())


def test_latest_by_key_keeps_nulls_of_the_winner(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, o int, v string")
    assert rows(ordering.latest_by_key(df, ["k"], F.col("o"))) == [("a", 2, None)]


def test_top_per_group_limits_before_the_shuffle(spark):
    data, df = skewed(spark)
    out = ordering.top_per_group(df, ["k"], [F.desc("o")], 3)
    by = defaultdict(list)
    for k, o in data:
        by[k].append(o)
    assert rows(out) == sorted((k, o) for k, v in by.items() for o in sorted(v)[-3:])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pages_cover_everything_once(spark):
    df = spark.range(23)
    got = [r.id for p in range(1, 5) for r in ordering.page(df, [F.col("id")], p, 7).collect()]
    assert got == list(range(23))
    assert tuple(ordering.page_info(df, 7).first()) == (23, 4)
    assert tuple(ordering.page_info(df.limit(0), 7).first()) == (0, 1)
    assert ordering.page(df, [F.col("id")], 0, 0).count() == 23
    assert ordering.page(df, [F.col("id")], 1, -4).count() == 1


def test_page_past_the_end_is_the_last(spark):
    df = spark.range(23)
    assert [r.id for r in ordering.page_within(df, [F.col("id")], 99, 10).collect()] == [20, 21, 22]
    assert ordering.page_within(df.limit(0), [F.col("id")], 3, 10).count() == 0


# ── ingest ──


def hits(spark, *docs):
    df = spark.createDataFrame([(d, j, i) for i, (d, j) in enumerate(docs)], "document_type string, j string, seq long")
    return df.select("document_type", F.parse_json("j").alias("hit"), "seq")


def test_envelopes(spark):
    types = type_table(spark, {
        "Pol": {"documentType": "Policy"},
        "Man": {"documentType": "Manual", "metadata": ["title", "body"], "content": ["body"]},
        "Star": {"documentType": "Star", "metadata": ["*"], "content": "*"},
        "None": {},
    })
    good, bad = readable(types)
    assert rows(bad, "type_key") == [("None",)]
    h = hits(
        spark,
        ("Policy", '{"title":"T","uniqueId":"U 1","raw":{"kb_id":"","permanentid":"P/1","title":"raw","date":0,"updated_published_date":5}}'),
        ("Policy", '{"title":"T2","raw":{"permanentid":"P/1"}}'),
        ("Policy", '{"title":"","raw":null}'),
        ("Manual", '{"title":"M","extra":1,"raw":{"body":"text","clickableuri":"u","date":7}}'),
        ("Star", '{"title":"S","raw":{"x":1}}'),
    )
    out = ingest.envelopes(h, good, F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-01").cast("date"))
    got = {
        r.seq: (r.type_key, r.id, r.title, r.link, r.modified_ms, r.m, r.c, r.has_body)
        for r in out.select("*", F.to_json("metadata").alias("m"), F.to_json("content").alias("c")).collect()
    }
    assert got[0] == ("Pol", "P_1", "T", "", 5,
                      '{"date":0,"kb_id":"","permanentid":"P/1","title":"T","uniqueId":"U 1","updated_published_date":5}', "{}", 0)
    assert got[1][:2] == ("Pol", "P_1__2")
    assert got[2][:3] == ("Pol", "article", "")
    assert got[3] == ("Man", "M", "M", "u", 7, '{"title":"M"}', '{"body":"text"}', 1)
    # "*" as content takes everything; a list with the name "*" matches nothing else.
    assert got[4][5:7] == ("{}", '{"title":"S","x":1}')


def test_page_key(spark):
    h = hits(spark, ("T", '{"uniqueId":"u","raw":{"permanentid":"p"}}'), ("T", '{"uniqueId":"u","raw":{"permanentid":""}}'), ("T", '{"raw":{}}'))
    assert [r[0] for r in h.orderBy("seq").select(ingest.hit_page_key(F.col("hit"))).collect()] == ["p", "u", None]


def test_overall_health(spark):
    idx = lambda *s: spark.createDataFrame([("A", x) for x in s], "type_key string, status string")
    at = lambda d: spark.createDataFrame([(d,)], "d string").select(F.to_timestamp("d").alias("newest"), F.to_timestamp("d").alias("ran_at"))
    now = F.lit("2024-01-10").cast("timestamp")
    label = lambda i, a, b: runs.overall_health(i, at(a), at(b), now).first().health
    assert label(idx("ok", None), "2024-01-09", "2023-01-01") == "OK"
    assert label(idx("ok", "partial"), "2023-01-01", "2024-01-09") == "PARTIAL"
    assert label(idx("partial"), "2024-01-01", "2023-01-01") == "STALE"
    assert label(idx("ok"), None, None) == "PARTIAL"


def test_dedup_keeps_first_and_all_without_key(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("", 2), ("", 4), (None, 5), ("b", 6)], "p string, o long")
    assert rows(ingest.dedup_hits(df, F.col("p"), F.col("o")), "o") == [(1,), (2,), (4,), (5,), (6,)]


def test_type_filters(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "3")], KEYS)
    assert rows(ingest.only_types(df, ["a", "b"], ["b"]), "id") == [("1",)]
    assert rows(ingest.only_types(df, exclude=["a"]), "id") == [("2",), ("3",)]
    assert rows(ingest.only_types(df, ids=["3"]), "id") == [("3",)]


def test_incremental_read_is_half_open(spark):
    df = spark.createDataFrame([(1, 10, None), (2, 20, 5), (3, 10, 9), (4, None, None), (5, 19, 10)], "i int, d int, m int")
    assert rows(ingest.incremental_read(df, 10, 20, F.col("d"), F.col("m")), "i") == [(1,), (5,)]


def test_tracking_records(spark):
    df = spark.createDataFrame(
        [("T", "1", '{"c":5,"o":"7","u":null}'), ("T", "", '{}')], f"{KEYS}, j string"
    ).select(
        "type_key", "id", F.lit("T").alias("document_type"), F.lit("t").alias("title"), F.lit("l").alias("link"),
        F.lit(1).alias("modified_ms"), F.lit("c").alias("captured_at"), F.parse_json("j").alias("metadata"),
        F.parse_json(F.lit('{"body_text":"b"}')).alias("content"),
    )
    out = ingest.tracking_records(ingest.with_digest(df), "c", "o", "u")
    assert rows(out, "id", "created_ms", "original_published_ms", "updated_published_ms", "has_body") == [("1", 5, None, None, 1)]


# ── diff ──


def test_snapshot_diff_traps(spark):
    cols = DIGEST + ", updated_published_ms long, modified_ms long, first_seen_run string, last_seen_run string, last_changed_run string"
    t = spark.createDataFrame(
        [
            ("A", "same", "m", "c", 1, 1, None, 1, 1, "r0", "r1", "r0"),
            ("A", "err", "m", "c", 1, 1, "", 1, 1, "r0", "r1", None),
            ("A", "upd", "m", "c", 1, 1, None, None, 1, "r0", "r1", "r0"),
            ("A", "gone", "m", "c", 1, 1, None, 1, 1, "r0", "r1", "r0"),
            ("B", "same", "m2", "c", 1, 1, None, 1, 1, "r0", "r1", "r0"),
        ],
        cols,
    )
    c = spark.createDataFrame(
        [
            ("A", "same", "m", "c", 1, 1, None, 1, 1), ("A", "err", "m", "c", 1, 1, None, 1, 1),
            ("A", "upd", "m", "c", 1, 1, None, 2, None), ("B", "same", "m", "c2", 1, 1, "x", 1, 1),
            ("B", "new", "m", "c", 1, 1, None, 1, 1),
        ],
        DIGEST + ", updated_published_ms long, modified_ms long",
    )
    out = diff.snapshot_diff(t, c, F.lit("r2"))
    got = rows(out, "type_key", "id", "change_type", F.array_join("reasons", ","), "first_seen_run", "last_seen_run", "last_changed_run", "first_removed_run")
    assert got == [
        ("A", "err", "unchanged", "", "r0", "r2", "r2", None),
        ("A", "gone", "removed", "", "r0", "r1", "r0", "r2"),
        ("A", "same", "unchanged", "", "r0", "r2", "r0", None),
        ("A", "upd", "changed", "updated_published,modified", "r0", "r2", "r2", None),
        ("B", "new", "new", "", "r2", "r2", "r2", None),
        ("B", "same", "changed", "metadata,content,body_error", "r0", "r2", "r2", None),
    ]
    # The removed row is reported again by the next run, with its first removal kept.
    again = diff.snapshot_diff(out.drop("change_type", "reasons"), c, F.lit("r3")).filter("change_type = 'removed'")
    assert rows(again, "id", "last_seen_run", "first_removed_run") == [("gone", "r1", "r2")]


def test_classify_falls_back_to_live(spark):
    inc = spark.createDataFrame([("A", "1", "x"), ("A", "2", "x"), ("A", "3", "x")], f"{KEYS}, metadata_hash string")
    idx = spark.createDataFrame([("A", "1", "x")], f"{KEYS}, metadata_hash string")
    live = spark.createDataFrame([("A", "2", "y"), ("A", "1", "z")], f"{KEYS}, metadata_hash string")
    assert rows(diff.classify_incoming(inc, idx, live), "id", "op") == [("1", "unchanged"), ("2", "edited"), ("3", "new")]
    assert rows(diff.classify_incoming(inc, idx), "id", "op") == [("1", "unchanged"), ("2", "new"), ("3", "new")]


def test_reconcile_guard_and_apply(spark):
    live = spark.createDataFrame([("A", f"a{i}") for i in range(10)] + [("B", "b1__2"), ("B", "b2")], KEYS)
    up = spark.createDataFrame([("A", f"a{i}") for i in range(8)] + [("B", "b1"), ("B", "b1")], KEYS)
    now = F.lit("2024-01-01").cast("timestamp")
    out = tracking.reconcile(live, live, up, now, max_pct=0.5)
    assert rows(out["deletions"]) == [("A", "a8"), ("A", "a9"), ("B", "b2")]
    assert rows(out["guard"], "type_key", "deletions", "over_pct", "aborted") == [("A", 2, False, False), ("B", 1, False, False)]
    assert out["live"].count() == 9 and out["tracked"].count() == 9
    assert rows(out["deleted"], "id") == [("a8",), ("a9",), ("b2",)]
    assert rows(out["changelog"], "detail") == [("archived to deleted/A",)] * 2 + [("archived to deleted/B",)]
    # B is at 50 %, so a lower limit stops every type, and so does a low total.
    for kw in ({"max_pct": 0.49}, {"max_pct": 0.9, "max_deletes": 2}):
        stop = tracking.reconcile(live, live, up, now, **kw)
        assert stop["live"].count() == 12 and stop["deleted"].count() == 0
        assert stop["guard"].filter("aborted").count() == 2
    purged = tracking.reconcile(live, live, up, now, max_pct=0.5, purge=True)
    assert "deleted" not in purged and rows(purged["changelog"], "detail") == [("purged",)] * 3
    assert rows(diff.gone_upstream(live, up, strip_suffix=False).filter("type_key = 'B'"), "id") == [("b1__2",), ("b2",)]


def test_delete_guard_without_deletions(spark):
    live = spark.createDataFrame([("A", "1")], KEYS)
    assert rows(diff.delete_guard(live, live.limit(0)), "deletions", "aborted") == [(0, False)]


def test_two_sided_gap(spark):
    a = spark.createDataFrame([("1",), ("2",), ("2",)], "id string")
    b = spark.createDataFrame([("2",), ("3",)], "id string")
    assert rows(diff.two_sided_gap(a, b, ["id"])) == [("1", "left"), ("3", "right")]


# ── review and zones ──


@pytest.fixture
def world(spark):
    live = digest(
        spark,
        ("A", "edit", "m1", "c", 1, 10, None), ("A", "drop", "m", "c", 1, 10, None), ("A", "fail", "m", "c", 1, 10, None),
        ("A", "body", "m", "c1", 1, 10, None), ("A", "idle", "m", "c", 1, 10, None),
    )
    pending = digest(
        spark,
        ("A", "edit", "m2", "c", 1, 10, None), ("A", "drop", "m", "c0", 0, 0, None), ("A", "fail", "m", "ce", 1, 10, "HTTP 500"),
        ("A", "body", "m", "c2", 1, 4, None), ("A", "new", "m", "c", 1, 10, "HTTP 404"),
    )
    manifest = spark.createDataFrame(
        [("A", i, "r") for i in ("edit", "drop", "fail", "body", "new", "lost")], f"{KEYS}, run_date string"
    )
    return live, pending, manifest


def test_change_records(spark, world):
    live, pending, manifest = world
    out = review.change_records(manifest, pending, live, diff.hash_index(live))
    got = rows(out, "id", "op", F.array_join("risk", ","), F.array_join("changed", ","), "live_chars", "pending_chars")
    assert got == [
        ("body", "unchanged", "body-shrank-60%", "content", 10, 4),
        ("drop", "unchanged", "body-dropped", "content", 10, 0),
        ("edit", "changed", "", "metadata", 10, 10),
        ("fail", "unchanged", "body-error", "content", 10, 10),
        ("new", "new", "", "", 0, 10),
    ]


def test_gate_variants(spark, world):
    live, pending, manifest = world
    act = lambda **kw: rows(review.review_manifest(manifest, pending, live, **kw), "id", "action")
    assert act() == [("body", "promoted"), ("drop", "held-risky"), ("edit", "promoted"), ("fail", "held-risky"),
                     ("lost", "missing-pending"), ("new", "promoted")]
    assert {a for _, a in act(include_risky=True)} == {"promoted", "missing-pending"}
    assert dict(act(hold_flags=None))["body"] == "held-risky"
    assert {a for _, a in act(reject=True)} == {"rejected", "missing-pending"}
    assert {a for _, a in act(dry_run=True)} == {"preview", "missing-pending"}


def test_approve_run_and_resume(spark, world):
    live, pending, manifest = world
    now, run = F.lit("2024-01-01").cast("timestamp"), F.lit("r")
    out = daily.approve_run(daily.Staged(manifest, pending), live, diff.hash_index(live), run, now)
    assert rows(out.held, "id") == [("drop",), ("fail",)]
    assert rows(out.pending, "id") == [("drop",), ("fail",)]
    assert rows(out.archive, "id", "metadata_hash", "content_hash") == [("body", "m", "c1"), ("edit", "m1", "c")]
    assert rows(out.live, "id", "metadata_hash", "content_hash") == [
        ("body", "m", "c2"), ("drop", "m", "c"), ("edit", "m2", "c"), ("fail", "m", "c"), ("idle", "m", "c"), ("new", "m", "c"),
    ]
    assert rows(out.index, "id", "metadata_hash")[2] == ("edit", "m2")
    again = daily.approve_run(daily.Staged(manifest, pending), live, diff.hash_index(live), run, now, already=out.approved)
    assert again.approved.count() == 0 and again.held.count() == 2


def test_settle_holds(spark, world):
    live, pending, manifest = world
    now, run = F.lit("2024-01-01").cast("timestamp"), F.lit("r")
    held = daily.approve_run(daily.Staged(manifest, pending), live, diff.hash_index(live), run, now).held
    dec = lambda *d: spark.createDataFrame(list(d), f"{KEYS}, action string, actor string")
    out = daily.settle_holds(held, dec(("A", "drop", "approve", "ann"), ("A", "idle", "reject", "ann")), live, pending, run, now)
    assert rows(out["approved"], "id", "approved_by") == [("drop", "ann")]
    assert rows(out["remaining"], "id") == [("fail",)]
    assert out["live"].filter("id = 'drop'").first().content_hash == "c0"
    mixed = dec(("A", "drop", "approve", "ann"), (None, None, "auto_escalate", "clock"))
    out = daily.settle_holds(held, mixed, live, pending, run, now)
    assert rows(out["rejected"], "id", "actor") == [("fail", "clock")]
    assert "fail" not in {i for (i,) in rows(out["pending"], "id")}
    assert review.resolve(held, dec((None, None, "approve_all", "bo"))).filter("decision = 'approved'").count() == 2


def test_upserts_agree(spark, world):
    live, pending, _ = world
    assert rows(zones.upsert(live, pending)) == rows(zones.upsert_in_place(live, pending))


def test_restore(spark, world):
    live, _, _ = world
    at = lambda s: F.lit(s).cast("timestamp")
    arch = live.filter("id = 'edit'").withColumn("metadata_hash", F.lit("m0")).withColumn("archived_at", at("2023-01-01"))
    req = spark.createDataFrame([("A", "edit", "2023-01-01"), ("A", "edit", "2023-01-02")], f"{KEYS}, archived_at string")
    req = req.withColumn("archived_at", F.col("archived_at").cast("timestamp"))
    runs_ = spark.createDataFrame([("d1", "done"), ("d0", "track")], "run_date string, phase string")
    out = zones.restore(live, arch, req, runs_, F.lit("d1"), at("2024-01-01"))
    assert rows(out["result"], "status") == [("not-found",), ("restored",)]
    assert out["live"].filter("id = 'edit'").first().metadata_hash == "m0"
    assert rows(out["archive"], "id", "metadata_hash") == [("edit", "m1")]
    assert out["audit"].count() == 1
    shut = zones.restore(live, arch, req, runs_, F.lit("d0"), at("2024-01-01"))
    assert rows(shut["result"], "status") == [("refused",)] * 2 and rows(shut["live"]) == rows(live)


def test_delete_run_leaves_other_runs(spark):
    m = spark.createDataFrame([("A", "1", "r1"), ("A", "2", "r2"), ("A", "3", "r1")], f"{KEYS}, run_date string")
    pend = spark.createDataFrame([("A", "1"), ("A", "2")], KEYS)
    out = zones.delete_run({"manifest": m}, m, pend, "r1")
    assert rows(out["manifest"], "id") == [("2",)] and rows(out["pending"], "id") == [("2",)]


def test_consumer_is_idempotent(spark):
    cols = f"{KEYS}, content_hash string, n int"
    store = spark.createDataFrame([("A", "1", "c1", 0), ("A", "2", "c2", 0)], cols)
    live = spark.createDataFrame([("A", "1", "c1", 9), ("A", "2", "cX", 9), ("A", "3", "c3", 9)], cols)
    man = spark.createDataFrame([("A", "1"), ("A", "2"), ("A", "3"), ("A", "3"), ("A", "gone")], KEYS)
    once = tracking.consume(store, man, live)
    assert rows(once, "id", "n") == [("1", 0), ("2", 9), ("3", 9)]
    assert rows(tracking.consume(once, man, live)) == rows(once)
    assert rows(tracking.consume(store, man.limit(0), live)) == rows(store)


def test_merge_pending(spark):
    e = spark.createDataFrame([("B", "1", "old", 1), ("A", "2", "x", 2), ("B", "1", "new", 3)], f"{KEYS}, op string, seq int")
    assert [(r.type_key, r.op) for r in tracking.merge_pending(e, F.col("seq")).collect()] == [("A", "x"), ("B", "new")]


# ── profile, reads, runs, logs ──


def test_catalogue(spark):
    h = hits(
        spark,
        ("T", '{"title":"","raw":{"a":null,"b":[1],"title":"hidden"}}'), ("T", '{"title":"x\\ny","raw":{"a":true}}'),
        ("T", '{"title":5,"raw":{"a":{"k":1}}}'),
    ).withColumn("type_key", F.col("document_type"))
    totals = h.groupBy("type_key").agg(F.count(F.lit(1)).alias("total"))
    out = profile.field_catalogue(profile.field_rows(h), totals)
    got = rows(out, "field", "source", F.array_join("types", ","), "occurrences", "coverage", "sample")
    assert got == [
        ("a", "raw", "boolean,null,object", 3, 1.0, "true"), ("b", "raw", "list", 1, 0.333, "[1]"),
        ("title", "top", "number,string", 3, 1.0, "x y"),
    ]


def test_equal_tags_brute_force(spark):
    rnd = random.Random(3)
    data = []
    for i in range(300):
        tags = [t for t in "abcdef" if rnd.random() < 0.5]
        tags += [t + "2" for t in tags if t in "ab"] + (["all", "every"])
        data.append((i, tags))
    sets = defaultdict(set)
    for i, tags in data:
        for t in tags:
            sets[t].add(i)
    groups = defaultdict(list)
    for t, ids in sets.items():
        groups[frozenset(ids)].append(t)
    want = sorted((min(g), t, len(ids)) for ids, g in groups.items() for t in g if t != min(g))
    df = spark.createDataFrame(data, "id int, tags array<string>")
    assert rows(profile.equal_tags(df, F.col("tags"), F.col("id"))) == want


def test_metadata_diff(spark):
    f = lambda *d: spark.createDataFrame([("A", str(i), j) for i, j in enumerate(d)], f"{KEYS}, j string").select(
        "type_key", "id", F.parse_json("j").alias("metadata"))
    out = reads.metadata_diff(f('{"a":1,"b":null,"c":[1]}', '{"x":1}'), f('{"a":1.0,"c":[2],"d":"n"}', '{"x":1}'))
    assert rows(out, "field", "old", "new") == [("c", "[1]", "[2]"), ("d", "null", '"n"')]


def test_run_changes_and_locate(spark):
    r = spark.createDataFrame(
        [("A", "1", "d", "new", ["body-shrank-9%"]), ("A", "2", "d", "changed", ["body-dropped"]), ("A", "3", "e", "new", []),
         ("B", "4", "d", "new", None)],
        f"{KEYS}, run_date string, op string, risk array<string>",
    )
    assert rows(reads.run_changes(r, "d", risk="body-shrank"), "id") == [("1",)]
    assert rows(reads.run_changes(r, "d", op="new"), "id") == [("1",), ("4",)]
    assert rows(reads.run_changes(r, "d", type_key="B"), "id") == [("4",)]
    a, b = spark.createDataFrame([("A", "1")], KEYS), spark.createDataFrame([("A", "1"), ("A", "2")], KEYS)
    assert rows(reads.locate(a, b)) == [("A", "1", "live"), ("A", "2", "pending")]


def test_run_index_document(spark):
    import json

    t = spark.createDataFrame([("A", "ok", 3), ("B", "partial", 1)], "type_key string, status string, written long")
    doc = json.loads(runs.run_index_document(t, "full", F.lit("c"), F.lit("g")).first()[0])
    assert doc["counts"] == {"types": 2, "ok": 1, "partial": 1, "failed": 0} and doc["totalArticles"] == 4
    assert [x["type_key"] for x in doc["types"]] == ["A", "B"]


def test_terminal_gate(spark):
    t = spark.createDataFrame([("r", "A", True), ("r", "B", False)], "run_date string, type_key string, enrichable boolean")
    m = spark.createDataFrame([("r", "A", "dump"), ("r", "B", "dump")], "run_date string, type_key string, stage string")
    assert rows(runs.not_terminal(t, m), "type_key") == [("A",)]


def test_report_lines_and_summary(spark):
    good = "REPORT RequestId: 1 Duration: 12.50 ms  Billed Duration: 13 ms\tMemory Size: 512 MB\tMax Memory Used: 99 MB"
    df = spark.createDataFrame([(good,), ("REPORT nothing",), ("x " + good,), (None,)], "message string")
    got = [tuple(r)[1:] for r in logs.with_report_fields(df).collect()]
    assert got == [(12.5, 13, 512, 99)] + [(None,) * 4] * 3
    l = spark.createDataFrame([("", "act", None, "i"), ("m", "act", "t", "i")], "msg string, action string, type_key string, id string")
    assert [r[0] for r in l.select(logs.summary_line(l)).collect()] == ["act · i", "m"]


def test_metric_points(spark):
    l = spark.createDataFrame(
        [("article_enrich_failed", "ERROR", "s", "T", True), ("article_enrich_failed", "INFO", "s", "T", None), ("article_held", "INFO", "s", "T", None)],
        "action string, level string, source string, type_key string, final boolean",
    ).withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    assert rows(logs.metric_points(l), "metric", "dim") == [("ArticlesHeld", ""), ("EnrichFailed", "T"), ("ErrorCount", "s")]


def test_drill_down_by_kind(spark):
    import pytest

    from tidemark.operators import reads

    auto = spark.createDataFrame([("r1", "a", "T", "new", "auto"), ("r2", "b", "T", "new", "auto")], "run_date string, id string, type_key string, op string, approved_by string")
    track = spark.createDataFrame([("r1", "a", "T", "new", ["body-shrank-42%"], None), ("r1", "b", "T", "changed", ["body-error"], ["content"])],
                                  "run_date string, id string, type_key string, op string, risk array<string>, changed array<string>")
    tables = {"auto": auto, "track": track, "staged": auto.drop("approved_by"), "holds": auto.limit(0)}
    rows = reads.changes_of_kind(tables, "auto", "r1").collect()
    assert [tuple(r) for r in rows] == [("a", "T", "new", [], [], None, "auto")]
    assert [r["id"] for r in reads.changes_of_kind(tables, "track", "r1", risk="body-shrank").collect()] == ["a"]
    assert reads.changes_of_kind(tables, "track", "r1", risk="body-shrank").first()["changed"] == []
    assert reads.changes_of_kind(tables, "staged", "r1", type_key="T").count() == 1 and reads.changes_of_kind(tables, "holds", "r1").count() == 0
    for kind in ("staged", "other"):
        with pytest.raises(ValueError):
            reads.changes_of_kind(tables, kind, "r1")


def test_hidden_values_keep_all_types(spark):
    rows = [("A", ["x", "y", "x"]), ("B", ["x", "z"]), ("C", ["z", "x"]), ("C", None), (None, ["n"])]
    df = spark.createDataFrame(rows, "type_key string, words array<string>")
    found = profile.hidden_values(profile.facet(df, F.col("words"), ["type_key"]), limit=1)
    assert sorted((r["value"], r["n"], r["types"]) for r in found.collect()) == [("n", 1, []), ("y", 1, ["A"]), ("z", 2, ["B", "C"])]
    assert profile.hidden_values(profile.facet(df.limit(0), F.col("words"), ["type_key"]), limit=1).count() == 0
