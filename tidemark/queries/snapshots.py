"""Snapshot diff, classification, deletion and consumer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import KEY, diff, ingest, reads, runs, zones
from tidemark.operators.ordering import latest_by_key
from tidemark.plans import tracking
from tidemark.queries import scenario as S
from tidemark.queries.registry import ORACLE, query
from tidemark.session import scratch_dir
from tidemark.sources import buckets, readers

R1, R2, R3 = "2024-01-01", "2024-01-02", "2024-01-03"


def _tracked(spark, sf):
    p = S.prior(spark, sf)
    for c in ("first_seen_run", "last_seen_run", "last_changed_run"):
        p = p.withColumn(c, F.lit(R1))
    return p.withColumn("first_removed_run", F.lit(None).cast("string"))


def _delta(spark, sf):
    return diff.snapshot_diff(_tracked(spark, sf), S.current(spark, sf), F.lit(R2))


DIFF_SQL = f"""{S.SNAPSHOTS_SQL},
delta AS (
  SELECT coalesce(c.type_key, p.type_key) AS type_key, coalesce(c.id, p.id) AS id,
    CASE WHEN p.id IS NULL THEN 'new' WHEN c.id IS NULL THEN 'removed'
         WHEN concat_ws(',', CASE WHEN p.metadata_hash <> c.metadata_hash THEN 'm' END,
              CASE WHEN p.content_hash <> c.content_hash THEN 'c' END,
              CASE WHEN p.modified_ms <> c.modified_ms THEN 'd' END,
              CASE WHEN coalesce(p.body_error, '') <> coalesce(c.body_error, '') THEN 'e' END) <> '' THEN 'changed'
         ELSE 'unchanged' END AS change_type,
    CASE WHEN p.id IS NULL OR c.id IS NULL THEN '' ELSE concat_ws(',',
      CASE WHEN p.metadata_hash <> c.metadata_hash THEN 'metadata' END,
      CASE WHEN p.content_hash <> c.content_hash THEN 'content' END,
      CASE WHEN p.modified_ms <> c.modified_ms THEN 'modified' END,
      CASE WHEN coalesce(p.body_error, '') <> coalesce(c.body_error, '') THEN 'body_error' END) END AS reasons
  FROM current_ c FULL OUTER JOIN prior p ON p.type_key = c.type_key AND p.id = c.id)
"""


@query("snapshot_diff_summary", DIFF_SQL + """
SELECT type_key, count(*) FILTER (change_type <> 'removed') AS scanned,
  count(*) FILTER (change_type = 'new') AS new, count(*) FILTER (change_type = 'changed') AS changed,
  count(*) FILTER (change_type = 'unchanged') AS unchanged, count(*) FILTER (change_type = 'removed') AS removed
FROM delta GROUP BY type_key""")
def snapshot_diff_summary(spark, sf):
    return diff.track_summary(_delta(spark, sf))


@query("snapshot_diff_rows", DIFF_SQL + f"""
SELECT type_key, id, change_type, reasons,
  CASE WHEN change_type = 'new' THEN '{R2}' ELSE '{R1}' END AS first_seen_run,
  CASE WHEN change_type = 'removed' THEN '{R1}' ELSE '{R2}' END AS last_seen_run,
  CASE WHEN change_type IN ('new', 'changed') THEN '{R2}' ELSE '{R1}' END AS last_changed_run,
  CASE WHEN change_type = 'removed' THEN '{R2}' END AS first_removed_run
FROM delta""")
def snapshot_diff_rows(spark, sf):
    return _delta(spark, sf).select(
        *KEY, "change_type", F.array_join("reasons", ",").alias("reasons"),
        "first_seen_run", "last_seen_run", "last_changed_run", "first_removed_run",
    )


COMPARED = [c for _, c in diff.DIFF_COLUMNS]


def _two_commits(spark, sf):
    """Tracked and current snapshot as commits of one bucketed table, digests only."""
    path = scratch_dir(spark, "state")
    tracked, current = _tracked(spark, sf).drop("body_text"), S.current(spark, sf).drop("body_text")
    buckets.create(tracked, path, R1, COMPARED)
    buckets.create(current, path, R2, COMPARED)
    return path, tracked, current


@query("tree_diff_rows", ORACLE["snapshot_diff_rows"])
def tree_diff_rows(spark, sf):
    """The same rows from the hash trees: both sides are read and joined where digests differ; of the rest the tracked side is listed."""
    path, tracked, current = _two_commits(spark, sf)
    delta, marked = buckets.tree_diff(tracked, current, path, R1, R2, F.lit(R2))
    rest = buckets.pointers(spark, path, R1).select("bucket", "type_key").join(marked, ["bucket", "type_key"], "left_anti")
    stamps = ["first_seen_run", "last_seen_run", "last_changed_run", "first_removed_run"]
    same = buckets.read(tracked, path, R1, rest).withColumn("last_seen_run", F.lit(R2)).select(
        *KEY, F.lit("unchanged").alias("change_type"), F.lit("").alias("reasons"), *stamps)
    return delta.select(*KEY, "change_type", F.array_join("reasons", ",").alias("reasons"), *stamps).unionByName(same)


@query("tree_diff_summary", ORACLE["snapshot_diff_summary"])
def tree_diff_summary(spark, sf):
    """The counts from the hash trees: rows where digests agree are counted without being read."""
    path, tracked, current = _two_commits(spark, sf)
    delta, marked = buckets.tree_diff(tracked, current, path, R1, R2, F.lit(R2))
    return buckets.tree_summary(delta, marked, path, R2)


@query("track_run_totals", DIFF_SQL + """
SELECT count(DISTINCT type_key) AS types, count(*) FILTER (change_type <> 'removed') AS scanned,
  count(*) FILTER (change_type = 'new') AS new, count(*) FILTER (change_type = 'changed') AS changed,
  count(*) FILTER (change_type = 'unchanged') AS unchanged, count(*) FILTER (change_type = 'removed') AS removed
FROM delta""")
def track_run_totals(spark, sf):
    return diff.run_totals(diff.track_summary(_delta(spark, sf)))


@query("change_rows", DIFF_SQL + f"""
SELECT '{R2}' AS run_id, type_key, id, change_type, reasons AS detail FROM delta WHERE change_type <> 'unchanged'""")
def change_rows(spark, sf):
    return diff.change_rows(_delta(spark, sf), F.lit(R2))


@query("carried_stamps", DIFF_SQL + f"""
SELECT type_key, id, CASE WHEN change_type = 'new' THEN '{R2}' ELSE '{R1}' END AS first_seen_run,
  CASE WHEN change_type = 'new' THEN '{R2}' ELSE '{R3}' END AS last_seen_run,
  CASE WHEN change_type = 'new' THEN '{R2}' WHEN change_type = 'changed' THEN '{R3}' ELSE '{R1}' END AS last_changed_run,
  CASE WHEN change_type = 'new' THEN '{R3}' END AS first_removed_run
FROM delta""")
def carried_stamps(spark, sf):
    """Three runs in a row: the edits of the second are undone in the third."""
    second = diff.snapshot_diff(_tracked(spark, sf), S.current(spark, sf), F.lit(R2)).drop("change_type", "reasons")
    third = diff.snapshot_diff(second, S.prior(spark, sf), F.lit(R3))
    return third.select(*KEY, "first_seen_run", "last_seen_run", "last_changed_run", "first_removed_run")


@query("classify_incoming", f"""{S.SNAPSHOTS_SQL}
SELECT c.type_key, c.id, p.metadata_hash AS prior_hash,
  CASE WHEN p.id IS NULL THEN 'new' WHEN p.metadata_hash = c.metadata_hash THEN 'unchanged' ELSE 'edited' END AS op
FROM current_ c LEFT JOIN prior p ON p.type_key = c.type_key AND p.id = c.id""")
def classify_incoming(spark, sf):
    live = S.prior(spark, sf)
    # The index lacks the failed documents, so a gated run falls back to their live rows.
    index = diff.hash_index(live.filter(S.fate(F.col("doc_id")) != "failed"))
    out = diff.classify_incoming(S.current(spark, sf).select(*KEY, "metadata_hash"), index, live)
    return out.select(*KEY, "prior_hash", "op")


@query("skip_unchanged", f"""{S.SNAPSHOTS_SQL}
SELECT c.type_key, c.id, CASE WHEN p.id IS NULL THEN 'new' ELSE 'changed' END AS op
FROM current_ c LEFT JOIN prior p ON p.type_key = c.type_key AND p.id = c.id
WHERE p.id IS NULL OR p.metadata_hash <> c.metadata_hash""")
def skip_unchanged(spark, sf):
    index = diff.hash_index(S.prior(spark, sf))
    out = diff.changed_only(diff.classify_incoming(S.current(spark, sf).select(*KEY, "metadata_hash"), index))
    return out.select(*KEY, "op")


@query("hash_index", f"""WITH {S.EVERY_SQL}
SELECT type_key, id, metadata_hash FROM every""")
def hash_index(spark, sf):
    return diff.hash_index(S.everything(spark, sf))


@query("hash_index_import", ORACLE["hash_index"])
def hash_index_import(spark, sf):
    """The index of all documents written as one JSON map and read entry by entry."""
    path = scratch_dir(spark, "index-map")
    readers.write_hash_index_entries(diff.hash_index(S.everything(spark, sf)), path)
    return readers.hash_index_entries(spark, path)


def _suffixed(spark, sf):
    """Tracked rows in which one language carries a collision suffix the upstream does not know."""
    p = S.prior(spark, sf)
    return p.withColumn("id", F.when(F.col("lang") == "de", F.concat("id", F.lit("__2"))).otherwise(F.col("id")))


SUFFIXED_SQL = """
tracked AS (SELECT type_key, CASE WHEN lang = 'de' THEN id || '__2' ELSE id END AS id, id AS base FROM prior)"""


@query("reconcile_deletions", f"""{S.SNAPSHOTS_SQL}, {SUFFIXED_SQL}
SELECT t.type_key, t.id FROM tracked t
WHERE NOT EXISTS (SELECT 1 FROM current_ c WHERE c.type_key = t.type_key AND c.id = t.base)""")
def reconcile_deletions(spark, sf):
    upstream = ingest.only_types(S.current(spark, sf).select(*KEY))
    return diff.gone_upstream(_suffixed(spark, sf), upstream).select(*KEY)


@query("sync_deletions", f"""{S.SNAPSHOTS_SQL}, {SUFFIXED_SQL}
SELECT t.type_key, t.id FROM tracked t
WHERE NOT EXISTS (SELECT 1 FROM current_ c WHERE c.type_key = t.type_key AND c.id = t.id)""")
def sync_deletions(spark, sf):
    return diff.gone_upstream(_suffixed(spark, sf), S.current(spark, sf), strip_suffix=False).select(*KEY)


GUARD_SQL = f"""{S.SNAPSHOTS_SQL},
counts AS (
  SELECT p.type_key, count(*) AS db_count, count(*) FILTER (c.id IS NULL) AS deletions
  FROM prior p LEFT JOIN current_ c ON p.type_key = c.type_key AND p.id = c.id GROUP BY p.type_key)
"""


@query("delete_guard", GUARD_SQL + """
SELECT type_key, db_count, deletions, CAST(deletions AS DOUBLE) / db_count > 0.1 AS over_pct,
  (SELECT bool_or(CAST(deletions AS DOUBLE) / db_count > 0.1) OR sum(deletions) > 100000 FROM counts) AS aborted
FROM counts""")
def delete_guard(spark, sf):
    p = S.prior(spark, sf)
    gone = diff.gone_upstream(p, S.current(spark, sf))
    return diff.delete_guard(p, gone, max_pct=0.1, max_deletes=100_000)


@query("reconcile_apply", f"""{GUARD_SQL},
verdict AS (SELECT bool_or(CAST(deletions AS DOUBLE) / db_count > 0.9) AS aborted FROM counts)
SELECT type_key, db_count - CASE WHEN aborted THEN 0 ELSE deletions END AS kept,
  CASE WHEN aborted THEN 0 ELSE deletions END AS deleted
FROM counts, verdict""")
def reconcile_apply(spark, sf):
    live = S.prior(spark, sf)
    out = tracking.reconcile(live, live, S.current(spark, sf), S.now(), max_pct=0.9)
    both = out["live"].select("type_key", F.lit(0).alias("d")).unionByName(
        out["deleted"].select("type_key", F.lit(1).alias("d"))
    )
    return both.groupBy("type_key").agg(
        F.count_if(F.col("d") == 0).alias("kept"), F.count_if(F.col("d") == 1).alias("deleted")
    )


@query("id_set_gap", f"""{S.SNAPSHOTS_SQL}
SELECT coalesce(p.id, c.id) AS id, CASE WHEN c.id IS NULL THEN 'left' ELSE 'right' END AS side
FROM (SELECT DISTINCT id FROM prior) p FULL OUTER JOIN (SELECT DISTINCT id FROM current_) c ON p.id = c.id
WHERE p.id IS NULL OR c.id IS NULL""")
def id_set_gap(spark, sf):
    return diff.two_sided_gap(S.prior(spark, sf), S.current(spark, sf), ["id"])


@query("consumer_upsert", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL}
SELECT coalesce(s.type_key, p.type_key) AS type_key, coalesce(s.id, p.id) AS id,
  coalesce(s.content_hash, p.content_hash) AS content_hash,
  CASE WHEN s.id IS NULL OR s.content_hash = p.content_hash THEN p.lang ELSE s.lang END AS lang
FROM prior p FULL OUTER JOIN staged s ON p.type_key = s.type_key AND p.id = s.id""")
def consumer_upsert(spark, sf):
    cols = [*KEY, "content_hash", "lang"]
    store = S.prior(spark, sf).select(*cols)
    # The manifest arrives twice; the second delivery changes nothing.
    manifest = S.staged(spark, sf).select(*KEY)
    live = S.current(spark, sf).select(*cols)
    return tracking.consume(store, manifest.unionByName(manifest), live)


@query("bucket_upsert", ORACLE["consumer_upsert"])
def bucket_upsert(spark, sf):
    """A consumer's store as a bucketed table; the batch arrives twice, and the second commit touches nothing."""
    cols, path = [*KEY, "content_hash", "lang"], scratch_dir(spark, "store")
    store, live, manifest = S.prior(spark, sf).select(*cols), S.current(spark, sf).select(*cols), S.staged(spark, sf).select(*KEY)
    buckets.create(store, path, R1)
    for base, commit in ((R1, R2), (R2, R3)):
        held = buckets.read(store, path, base).drop("bucket")
        buckets.upsert(path, base, commit, tracking.fresh_for(held, manifest, live).select(*cols))
    return buckets.read(store, path, R3).select(*cols)


@query("backfill_replay", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL},
picked AS (SELECT * FROM staged WHERE has_body = 1)
SELECT type_key, count(*) AS n, count(*) FILTER (replayed) AS replayed FROM (
  SELECT coalesce(s.type_key, p.type_key) AS type_key,
    s.id IS NOT NULL AND (p.id IS NULL OR p.content_hash <> s.content_hash) AS replayed
  FROM prior p FULL OUTER JOIN picked s ON p.type_key = s.type_key AND p.id = s.id)
GROUP BY type_key""")
def backfill_replay(spark, sf):
    store = S.prior(spark, sf).select(*KEY, "content_hash", F.lit("store").alias("origin"))
    live = S.current(spark, sf).select(*KEY, "content_hash", F.lit("replay").alias("origin"))
    # Two runs staged the rows: those with a body in one run, the others in the next.
    manifests = S.staged(spark, sf).select(
        *KEY, F.when(F.col("has_body") == 1, R2).otherwise(R3).alias("run_date")
    )
    out = tracking.backfill(store, manifests, live, R2)
    return out.groupBy("type_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("origin") == "replay").alias("replayed")
    )


@query("changes_since", DIFF_SQL + """
SELECT change_type, count(*) AS n FROM delta WHERE change_type <> 'unchanged' GROUP BY change_type""")
def changes_since(spark, sf):
    """Changes of two runs; only the second is after the moment asked for."""
    first = _tracked(spark, sf).select(
        F.lit(R1).alias("run_id"), *KEY, F.lit("new").alias("change_type"), F.lit("").alias("detail")
    )
    changes = first.unionByName(diff.change_rows(_delta(spark, sf), F.lit(R2)))
    ran = changes.select("run_id").distinct().withColumn("ran_at", F.to_timestamp("run_id"))
    return reads.changes_since(changes, ran, F.lit(R1).cast("timestamp"))


@query("run_index", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL},
per AS (
  SELECT c.type_key, count(*) AS expected, count(*) FILTER (s.id IS NOT NULL AND c.body_error IS NULL) AS written,
    count(*) FILTER (s.id IS NULL) AS skipped
  FROM current_ c LEFT JOIN staged s ON s.type_key = c.type_key AND s.id = c.id GROUP BY c.type_key)
SELECT count(*) AS types, count(*) FILTER (written + skipped >= expected) AS ok,
  count(*) FILTER (written + skipped < expected) AS "partial", 0::BIGINT AS failed,
  CAST(sum(written) AS BIGINT) AS total_articles FROM per""")
def run_index(spark, sf):
    """A full read in which the failed documents were not written: their types are partial."""
    s = S.staged(spark, sf).select(*KEY, F.lit(True).alias("moved"))
    rows = S.current(spark, sf).select(*KEY, "body_error").join(s, KEY, "left")
    moved, failed = F.col("moved").isNotNull(), F.col("body_error").isNotNull()
    per = rows.groupBy("type_key").agg(
        F.count(F.lit(1)).alias("expected"), F.count_if(moved & ~failed).alias("written"),
        F.count_if(~moved).alias("skipped"),
    ).select(
        "*", F.lit(0).alias("staged"), F.lit(0).alias("write_errors"), F.lit(None).cast("string").alias("error")
    )
    return runs.run_index(runs.dump_index(per, F.lit(True), F.lit(False)))


@query("stage_split", f"""{S.SNAPSHOTS_SQL}
SELECT c.type_key, count(*) FILTER (p.id IS NULL) AS to_live,
  count(*) FILTER (p.metadata_hash <> c.metadata_hash) AS to_pending
FROM current_ c LEFT JOIN prior p ON p.type_key = c.type_key AND p.id = c.id GROUP BY c.type_key""")
def stage_split(spark, sf):
    """Sync form: new rows go to live at once, edited ones wait in pending."""
    index = diff.hash_index(S.prior(spark, sf))
    live, pending = zones.stage(diff.classify_incoming(S.current(spark, sf).select(*KEY, "metadata_hash"), index))
    n = lambda df, name: df.groupBy("type_key").agg(F.count(F.lit(1)).alias(name))
    j = n(live, "to_live").join(n(pending, "to_pending"), "type_key", "full_outer")
    types = S.current(spark, sf).select("type_key").distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return types.join(j, "type_key", "left").select("type_key", zero("to_live"), zero("to_pending"))


# ── snapshots as of two days, from the line items as a version history ───────

EARLY, LATE = "1996-01-01", "1997-01-01"


def _as_of(spark, sf, day):
    """Newest version of each article before ``day``; seven types, an article per order."""
    v = S.load(spark, sf, "lineitem").filter(F.col("l_shipdate") < F.lit(day).cast("timestamp_ntz")).select(
        F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("type_key"),
        F.col("l_orderkey").cast("string").alias("id"), "l_shipdate", "l_partkey", "l_suppkey",
    )
    newest = latest_by_key(v, KEY, F.struct("l_shipdate", "l_partkey", "l_suppkey"))
    return newest.select(
        *KEY, F.sha2(F.col("l_partkey").cast("string"), 256).alias("metadata_hash"),
        F.sha2(F.col("l_suppkey").cast("string"), 256).alias("content_hash"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("modified_ms"),
    )


def _as_of_sql(name, day):
    return f"""{name} AS (
  SELECT 'L' || l_linenumber AS type_key, l_orderkey AS id, l_partkey, l_suppkey, l_shipdate FROM lineitem
  WHERE l_shipdate < TIMESTAMP '{day}'
  QUALIFY row_number() OVER (PARTITION BY l_linenumber, l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1)"""


@query("as_of_diff", f"""WITH {_as_of_sql('a', EARLY)}, {_as_of_sql('b', LATE)}
SELECT coalesce(a.type_key, b.type_key) AS type_key, count(b.id) AS scanned, count(*) FILTER (a.id IS NULL) AS new,
  count(*) FILTER (a.l_partkey <> b.l_partkey OR a.l_suppkey <> b.l_suppkey OR a.l_shipdate <> b.l_shipdate) AS changed,
  count(*) FILTER (a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.l_shipdate = b.l_shipdate) AS unchanged,
  count(*) FILTER (b.id IS NULL) AS removed
FROM a FULL OUTER JOIN b ON a.type_key = b.type_key AND a.id = b.id GROUP BY 1""")
def as_of_diff(spark, sf):
    """What changed between two days, over the largest table."""
    return diff.track_summary(diff.snapshot_diff(_as_of(spark, sf, EARLY), _as_of(spark, sf, LATE), F.lit(R2)))
