"""Risk, gate, promotion, holds, restore and run deletion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import risk as R
from tidemark.operators import KEY, diff, ingest, review, runs, zones
from tidemark.operators.ordering import latest_by_key, newest, numbered, page
from tidemark.operators import reads
from tidemark.plans import daily, tracking
from tidemark.queries import scenario as S
from tidemark.queries.registry import ORACLE, query
from tidemark.session import cut_lineage, scratch_dir
from tidemark.sources import buckets, exports, listing

RUN = "2024-01-31"


def _manifest(pending):
    return pending.select(*KEY, F.lit(RUN).alias("run_date"))


def _records_of(live, pending):
    return review.change_records(_manifest(pending), pending, live, diff.hash_index(live))


def _records(spark, sf):
    return _records_of(*S.run_tables(spark, sf))


def _rated_of(live, pending):
    """Staged rows with risk and parts; staged rows are their own manifest here."""
    return review.with_risk(pending.select(*KEY, *review.DIGEST), live)


def _rated(spark, sf):
    return _rated_of(*S.run_tables(spark, sf))


@query("risk_flags", S.GATED_SQL + """
SELECT type_key, id, op, risk, changed, live_chars, body_chars AS pending_chars FROM gated""")
def risk_flags(spark, sf):
    return _records(spark, sf).select(
        *KEY, "op", F.array_join("risk", ",").alias("risk"), F.array_join("changed", ",").alias("changed"),
        F.col("live_chars").cast("bigint").alias("live_chars"),
        F.col("pending_chars").cast("bigint").alias("pending_chars"),
    )


@query("risk_breakdown", S.GATED_SQL + """
SELECT type_key, count(*) AS total, count(*) FILTER (op = 'new') AS new, count(*) FILTER (op = 'changed') AS changed,
  count(*) FILTER (op = 'unchanged') AS unchanged, count(*) FILTER (f2 LIKE 'body-shrank-%') AS body_shrank,
  count(*) FILTER (f2 = 'body-dropped') AS body_dropped, count(*) FILTER (f1 = 'body-error') AS body_error
FROM gated GROUP BY type_key""")
def risk_breakdown(spark, sf):
    return review.risk_breakdown(_records(spark, sf), ["type_key"])


@query("change_kind_counts", S.GATED_SQL + """
SELECT CASE changed WHEN 'metadata,content' THEN 'metadata+content' WHEN 'metadata' THEN 'metadata-only'
  WHEN 'content' THEN 'content-only' ELSE 'no-op' END AS kind, count(*) AS n FROM gated GROUP BY 1""")
def change_kind_counts(spark, sf):
    return _rated(spark, sf).groupBy(R.change_kind(F.col("changed")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("gate_actions", S.GATED_SQL + """
SELECT type_key, id, action FROM gated""")
def gate_actions(spark, sf):
    return review.gate(_rated(spark, sf)).select(*KEY, "action")


@query("gate_any_risk", S.GATED_SQL + """
SELECT type_key, count(*) FILTER (risk <> '') AS held, count(*) FILTER (risk = '') AS promoted
FROM gated GROUP BY type_key""")
def gate_any_risk(spark, sf):
    """The stricter gate, which any risk flag holds."""
    rows = review.gate(_rated(spark, sf), hold_flags=None).withColumn("held", F.col("action") == "held-risky")
    return rows.groupBy("type_key").agg(
        F.count_if("held").alias("held"), F.count_if(~F.col("held")).alias("promoted")
    )


@query("review_manifest", S.GATED_SQL + """,
lines AS (SELECT c.type_key, c.id, g.action FROM current_ c LEFT JOIN gated g ON g.type_key = c.type_key AND g.id = c.id)
SELECT type_key, coalesce(action, 'missing-pending') AS action, count(*) AS n FROM lines GROUP BY 1, 2""")
def review_manifest(spark, sf):
    """The whole current snapshot as manifest: rows without a pending copy are reported as such."""
    manifest = S.current(spark, sf).select(*KEY)
    live, pending = S.run_tables(spark, sf)
    out = review.review_manifest(manifest, pending, live)
    return out.groupBy("type_key", "action").agg(F.count(F.lit(1)).alias("n"))


def _approved(spark, sf):
    live, pending = (t.select(*KEY, *review.DIGEST) for t in S.run_tables(spark, sf))
    staged = daily.Staged(manifest=_manifest(pending), pending=pending)
    return daily.approve_run(staged, live, diff.hash_index(live), F.lit(RUN), S.now())


@query("promote_live", S.GATED_SQL + """
SELECT coalesce(g.type_key, p.type_key) AS type_key, coalesce(g.id, p.id) AS id,
  coalesce(g.metadata_hash, p.metadata_hash) AS metadata_hash, coalesce(g.content_hash, p.content_hash) AS content_hash
FROM prior p FULL OUTER JOIN (SELECT * FROM gated WHERE action = 'promoted') g
  ON g.type_key = p.type_key AND g.id = p.id""")
def promote_live(spark, sf):
    return _approved(spark, sf).live.select(*KEY, "metadata_hash", "content_hash")


@query("bucket_promote", ORACLE["promote_live"])
def bucket_promote(spark, sf):
    """The same promotion on a bucketed live table: buckets without a promoted row are not rewritten."""
    cols, path = [*KEY, "metadata_hash", "content_hash"], scratch_dir(spark, "live")
    live, pending = S.run_tables(spark, sf)
    buckets.create(live.select(*cols), path, "base")
    safe = _approved(spark, sf).approved.select(*KEY)
    buckets.upsert(path, "base", RUN, pending.select(*cols).join(safe, KEY, "left_semi"))
    return buckets.read(live.select(*cols), path, RUN).select(*cols)


@query("archive_displaced", S.GATED_SQL + """
SELECT p.type_key, p.id, p.metadata_hash, p.content_hash FROM prior p JOIN gated g
  ON g.type_key = p.type_key AND g.id = p.id WHERE g.action = 'promoted'""")
def archive_displaced(spark, sf):
    return _approved(spark, sf).archive.select(*KEY, "metadata_hash", "content_hash")


@query("pending_after_run", S.GATED_SQL + """
SELECT type_key, id, content_hash FROM gated WHERE action = 'held-risky'""")
def pending_after_run(spark, sf):
    return _approved(spark, sf).pending.select(*KEY, "content_hash")


@query("index_after_run", S.GATED_SQL + """
SELECT coalesce(g.type_key, p.type_key) AS type_key, coalesce(g.id, p.id) AS id,
  coalesce(g.metadata_hash, p.metadata_hash) AS metadata_hash
FROM prior p FULL OUTER JOIN (SELECT * FROM gated WHERE action = 'promoted') g
  ON g.type_key = p.type_key AND g.id = p.id""")
def index_after_run(spark, sf):
    return _approved(spark, sf).index


@query("approved_records", S.GATED_SQL + f"""
SELECT op, id, type_key, '{RUN}' AS run_date, 'auto' AS approved_by, metadata_hash AS hash, changed
FROM gated WHERE action = 'promoted'""")
def approved_records(spark, sf):
    return _approved(spark, sf).approved.select(
        "op", "id", "type_key", "run_date", "approved_by", "hash", F.array_join("changed", ",").alias("changed")
    )


@query("audit_counts", S.GATED_SQL + """
SELECT 'changed_ids' AS trail, count(*) AS n FROM gated WHERE action = 'promoted'
UNION ALL SELECT 'decisions', count(*) FROM gated WHERE action = 'promoted'
UNION ALL SELECT 'changes', count(*) FROM gated WHERE action = 'promoted' AND op = 'changed'""")
def audit_counts(spark, sf):
    """Rows that one promotion adds to each of the three trails."""
    frames = exports.audit_frames(_approved(spark, sf).approved, "auto", "auto", S.now())
    out = None
    for name, frame in frames.items():
        n = frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("trail"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("resume_approved", S.GATED_SQL + """
SELECT type_key, id FROM gated WHERE NOT (action = 'promoted' AND op = 'new')""")
def resume_approved(spark, sf):
    """An interrupted run had promoted its new rows; what is left to do."""
    live, pending = S.run_tables(spark, sf)
    done = review.gate(_records_of(live, pending)).filter("action = 'promoted' AND op = 'new'")
    return review.not_yet_approved(_manifest(pending), done).select(*KEY)


@query("reject_pending", S.GATED_SQL + """
SELECT type_key, count(*) AS remaining FROM gated WHERE action <> 'held-risky' GROUP BY type_key""")
def reject_pending(spark, sf):
    """Reject every held row; the rest of pending stays."""
    live, pending = S.run_tables(spark, sf)
    held = review.gate(_rated_of(live, pending)).filter("action = 'held-risky'")
    return zones.drop_keys(pending.select(*KEY), held).groupBy("type_key").agg(
        F.count(F.lit(1)).alias("remaining")
    )


@query("bulk_resolve_types", S.GATED_SQL + """
SELECT type_key, count(*) AS n,
  CASE WHEN type_key < 'src2' THEN 'approved' ELSE 'rejected' END AS decision FROM gated GROUP BY type_key""")
def bulk_resolve_types(spark, sf):
    """Bulk decisions by type: one half of the types approved, the other rejected."""
    live, pending = (t.select(*KEY, *review.DIGEST) for t in S.run_tables(spark, sf))
    yes = F.col("type_key") < "src2"
    approved = zones.promote(live, pending, pending.filter(yes), S.now())
    left = approved["pending"]
    taken = zones.drop_keys(pending, left)
    n = lambda df, what: df.groupBy("type_key").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "decision", F.lit(what)
    )
    return n(taken, "approved").unionByName(n(left, "rejected"))


@query("held_entries", S.GATED_SQL + """
SELECT g.type_key, g.id, g.risk, g.changed, g.op, length(g.body_text) AS pending_chars,
  coalesce(g.body_error, '') AS error_msg, coalesce(length(p.body_text), 0) AS live_chars,
  coalesce(replace(left(p.body_text, 200), chr(10), ' '), '') AS live_excerpt
FROM gated g LEFT JOIN prior p ON p.type_key = g.type_key AND p.id = g.id WHERE g.action = 'held-risky'""")
def held_entries(spark, sf):
    held = review.gate(_records(spark, sf)).filter("action = 'held-risky'")
    out = review.held_entries(held, S.current(spark, sf), S.prior(spark, sf))
    return out.select(
        *KEY, F.array_join("risk", ",").alias("risk"), F.array_join("changed", ",").alias("changed"), "op",
        F.col("pending_chars").cast("bigint").alias("pending_chars"), "error_msg",
        F.col("live_chars").cast("bigint").alias("live_chars"), "live_excerpt",
    )


RESOLVE_SQL = S.GATED_SQL + """,
asked AS (SELECT d.source AS type_key, 'D' || d.doc_id AS id, quality FROM labels l JOIN documents d USING (doc_id)),
decided AS (
  SELECT g.*, CASE WHEN a.quality = 1 THEN 'approved' WHEN a.quality = 0 THEN 'rejected' ELSE 'held' END AS decision
  FROM gated g LEFT JOIN asked a ON a.type_key = g.type_key AND a.id = g.id WHERE g.action = 'held-risky')
"""


def _decisions(spark, sf):
    """The labels are the reviewers' decisions."""
    d = S.load(spark, sf, "labels").join(S.load(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return d.select(
        F.col("source").alias("type_key"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"),
        F.when(F.col("quality") == 1, "approve").otherwise("reject").alias("action"), F.lit("rev").alias("actor"),
    )


@query("resolve_holds", RESOLVE_SQL + """
SELECT type_key, id, decision, CASE WHEN decision <> 'held' THEN 'rev' END AS actor FROM decided""")
def resolve_holds(spark, sf):
    held = review.gate(_rated(spark, sf)).filter("action = 'held-risky'").select(*KEY)
    return review.resolve(held, _decisions(spark, sf))


@query("settle_holds", RESOLVE_SQL + """
SELECT 'approved' AS what, count(*) AS n FROM decided WHERE decision = 'approved'
UNION ALL SELECT 'rejected', count(*) FROM decided WHERE decision = 'rejected'
UNION ALL SELECT 'remaining', count(*) FROM decided WHERE decision = 'held'
UNION ALL SELECT 'live', (SELECT count(*) FROM prior)
UNION ALL SELECT 'pending', (SELECT count(*) FROM gated) - (SELECT count(*) FROM decided WHERE decision <> 'held')""")
def settle_holds(spark, sf):
    """Decisions applied to the zones; sizes of everything that comes out."""
    live, pending = (t.select(*KEY, *review.DIGEST) for t in S.run_tables(spark, sf))
    held = cut_lineage(spark, review.gate(_records_of(live, pending)).filter("action = 'held-risky'"), "held")
    out = daily.settle_holds(held, _decisions(spark, sf), live, pending, F.lit(RUN), S.now())
    total = None
    for name in ("approved", "rejected", "remaining", "live", "pending"):
        n = out[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
        total = n if total is None else total.unionByName(n)
    return total


@query("escalated_holds", S.GATED_SQL + """
SELECT type_key, count(*) AS n, 'rejected' AS decision FROM gated WHERE action = 'held-risky' GROUP BY type_key""")
def escalated_holds(spark, sf):
    """An escalation of the whole run rejects whatever is still held."""
    live, pending = S.run_tables(spark, sf)
    held = review.gate(_rated_of(live, pending)).filter("action = 'held-risky'").select(*KEY)
    verdict = _manifest(pending).agg(F.max("run_date").alias("run_date")).select(
        F.lit(None).cast("string").alias("type_key"), F.lit(None).cast("string").alias("id"),
        F.lit("auto_escalate").alias("action"), F.lit("watchdog").alias("actor"),
    )
    return review.resolve(held, verdict).groupBy("type_key", "decision").agg(F.count(F.lit(1)).alias("n"))


@query("run_changes_page", S.GATED_SQL + """
SELECT type_key, id, op, risk FROM gated WHERE f2 LIKE 'body-shrank-%' ORDER BY type_key, id LIMIT 20 OFFSET 20""")
def run_changes_page(spark, sf):
    """Second page of the run's rows with a shrunken body."""
    rows = reads.run_changes(_records(spark, sf), RUN, risk="body-shrank")
    return page(rows, [F.col("type_key"), F.col("id")], 2, 20).select(*KEY, "op", F.array_join("risk", ",").alias("risk"))


@query("run_changes_kinds", S.GATED_SQL + """
SELECT 'staged' AS kind, type_key, id, op, '' AS risk, NULL::VARCHAR AS approved_by FROM gated WHERE type_key = 'src1'
UNION ALL SELECT 'track', type_key, id, op, risk, NULL FROM gated WHERE f2 LIKE 'body-shrank-%'
UNION ALL SELECT 'auto', type_key, id, op, '', 'auto' FROM gated WHERE action = 'promoted' AND op = 'changed'
UNION ALL SELECT 'holds', type_key, id, op, '', 'ann' FROM gated WHERE action = 'held-risky'""")
def run_changes_kinds(spark, sf):
    """The drill-down by each kind, with the filters each has."""
    live, pending = S.run_tables(spark, sf)
    records = cut_lineage(spark, _records_of(live, pending), "records")
    gated = review.gate(records)
    run, by = F.lit(RUN), lambda action, who: review.approved_records(gated.filter(F.col("action") == action), F.lit(who), F.lit(RUN))
    tables = {
        "staged": records.select("op", "id", "type_key", run.alias("run_date")), "track": records,
        "auto": by("promoted", "auto"), "holds": by("held-risky", "ann"),
    }
    asked = [("staged", {"type_key": "src1"}), ("track", {"risk": "body-shrank"}), ("auto", {"op": "changed"}), ("holds", {})]
    out = None
    for kind, filters in asked:
        rows = reads.changes_of_kind(tables, kind, RUN, **filters).select(
            F.lit(kind).alias("kind"), *KEY, "op", F.array_join("risk", ",").alias("risk"), "approved_by")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("run_changes_listing", ORACLE["run_changes_page"])
def run_changes_listing(spark, sf):
    """The same page from a listing with a directory."""
    rows = reads.run_changes(_records(spark, sf), RUN, risk="body-shrank").select(*KEY, "op", F.array_join("risk", ",").alias("risk"))
    path = scratch_dir(spark, "listing")
    listing.write_listing(rows, path, [F.col("type_key"), F.col("id")])
    return listing.listing_page(rows, path, 2, 20)


@query("ops_by_manifest", S.GATED_SQL + """
SELECT op, count(*) AS n FROM gated GROUP BY op""")
def ops_by_manifest(spark, sf):
    return _records(spark, sf).groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("risk_defaults", S.GATED_SQL + """
SELECT c.type_key, c.id, coalesce(g.op, 'changed') AS op, coalesce(g.risk, '') AS risk
FROM current_ c LEFT JOIN gated g ON g.type_key = c.type_key AND g.id = c.id""")
def risk_defaults(spark, sf):
    """The manifest of all current rows with the run's risk index; defaults where it has no row."""
    index = review.risk_index(_records(spark, sf), F.col("run_date"))
    out = review.attach_risk(S.current(spark, sf).select(*KEY), index)
    return out.select(*KEY, "op", F.array_join("risk", ",").alias("risk"))


# ── versions and restore ─────────────────────────────────────────────────────


def _zones_of_history(spark, sf):
    h = S.history(spark, sf)
    live = latest_by_key(h, KEY, F.col("turn"))
    archive = h.join(live.select(*KEY, "turn"), [*KEY, "turn"], "left_anti")
    return live, archive


@query("version_list", f"""WITH {S.HISTORY_SQL}
SELECT type_key, id, turn, row_number() OVER (PARTITION BY type_key, id ORDER BY turn DESC) AS version FROM history""")
def version_list(spark, sf):
    """All versions per article, newest first; one article may hold most of them."""
    h = S.history(spark, sf)
    out = numbered(h, KEY, [F.desc("turn")], -F.floor(F.col("turn") / 1000), "version")
    return out.select(*KEY, "turn", F.col("version").cast("bigint").alias("version"))


@query("restore_versions", f"""WITH {S.HISTORY_SQL},
live AS (SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY id ORDER BY turn DESC) = 1),
arch AS (SELECT h.* FROM history h JOIN live l USING (id) WHERE h.turn < l.turn),
want AS (SELECT * FROM arch WHERE turn = 0 AND role = 'user')
SELECT l.type_key, l.id, coalesce(w.content_hash, l.content_hash) AS content_hash, w.id IS NOT NULL AS restored
FROM live l LEFT JOIN want w USING (id)""")
def restore_versions(spark, sf):
    """Restore the first version of every article that a user opened."""
    live, archive = _zones_of_history(spark, sf)
    requests = archive.filter("turn = 0 AND role = 'user'").select(*KEY, "archived_at")
    closed = live.agg(F.lit(RUN).alias("run_date"), F.max(F.lit("done")).alias("phase"))
    cols = [*KEY, "content_hash"]
    out = zones.restore(
        live.select(*cols), archive.select(*cols, "archived_at"), requests, closed, F.lit(RUN), S.now()
    )
    done = out["audit"].select(*KEY, F.lit(True).alias("restored"))
    return out["live"].join(done, KEY, "left").select(
        *cols, F.coalesce("restored", F.lit(False)).alias("restored")
    )


@query("restore_refused", f"""WITH {S.HISTORY_SQL}
SELECT 'refused' AS status, count(*) AS n FROM history""")
def restore_refused(spark, sf):
    """While the day's run is open every request is refused, also those without such a version."""
    live, archive = _zones_of_history(spark, sf)
    running = live.agg(F.lit(RUN).alias("run_date"), F.max(F.lit("track")).alias("phase"))
    asked = S.history(spark, sf).select(*KEY, "archived_at")
    cols = [*KEY, "content_hash"]
    out = zones.restore(live.select(*cols), archive.select(*cols, "archived_at"), asked, running, F.lit(RUN), S.now())
    return out["result"].groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("last_writer_wins", f"""WITH {S.HISTORY_SQL}
SELECT type_key, id, turn, role, content_hash FROM history
QUALIFY row_number() OVER (PARTITION BY type_key, id ORDER BY turn DESC) = 1""")
def last_writer_wins(spark, sf):
    return latest_by_key(S.history(spark, sf).drop("archived_at"), KEY, F.col("turn"))


# ── run deletion, retention, trails ──────────────────────────────────────────


def _run_of_row(df):
    """Staged rows come from two runs: those with a body, and the others."""
    return df.withColumn("run_date", F.when(F.col("has_body") == 1, RUN).otherwise("2024-01-30"))


@query("delete_run", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL}
SELECT 'manifest' AS what, count(*) FILTER (has_body = 0) AS n FROM staged
UNION ALL SELECT 'pending', count(*) FILTER (has_body = 0) FROM staged""")
def delete_run(spark, sf):
    s = S.run_tables(spark, sf)[1]
    manifest = _run_of_row(s).select(*KEY, "run_date")
    out = zones.delete_run({"manifest": manifest}, manifest, s.select(*KEY), RUN)
    n = lambda name: out[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
    return n("manifest").unionByName(n("pending"))


@query("delete_run_preview", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL},
groups AS (
  SELECT 'pending' AS grp, type_key || '/' || id AS name FROM staged WHERE has_body = 1
  UNION ALL SELECT 'runs', type_key || '/' || id FROM staged WHERE has_body = 1),
top AS (SELECT * FROM groups QUALIFY row_number() OVER (PARTITION BY grp ORDER BY name) <= 5)
SELECT g.grp AS "group", g.n, t.sample FROM (SELECT grp, count(*) AS n FROM groups GROUP BY 1) g
LEFT JOIN (SELECT grp, string_agg(name, ',' ORDER BY name) AS sample FROM top GROUP BY 1) t USING (grp)""")
def delete_run_preview(spark, sf):
    s = S.run_tables(spark, sf)[1]
    manifest = _run_of_row(s)
    pending = zones.staged_by_run(manifest, s, RUN)
    name = F.concat_ws("/", "type_key", "id").alias("name")
    groups = pending.select(F.lit("pending").alias("group"), name).unionByName(
        manifest.filter(F.col("run_date") == RUN).select(F.lit("runs").alias("group"), name)
    )
    return runs.delete_preview(groups)


@query("retention", """
WITH zones AS (SELECT unnest(['archive', 'pending', 'runs', 'state']) AS zone, unnest([365, 30, 90, 7]) AS days)
SELECT zone, count(*) FILTER (o_orderdate >= TIMESTAMP '1998-06-01 00:00:00' - to_days(CAST(days AS INT))) AS kept
FROM orders, zones GROUP BY zone""")
def retention(spark, sf):
    """Orders as stamped rows of each zone: how many are still within its retention."""
    o = S.load(spark, sf, "orders").select(F.col("o_orderdate").cast("timestamp").alias("at"))
    moment = F.lit("1998-06-01 00:00:00").cast("timestamp")
    out = None
    for zone in zones.RETENTION_DAYS:
        n = zones.retain(o, zone, "at", moment).agg(F.count(F.lit(1)).alias("kept"))
        n = n.select(F.lit(zone).alias("zone"), "kept")
        out = n if out is None else out.unionByName(n)
    return out


@query("last_n_audit", f"""WITH {S.LINES_SQL}
SELECT event_id, action, type_key, id FROM lines ORDER BY event_id DESC LIMIT 500""")
def last_n_audit(spark, sf):
    """The newest 500 trail rows, newest first."""
    return newest(S.log_lines(spark, sf), [F.desc("event_id")], 500).select("event_id", "action", "type_key", "id")


@query("audit_months", f"""WITH {S.LINES_SQL}
SELECT DISTINCT strftime(ts, '%Y-%m') AS month FROM lines""")
def audit_months(spark, sf):
    return S.log_lines(spark, sf).select(F.date_format("ts", "yyyy-MM").alias("month")).distinct()


@query("audit_search", f"""WITH {S.LINES_SQL}
SELECT event_id, id FROM lines
WHERE contains(lower(action), 'u12') OR contains(lower(type_key), 'u12') OR contains(lower(id), 'u12')
ORDER BY event_id DESC LIMIT 400""")
def audit_search(spark, sf):
    """Substring over the whole row, newest 400."""
    rows = S.log_lines(spark, sf).select("event_id", "action", "type_key", "id")
    return newest(reads.search_rows(rows, "U12"), [F.desc("event_id")], 400).select("event_id", "id")


@query("trail_month", f"""WITH {S.LINES_SQL}
SELECT event_id, action FROM lines WHERE strftime(ts, '%Y-%m') = '2024-01' ORDER BY ts DESC, event_id DESC LIMIT 500""")
def trail_month(spark, sf):
    rows = S.log_lines(spark, sf).withColumn("month", F.date_format("ts", "yyyy-MM"))
    return reads.trail(rows, "2024-01", limit=500, tie="event_id").select("event_id", "action")


@query("pending_manifest", f"""WITH {S.HISTORY_SQL}
SELECT type_key, id, max(turn) AS turn FROM history GROUP BY ALL""")
def pending_manifest(spark, sf):
    """Stages of several runs merged: the last entry per key, in key order."""
    return tracking.merge_pending(S.history(spark, sf).select(*KEY, "turn"), F.col("turn"))


@query("edited_articles", """
WITH d AS (SELECT doc_id, source, lang, text, n_chars % 9 = 0 AS hit FROM documents)
SELECT source AS type_key, 'D' || doc_id AS id,
  sha256('{"lang":' || to_json(CASE WHEN hit THEN 'zz' ELSE lang END) || '}') AS metadata_hash,
  sha256('{"body_text":' || to_json(CASE WHEN hit THEN text || ' (edited)' ELSE text END) || '}') AS content_hash,
  length(text) + CASE WHEN hit THEN 9 ELSE 0 END AS body_chars, hit AS edited FROM d""")
def edited_articles(spark, sf):
    """Hand-made edits of some articles: new hashes, and the displaced rows archived."""
    d = S.load(spark, sf, "documents")

    def shape(df, lang, body):
        meta = F.parse_json(F.to_json(F.struct(lang.alias("lang"))))
        return df.select(
            F.col("source").alias("type_key"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"),
            meta.alias("metadata"), F.parse_json(F.to_json(F.struct(body.alias("body_text")))).alias("content"),
        )

    cols = [*KEY, "metadata", "content", "metadata_hash", "content_hash", "has_body", "body_chars", "body_error"]
    live = ingest.with_digest(shape(d, F.col("lang"), F.col("text"))).select(*cols)
    edits = shape(d.filter("n_chars % 9 = 0"), F.lit("zz"), F.concat("text", F.lit(" (edited)")))
    out = daily.edit_articles(live, edits, F.lit("ann"), F.lit(RUN), S.now())
    done = out["archive"].select(*KEY, F.lit(True).alias("edited"))
    return out["live"].select(*KEY, "metadata_hash", "content_hash", F.col("body_chars").cast("bigint").alias("body_chars")).join(
        done, KEY, "left").withColumn("edited", F.coalesce("edited", F.lit(False)))
