"""Sinks and scans there and back, and the functions behind reports and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import canon, health, text, urls
from tidemark.operators import KEY, bodies, ingest, runs
from tidemark.queries import corpus
from tidemark.queries import scenario as S
from tidemark.queries.registry import query
from tidemark.session import scratch_dir
from tidemark.sources import exports, readers, tables

LINES = f"WITH {S.LINES_SQL}"


@query("article_export", """
SELECT source AS type_key, CAST(doc_id AS VARCHAR) AS id, sha256(text) AS hash, n_chars FROM documents""")
def article_export(spark, sf):
    """All articles written as JSON by type and read back."""
    path = scratch_dir(spark, "export")
    d = S.load(spark, sf, "documents")
    exports.write_article_json(d.select(F.col("source").alias("type_key"), F.col("doc_id").cast("string").alias("id"), "text", "n_chars"), path)
    get = lambda key, kind: F.try_variant_get("v", f"$.{key}", kind)
    # The type is the folder; beside a VARIANT column it is read from the path.
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/type_key=([^/]*)/", 1)
    return readers.article_lines(spark, path).select(
        F.url_decode(folder).alias("type_key"), get("id", "string").alias("id"), F.sha2(get("text", "string"), 256).alias("hash"),
        get("n_chars", "bigint").alias("n_chars"),
    )


def _manifest(spark, sf):
    """Events as JSON lines; one in ten is cut off, one in ten is blank."""
    path = scratch_dir(spark, "manifest")
    e = S.load(spark, sf, "events")
    m = F.col("event_id") % 10
    line = (
        F.when(m == 0, F.concat(F.lit("{oops "), F.col("event_id").cast("string"))).when(m == 1, "  ")
        .otherwise(F.to_json(F.struct("event_id", "event_type")))
    )
    e.select(line.alias("value")).write.text(path)
    return path


@query("manifest_lines", "SELECT event_id, event_type FROM events WHERE event_id % 10 > 1")
def manifest_lines(spark, sf):
    """The good lines of a manifest."""
    return readers.json_lines(spark, _manifest(spark, sf), "event_id bigint, event_type string")


@query("manifest_rejects", "SELECT '{oops ' || event_id AS value FROM events WHERE event_id % 10 = 0")
def manifest_rejects(spark, sf):
    """The bad lines of the same manifest."""
    return readers.json_lines_rejects(spark, _manifest(spark, sf))


@query("run_partition", f"{LINES} SELECT event_id, type_key, action AS op FROM lines WHERE run_date = '2024-01-15'")
def run_partition(spark, sf):
    """The manifest of one run as a partition of the table of all runs."""
    path = scratch_dir(spark, "runs")
    rows = S.log_lines(spark, sf).select("run_date", "type_key", "event_id", F.col("action").alias("op"))
    tables.append_versions(rows, path)
    return readers.run_manifest(spark, path, "2024-01-15").select("event_id", "type_key", "op")


@query("id_sweep", f"{S.SNAPSHOTS_SQL} SELECT type_key, id FROM current_")
def id_sweep(spark, sf):
    """The ids of the upstream snapshot."""
    return readers.upstream_ids(S.current(spark, sf))


@query("zone_snapshots", f"{S.SNAPSHOTS_SQL} SELECT type_key, id, metadata_hash, content_hash FROM current_")
def zone_snapshots(spark, sf):
    """The state of the second of two runs, both written to one zone table; the first is written again after it."""
    path = scratch_dir(spark, "state")
    cols = [*KEY, "metadata_hash", "content_hash"]
    for run, rows in (("r1", S.prior(spark, sf)), ("r2", S.current(spark, sf)), ("r1", S.prior(spark, sf))):
        tables.write_snapshot(rows.select(*cols), path, run)
    return tables.read_snapshot(spark, path, "r2")


def _trail(spark, sf, name):
    base = scratch_dir(spark, "audit")
    rows = S.log_lines(spark, sf).select(
        "id", F.col("type_key").alias("type"), F.when(F.col("action") == "view", "changed").otherwise("new").alias("op"),
        F.when(F.col("k") < 50, "someone").alias("approved_by"), "run_date", "ts", "event_id",
    )
    exports.write_audit(rows, base, "auto", "holds", F.col("ts"))
    return spark.read.json(f"{base}/{name}")


@query("audit_decisions", f"""{LINES}
SELECT id, type_key AS type, 'approved' AS op, 'holds' AS source, run_date,
  CASE WHEN k < 50 THEN 'someone' ELSE 'auto' END AS actor, strftime(ts, '%Y-%m') AS month, count(*) AS n FROM lines GROUP BY ALL""")
def audit_decisions(spark, sf):
    """Every row of the decision trail, read back by month."""
    out = _trail(spark, sf, "decisions")
    return out.groupBy("id", "type", "op", "source", "run_date", "actor", F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n"))


@query("audit_changes", f"{LINES} SELECT event_id, id, strftime(ts, '%Y-%m') AS month FROM lines WHERE action = 'view'")
def audit_changes(spark, sf):
    """The trail of changed rows."""
    return _trail(spark, sf, "changes").select("event_id", "id", F.col("month").cast("string").alias("month"))


@query("run_index_document", f"""{LINES}, t AS (SELECT type_key, count(*) AS written, count(*) FILTER (k = 0) > count(*) FILTER (k = 1) AS odd
  FROM lines GROUP BY 1)
SELECT 'full' AS mode, CAST(sum(written) AS BIGINT) AS total, count(*) AS types, count(*) FILTER (NOT odd) AS ok,
  count(*) FILTER (odd) AS partial, count(*) AS entries FROM t""")
def run_index_document(spark, sf):
    """The run index as written and read back."""
    n = lambda v: F.count_if(F.col("k") == v)
    per = S.log_lines(spark, sf).groupBy("type_key").agg(
        F.count(F.lit(1)).alias("written"), F.when(n(0) > n(1), "partial").otherwise("ok").alias("status"))
    path = scratch_dir(spark, "index")
    exports.write_document(runs.run_index_document(per, "full", F.lit("2024-01-01"), F.lit(S.NOW)), path)
    doc = spark.read.schema(
        "mode string, totalArticles bigint, counts struct<types bigint, ok bigint, partial bigint>, types array<struct<type_key string>>").json(path)
    return doc.select("mode", F.col("totalArticles").alias("total"), "counts.*", F.size("types").cast("bigint").alias("entries")).select(
        "mode", "total", "types", "ok", "partial", "entries")


@query("enrich_document", f"""{LINES}
SELECT type_key, count(*) FILTER (level <> 'ERROR' AND k >= 20) AS enriched, count(*) FILTER (level = 'ERROR' AND k >= 20) AS failed,
  count(*) FILTER (k < 20) AS skipped, count(*) AS total, 0::BIGINT AS staged FROM lines GROUP BY 1""")
def enrich_document(spark, sf):
    """The extraction report as written and read back."""
    rows = S.log_lines(spark, sf)
    done = rows.filter("k >= 20").select("type_key", F.when(F.col("level") == "ERROR", "e").alias("body_error"))
    path = scratch_dir(spark, "report")
    exports.write_document(exports.enrich_report_document(bodies.enrich_report(done, rows.filter("k < 20")), F.lit(S.NOW)), path)
    entry = "struct<type_key string, enriched bigint, failed bigint, skipped bigint, total bigint, staged bigint>"
    return spark.read.schema(f"types array<{entry}>").json(path).select(F.inline("types"))


@query("tracking_records", f"""WITH {corpus.HITS_SQL}
SELECT type_key, pid AS id, title, date_ms AS created_ms, n_chars AS original_published_ms, CAST(NULL AS BIGINT) AS updated_published_ms FROM hits""")
def tracking_records(spark, sf):
    """Narrow tracking columns; a language is no number, so the third date stays null."""
    out = ingest.envelopes(S.hits(spark, sf), S.type_config(spark, sf), S.now(), F.lit("2024-01-31").cast("date"))
    return ingest.tracking_records(out, "date", "n_chars", "lang").select(
        *KEY, "title", "created_ms", "original_published_ms", "updated_published_ms")


@query("type_filters", f"""{LINES}
SELECT event_id FROM lines WHERE type_key IN ('T1', 'T2', 'T3', 'T4') AND type_key NOT IN ('T2', 'T9')
UNION ALL SELECT event_id FROM lines WHERE type_key <> 'T1' AND id IN ('U7', 'U14', 'U15')""")
def type_filters(spark, sf):
    """Include and exclude lists, and exclude with ids."""
    rows = S.log_lines(spark, sf)
    listed = ingest.only_types(rows, ["T1", "T2", "T3", "T4"], ["T2", "T9"])
    picked = ingest.only_types(rows, [], ["T1"], ["U7", "U14", "U15"])
    return listed.select("event_id").unionByName(picked.select("event_id"))


@query("date_forms", f"""{LINES}
SELECT event_id, strftime(ts, '%Y/%m/%d@%H:%M:%S') AS filter_date, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
  strftime(ts, '%Y-%m-%dT%H-%M-%S-%fZ') AS stamp FROM lines""")
def date_forms(spark, sf):
    """Dates as filters, manifests and object names have them."""
    return S.log_lines(spark, sf).select(
        "event_id", text.filter_date(F.unix_millis("ts")).alias("filter_date"), text.iso_seconds(F.col("ts")).alias("iso"),
        text.file_stamp(F.col("ts")).alias("stamp"))


@query("run_phases", f"""{LINES}
SELECT event_id, CASE WHEN k % 7 = 0 THEN 'stopped' WHEN k < 20 THEN 'done' WHEN k < 40 THEN 'approve' WHEN k < 60 THEN 'track'
  WHEN k < 80 THEN 'scrape' ELSE 'unknown' END AS phase FROM lines""")
def run_phases(spark, sf):
    """Recorded phases first, else the furthest marker."""
    k = F.col("k")
    status = F.when(k % 7 == 0, "stopped").when(k % 2 == 0, "")
    return S.log_lines(spark, sf).select("event_id", health.run_phase(status, k < 20, k < 40, k < 60, k < 80).alias("phase"))


@query("item_urls", """
SELECT page_id, CASE WHEN page_id % 3 > 0 THEN 'https://kb.example/item?id=' || page_id || '&v=1' WHEN page_id % 2 = 0 THEN url END AS link
FROM pages""")
def item_urls(spark, sf):
    """Item pages by number, else by link."""
    n = F.col("page_id")
    return S.load(spark, sf, "pages").select(n, urls.item_url(
        F.when(n % 3 > 0, n.cast("string")).otherwise(""), "https://kb.example/item?id={}&v=1", F.when(n % 2 == 0, F.col("url")).otherwise(""),
    ).alias("link"))


@query("markdown_cells", """
SELECT doc_id, sha256(replace(replace(text, '|', '\\|'), chr(10), ' ')) AS hash FROM documents""")
def markdown_cells(spark, sf):
    """Whole texts as table cells."""
    return S.load(spark, sf, "documents").select("doc_id", F.sha2(text.md_cell(F.col("text")), 256).alias("hash"))


@query("content_fields", """
SELECT doc_id, CASE WHEN n_chars % 4 = 0 THEN sha256(text) END AS body, CASE WHEN n_chars % 4 = 1 THEN sha256(text) END AS details,
  CASE WHEN n_chars % 4 = 0 THEN length(text) END::INTEGER AS chars, CASE WHEN n_chars % 4 = 2 THEN 'HTTP 404' END AS error FROM documents""")
def content_fields(spark, sf):
    """String values of open contents, and the length of the body under whichever key."""
    c = F.col("content")
    hashed = lambda key: F.sha2(canon.text_field(c, key), 256)
    return corpus._contents(spark, sf).select(
        "doc_id", hashed("body_text").alias("body"), hashed("details").alias("details"),
        F.length(canon.body_text(c)).alias("chars"), canon.text_field(c, canon.ERROR_KEY).alias("error"))


@query("body_changelog", f"""{corpus.EXTRACTED}
SELECT CAST(page_id AS VARCHAR) AS id, CASE WHEN outcome <> 'ok' THEN 'body-error' WHEN page_id % 2 = 0 THEN 'body-changed'
  ELSE 'body-added' END AS op FROM kinds""")
def body_changelog(spark, sf):
    """What extraction did to each article; every second one had a body before."""
    had = F.col("id").cast("bigint") % 2 == 0
    return bodies.enrich_changelog(corpus._extracted(spark, sf), had, F.lit("r1"), S.now()).select("id", "op")


@query("merged_bodies", """
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 2 = 0 THEN sha256('new ' || text) WHEN n_chars % 4 = 0 THEN sha256(text) END AS body,
  CASE WHEN n_chars % 4 = 1 THEN sha256(text) END AS details, CASE WHEN n_chars % 4 = 2 AND doc_id % 2 = 1 THEN 'HTTP 404' END AS error
FROM documents""")
def merged_bodies(spark, sf):
    """Fetched bodies laid over the contents of every second article; old body keys go, other fields stay."""
    c = corpus._contents(spark, sf).select(F.lit("T").alias("type_key"), F.col("doc_id").cast("string").alias("id"), "doc_id", "text", "content")
    found = c.filter("doc_id % 2 = 0").select(
        *KEY, F.concat(F.lit("new "), "text").alias("body_text"), F.lit(None).cast("map<string,string>").alias("sections"),
        F.lit(None).cast("string").alias("body_error"), F.lit("https://d.example").alias("final_url"))
    v = F.col("content")
    hashed = lambda key: F.sha2(canon.text_field(v, key), 256)
    return bodies.merge_bodies(c.select(*KEY, "content"), found, S.now()).select(
        "id", hashed("body_text").alias("body"), hashed("details").alias("details"), canon.text_field(v, canon.ERROR_KEY).alias("error"))
