"""Ingest, profiling, search and body queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import canon, hierarchy, pages, text, urls
from tidemark.operators import KEY, bodies, diff, ingest, profile, reads, review, runs, textindex
from tidemark.operators.ordering import newest, page, page_info, top_per_group
from tidemark.queries import scenario as S
from tidemark.queries.registry import ORACLE, query
from tidemark.session import scratch_dir
from tidemark.sources import exports, listing

B = S.BASE_MS

# ── ingest ───────────────────────────────────────────────────────────────────

HITS_SQL = f"""
hits AS (
  SELECT source AS type_key, doc_id AS seq, 'Doc ' || doc_id AS title, 'https://kb.example/' || doc_id AS click,
    left(text, 80) AS excerpt, 'P' || doc_id AS pid, lang, n_chars,
    CASE WHEN n_chars % 11 <> 0 THEN {B} + doc_id * 60000 ELSE 0 END AS date_ms, source, text FROM documents)"""


@query("ingest_envelopes", f"""WITH {HITS_SQL}
SELECT type_key, pid AS id, title, click AS link, CASE WHEN date_ms <> 0 THEN date_ms END AS modified_ms,
  sha256('{{"clickUri":"' || click || '","date":' || date_ms || ',' || coalesce('"lang":' || to_json(lang) || ',', '')
    || '"n_chars":' || n_chars || ',"permanentid":"' || pid || '","title":"' || title || '"}}') AS metadata_hash,
  sha256('{{"details":' || to_json(text) || '}}') AS content_hash,
  CASE WHEN regexp_matches(text, '\\S') THEN 1 ELSE 0 END AS has_body
FROM hits""")
def ingest_envelopes(spark, sf):
    """Open-schema hits to envelopes: flatten, split by keep-lists, id, hashes."""
    out = ingest.envelopes(
        S.hits(spark, sf), S.type_config(spark, sf), S.now(), F.lit("2024-01-31").cast("date")
    )
    return out.select(*KEY, "title", "link", "modified_ms", "metadata_hash", "content_hash", "has_body")


@query("flat_fields", f"""WITH {HITS_SQL}, f AS (
  SELECT type_key, unnest(['title', 'clickUri', 'excerpt', 'permanentid', 'n_chars', 'date', 'tags', 'details'])
    AS field FROM hits UNION ALL SELECT type_key, 'lang' FROM hits WHERE lang IS NOT NULL)
SELECT type_key, field, CASE WHEN field IN ('title', 'clickUri', 'excerpt') THEN 'top' ELSE 'raw' END AS source,
  count(*) AS n FROM f GROUP BY ALL""")
def flat_fields(spark, sf):
    """All fields of all hits in long form; the top-level title hides the raw one."""
    rows = profile.field_rows(S.hits(spark, sf).withColumn("type_key", F.col("document_type")))
    return rows.groupBy("type_key", "field", "source").agg(F.count(F.lit(1)).alias("n"))


@query("dedup_pages", """
WITH shown AS (
  SELECT doc_id, n_chars, doc_id // 64 AS page FROM documents
  UNION ALL SELECT doc_id, n_chars, doc_id // 64 + 1 FROM documents WHERE doc_id % 64 >= 56),
k AS (SELECT *, CASE WHEN n_chars % 17 = 0 THEN NULL WHEN n_chars % 5 = 0 THEN 'U' || doc_id ELSE 'P' || doc_id END AS key
      FROM shown)
SELECT doc_id, page FROM k QUALIFY key IS NULL OR row_number() OVER (PARTITION BY key ORDER BY page) = 1""")
def dedup_pages(spark, sf):
    """Pages overlap by eight hits: first delivery wins, hits without any id all stay."""
    d = S.load(spark, sf, "documents").select("doc_id", "n_chars")
    first = F.floor(F.col("doc_id") / 64)
    shown = d.withColumn(
        "page", F.explode(F.when(F.col("doc_id") % 64 >= 56, F.array(first, first + 1)).otherwise(F.array(first)))
    )
    name = F.col("doc_id").cast("string")
    pid = F.when((F.col("n_chars") % 5 != 0) & (F.col("n_chars") % 17 != 0), F.concat(F.lit("P"), name))
    uid = F.when(F.col("n_chars") % 17 != 0, F.concat(F.lit("U"), name))
    key = text.or_missing(pid, uid)
    order = F.col("page") * 1_000_000_000 + F.col("doc_id") % 1_000_000_000
    return ingest.dedup_hits(shown, key, order).select("doc_id", "page")


@query("collision_suffix", """
SELECT source AS type_key, doc_id, CASE WHEN n = 1 THEN lang ELSE lang || '__' || n END AS id
FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS n FROM documents)""")
def collision_suffix(spark, sf):
    """The language as id, so that every id is crowded; numbers follow the order of arrival."""
    d = S.load(spark, sf, "documents").select(F.col("source").alias("type_key"), F.col("lang").alias("id"), "doc_id")
    return ingest.collision_ids(d, F.col("doc_id"), bucket_width=250)


@query("incremental_window", """
WITH o AS (SELECT *, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate + to_days(CAST(o_custkey % 5 - 2 AS INT)) END AS m
           FROM orders)
SELECT o_orderkey FROM o WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-03-01'
  AND (m IS NULL OR m >= TIMESTAMP '1997-01-01')""")
def incremental_window(spark, sf):
    """Look-back read: dated in the window, modified not before it or at an unknown time."""
    o = S.load(spark, sf, "orders")
    day = F.col("o_orderdate")
    modified = F.when(F.col("o_orderstatus") != "F", F.timestamp_add("DAY", F.col("o_custkey") % 5 - 2, day))
    cut, end = F.expr("TIMESTAMP_NTZ'1997-01-01'"), F.expr("TIMESTAMP_NTZ'1997-03-01'")
    return ingest.incremental_read(o, cut, end, day, modified).select("o_orderkey")


@query("full_read", "SELECT count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM orders")
def full_read(spark, sf):
    """No date predicate: rows without a date are included."""
    return S.load(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("ids")
    )


def _listing(spark, sf):
    h = S.hits(spark, sf)
    return h.select(
        "document_type", "hit", "seq",
        F.try_variant_get("hit", "$.raw.date", "bigint").alias("date_ms"),
        F.try_variant_get("hit", "$.raw.tags", "array<string>").alias("products"),
    )


@query("filtered_count", f"""WITH {HITS_SQL}
SELECT count(*) AS n FROM hits WHERE type_key IN ('src3') AND lang = 'en' AND date_ms >= {B}
  AND date_ms < {B + 10**9}""")
def filtered_count(spark, sf):
    """Conjunctive filter by type, multi-valued product and half-open date range."""
    cond = ingest.listing_filter("src3", "en", B, B + 10**9)
    return _listing(spark, sf).filter(cond).agg(F.count(F.lit(1)).alias("n"))


@query("flat_listing", f"""WITH {HITS_SQL}
SELECT title AS name, click AS link, text AS summary, '' AS publication_date,
  CASE WHEN date_ms = 0 THEN '' ELSE strftime(make_timestamp(date_ms * 1000), '%b %-d, %Y') END AS modification_date
FROM hits ORDER BY CASE WHEN date_ms <> 0 THEN date_ms END DESC NULLS LAST, click LIMIT 500""")
def flat_listing(spark, sf):
    """Newest 500 of the flat listing, with whole texts as summaries."""
    flat = ingest.flat_listing(S.hits(spark, sf, whole=True))
    return newest(flat, [F.desc_nulls_last("mod_ms"), F.col("link")], 500).drop("mod_ms")


@query("csv_export", f"""WITH {HITS_SQL}
SELECT '"' || title || '","' || click || '","' || replace(replace(text, '"', '""'), chr(10), ' ') || '","","' ||
  CASE WHEN date_ms = 0 THEN '' ELSE strftime(make_timestamp(date_ms * 1000), '%b %-d, %Y') END || '"' AS value
FROM hits""")
def csv_export(spark, sf):
    return exports.csv_lines(ingest.flat_listing(S.hits(spark, sf, whole=True)))


@query("sanitize_ids", """
SELECT page_id, left(trim(regexp_replace(regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '_'), 120)
  AS id FROM pages""")
def sanitize_ids(spark, sf):
    return S.load(spark, sf, "pages").select("page_id", text.stable_id(F.col("url")).alias("id"))


@query("canonical_hash", """
SELECT event_id, sha256('{"k":' || json_extract_string(props, '$.k') || ',"type":"' || event_type || '"}') AS hash
FROM events""")
def canonical_hash(spark, sf):
    """Keys arrive unsorted; the canonical form sorts them."""
    e = S.load(spark, sf, "events")
    doc = F.concat(F.lit('{"type": "'), F.col("event_type"), F.lit('", '), F.expr("substr(props, 2)"))
    return e.select("event_id", canon.canonical_hash(F.parse_json(doc)).alias("hash"))


@query("ascii_hash", r"""
WITH marked AS (
  SELECT doc_id, n_chars, regexp_extract_all(to_json('𝄞 ' || text), '(?s).') AS chars FROM documents
), escaped AS (
  SELECT doc_id, n_chars, array_to_string(list_transform(chars, lambda c: CASE WHEN unicode(c) < 128 THEN c
    WHEN unicode(c) < 65536 THEN '\u' || lpad(lower(to_hex(unicode(c))), 4, '0')
    ELSE '\u' || lower(to_hex(55296 + ((unicode(c) - 65536) >> 10))) || '\u' || lower(to_hex(56320 + ((unicode(c) - 65536) & 1023))) END), '') AS t FROM marked
)
SELECT doc_id, sha256('{"share":' || to_json(n_chars / 8.0::DOUBLE) || ',"text":' || t || '}') AS hash FROM escaped""")
def ascii_hash(spark, sf):
    """Whole texts with characters of all planes, and floats."""
    doc = F.struct(F.concat(F.lit("𝄞 "), "text").alias("text"), (F.col("n_chars") / 8).alias("share"))
    return S.load(spark, sf, "documents").select("doc_id", canon.ascii_hash(F.to_json(doc)).alias("hash"))


def _contents(spark, sf):
    """Contents of four shapes: extracted body, HTML field, error only, nothing."""
    d = S.load(spark, sf, "documents")
    shape = F.col("n_chars") % 4
    content = F.struct(
        F.when(shape == 0, F.col("text")).alias("body_text"),
        F.when(shape == 1, F.col("text")).alias("details"),
        F.when(shape == 2, F.lit("HTTP 404")).alias("bodyError"),
        F.lit("2024-01-01").alias("fetchedAt"),
    )
    return d.select("doc_id", "text", F.parse_json(F.to_json(content)).alias("content"))


@query("body_flags", r"""
SELECT doc_id, n_chars % 4 IN (0, 1) AND regexp_matches(text, '\S') AS has_body,
  (n_chars % 4 = 0 AND regexp_matches(text, '\S')) OR n_chars % 4 = 2 AS settled FROM documents""")
def body_flags(spark, sf):
    """The two readings of 'has a body': for change tracking, and for work selection."""
    c = F.col("content")
    return _contents(spark, sf).select(
        "doc_id", canon.has_body(c).alias("has_body"), canon.body_settled(c).alias("settled")
    )


@query("consumer_bodies", """
SELECT doc_id, CASE WHEN n_chars % 4 IN (0, 1) THEN sha256(text) END AS body FROM documents""")
def consumer_bodies(spark, sf):
    return _contents(spark, sf).select(
        "doc_id", F.sha2(canon.consumer_body(F.col("content"), F.lit("details")), 256).alias("body")
    )


@query("content_hash", """
SELECT doc_id, sha256(CASE n_chars % 4 WHEN 0 THEN '{"body_text":' || to_json(text) || '}'
  WHEN 1 THEN '{"details":' || to_json(text) || '}' WHEN 2 THEN '{"bodyError":"HTTP 404"}' ELSE '{}' END) AS hash
FROM documents""")
def content_hash(spark, sf):
    """The fetch time is no part of the hash."""
    return _contents(spark, sf).select("doc_id", canon.content_hash(F.col("content")).alias("hash"))


# ── profile ──────────────────────────────────────────────────────────────────

SAMPLE = r"""CASE WHEN length({0}) > 200 THEN left({0}, 200) || '…' ELSE {0} END"""


@query("field_catalogue", f"""WITH {HITS_SQL}, f AS (
  SELECT type_key, seq, 'title' AS field, 'top' AS source, 'string' AS t, title AS s FROM hits
  UNION ALL SELECT type_key, seq, 'clickUri', 'top', 'string', click FROM hits
  UNION ALL SELECT type_key, seq, 'excerpt', 'top', 'string', excerpt FROM hits
  UNION ALL SELECT type_key, seq, 'permanentid', 'raw', 'string', pid FROM hits
  UNION ALL SELECT type_key, seq, 'lang', 'raw', 'string', lang FROM hits WHERE lang IS NOT NULL
  UNION ALL SELECT type_key, seq, 'n_chars', 'raw', 'number', CAST(n_chars AS VARCHAR) FROM hits
  UNION ALL SELECT type_key, seq, 'date', 'raw', 'number', CAST(date_ms AS VARCHAR) FROM hits
  UNION ALL SELECT type_key, seq, 'tags', 'raw', 'list', to_json([lang, source])::VARCHAR FROM hits
  UNION ALL SELECT type_key, seq, 'details', 'raw', 'string', text FROM hits),
g AS (SELECT *, trim(regexp_replace(s, '\\s+', ' ', 'g')) AS flat FROM f),
n AS (SELECT type_key, count(*) AS total FROM hits GROUP BY 1)
SELECT type_key, field, min(source) AS source, string_agg(DISTINCT t, ',') AS types, count(*) AS occurrences,
  round_even(CAST(count(*) AS DOUBLE) / any_value(total), 3) AS coverage,
  CASE WHEN field IN ('clickUri', 'permanentid', 'title') THEN 'metadata' WHEN field IN ('lang', 'n_chars', 'date')
    THEN 'metadata' WHEN field = 'details' THEN 'content' ELSE 'unselected' END AS section,
  coalesce(arg_min({SAMPLE.format('flat')}, seq) FILTER (flat <> ''), '') AS sample
FROM g JOIN n USING (type_key) GROUP BY type_key, field""")
def field_catalogue(spark, sf):
    """Observed schema per type: sources, type names, occurrences, coverage, first sample, section."""
    h = S.hits(spark, sf).withColumn("type_key", F.col("document_type"))
    totals = h.groupBy("type_key").agg(F.count(F.lit(1)).alias("total"))
    cat = profile.field_catalogue(profile.field_rows(h), totals)
    return profile.with_section(cat, S.type_config(spark, sf)).select(
        "type_key", "field", "source", F.array_join("types", ",").alias("types"), "occurrences", "coverage",
        "section", "sample",
    )


WORDS_SQL = """
words AS (SELECT source AS type_key, doc_id, unnest(list_distinct(string_split(text, ' '))) AS value FROM documents),
shown AS (SELECT value, count(*) AS n FROM words GROUP BY value ORDER BY n DESC, value LIMIT 5000)"""


def _words(spark, sf):
    return S.load(spark, sf, "documents").select(
        F.col("source").alias("type_key"), F.split("text", " ").alias("words")
    )


@query("facet_counts", f"WITH {WORDS_SQL} SELECT value, count(*) AS n FROM words GROUP BY value")
def facet_counts(spark, sf):
    """Documents per word, all words."""
    return profile.facet(_words(spark, sf), F.col("words"))


@query("hidden_facets", f"""WITH {WORDS_SQL}
SELECT w.value, count(*) AS n, array_to_string(list_sort(list(DISTINCT w.type_key)), ',') AS types
FROM words w LEFT JOIN shown s ON s.value = w.value WHERE s.value IS NULL GROUP BY w.value""")
def hidden_facets(spark, sf):
    """Words that a type's own facet list has and a global list of 5000 lacks."""
    w = _words(spark, sf)
    by_type = profile.facet(w, F.col("words"), ["type_key"])
    out = profile.hidden_values(by_type, limit=5000)
    return out.select("value", "n", F.array_join("types", ",").alias("types"))


@query("tag_equivalence", """
WITH tags AS (
  SELECT doc_id, unnest(list_distinct([source, lang, 'legacy_' || lang, CASE WHEN n_chars % 2 = 0 THEN 'even' ELSE 'odd' END,
    CASE WHEN n_chars % 2 = 0 THEN 'pair' ELSE 'odd' END])) AS tag FROM documents),
m AS (SELECT tag, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids FROM tags GROUP BY tag),
h AS (SELECT ids, min(tag) AS same_as FROM m GROUP BY ids HAVING count(*) > 1)
SELECT h.same_as, m.tag, m.n FROM m JOIN h USING (ids) WHERE m.tag <> h.same_as""")
def tag_equivalence(spark, sf):
    """Tags that exactly the same documents carry."""
    d = S.load(spark, sf, "documents")
    even = F.col("n_chars") % 2 == 0
    tags = F.array(
        F.col("source"), F.col("lang"), F.concat(F.lit("legacy_"), F.col("lang")),
        F.when(even, "even").otherwise("odd"), F.when(even, "pair").otherwise("odd"),
    )
    return profile.equal_tags(d, tags, F.col("doc_id"))


@query("fill_rate", """
SELECT source AS type_key, count(*) AS total, count(quality) AS quality_n, count(toxic) AS toxic_n,
  round_even(count(quality) * 100.0 / count(*), 1) AS quality_pct, round_even(count(toxic) * 100.0 / count(*), 1) AS toxic_pct
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def fill_rate(spark, sf):
    d = S.load(spark, sf, "documents").select("doc_id", F.col("source").alias("type_key"))
    j = d.join(S.load(spark, sf, "labels"), "doc_id", "left")
    out = profile.fill_rate(j, ["quality", "toxic"])
    pct = [F.col(c).cast("double").alias(c) for c in ("quality_pct", "toxic_pct")]
    return out.select("type_key", "total", "quality_n", "toxic_n", *pct)


@query("lifecycle_pivot", """
SELECT source AS type_key, count(*) FILTER (quality = 1) AS release, count(*) FILTER (quality = 0) AS archived
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""")
def lifecycle_pivot(spark, sf):
    d = S.load(spark, sf, "documents").select("doc_id", F.col("source").alias("type_key"))
    j = d.join(S.load(spark, sf, "labels"), "doc_id", "left").withColumn(
        "lifecycle", F.when(F.col("quality") == 1, "release").when(F.col("quality") == 0, "archived")
    )
    return profile.lifecycle_split(j, "lifecycle", ["release", "archived"])


@query("date_histogram", """
SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period, count(*) AS n FROM orders GROUP BY 1""")
def date_histogram(spark, sf):
    return profile.date_histogram(S.load(spark, sf, "orders"), F.col("o_orderdate"), "quarter")


@query("hierarchy_levels", """
WITH p AS (SELECT unnest([p_type, p_type || '|' || p_brand, p_type || '|' || p_brand || '|' || p_name]) AS value FROM part)
SELECT value, count(*) AS n, len(string_split(value, '|')) AS level, string_split(value, '|')[1] AS l1,
  string_split(value, '|')[2] AS l2, string_split(value, '|')[3] AS l3 FROM p GROUP BY value""")
def hierarchy_levels(spark, sf):
    """Parts per node of a pipe-path hierarchy, each node with its levels."""
    path = F.concat_ws("|", "p_type", "p_brand", "p_name")
    counts = profile.facet(S.load(spark, sf, "part"), hierarchy.path_prefixes(path))
    l1, l2, l3 = hierarchy.path_levels(F.col("value"), 3)
    return counts.select(
        "value", "n", F.size(F.split("value", r"\|")).cast("bigint").alias("level"),
        l1.alias("l1"), l2.alias("l2"), l3.alias("l3"),
    )


@query("applies_to_products", """
SELECT product, count(*) AS n, CAST(sum(versions) AS BIGINT) AS versions FROM (
  SELECT unnest([p_brand, p_type]) AS product, unnest([0, 2]) AS versions FROM part) GROUP BY product""")
def applies_to_products(spark, sf):
    """JSON kept in a string, parsed a second time: products and the versions they list."""
    p = S.load(spark, sf, "part")
    size = F.col("p_size").cast("string")
    doc = F.concat(
        F.lit('[{"Product":"'), F.col("p_brand"), F.lit('"},{"Versions":["'), size, F.lit('.X","'), size,
        F.lit('.1"],"Product":"'), F.col("p_type"), F.lit('"}]'),
    )
    rows = p.select(F.explode(hierarchy.applies_to(doc)).alias("a"))
    return rows.groupBy(F.col("a.Product").alias("product")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.size("a.Versions"), F.lit(0))).alias("versions")
    )


@query("version_strings", """
SELECT value, count(*) AS n FROM (SELECT unnest([p_size || '.0', p_size || '.X', p_brand]) AS value FROM part) GROUP BY value""")
def version_strings(spark, sf):
    p = S.load(spark, sf, "part")
    size = F.col("p_size").cast("string")
    listed = F.concat(size, F.lit(".0, "), size, F.lit(".X ,, "), F.col("p_brand"), F.lit(" "))
    return profile.facet(p, hierarchy.comma_list(listed))


# ── reads ────────────────────────────────────────────────────────────────────


@query("article_search", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL}, {S.EVERY_SQL}
SELECT p.type_key, p.id, p.body_chars, s.id IS NOT NULL AS has_pending FROM every p
LEFT JOIN staged s ON s.type_key = p.type_key AND s.id = p.id
WHERE contains(p.id, '7') ORDER BY p.type_key, p.id LIMIT 20 OFFSET 20""")
def article_search(spark, sf):
    """Second page of the live articles whose id contains the term, flagged when an edit waits."""
    found = reads.search_ids(S.everything(spark, sf).select(*KEY, "body_chars"), "7")
    shown = page(found, [F.col("type_key"), F.col("id")], 2, 20, max_size=100)
    out = reads.with_pending_flag(shown, S.staged(spark, sf))
    return out.select(*KEY, F.col("body_chars").cast("bigint").alias("body_chars"), "has_pending")


@query("article_search_total", f"""WITH {S.EVERY_SQL}
SELECT count(*) AS total, CAST(greatest(ceil(count(*) / 20.0), 1) AS BIGINT) AS pages FROM every WHERE contains(id, '7')""")
def article_search_total(spark, sf):
    return page_info(reads.search_ids(S.everything(spark, sf).select(*KEY), "7"), 20)


def _id_listing(spark, sf):
    found = reads.search_ids(S.everything(spark, sf).select(*KEY, F.col("body_chars").cast("bigint").alias("body_chars")), "7")
    path = scratch_dir(spark, "listing")
    listing.write_listing(found, path, [F.col("type_key"), F.col("id")])
    return found, path


@query("article_listing", ORACLE["article_search"])
def article_listing(spark, sf):
    """The page of the id search from a listing with a directory."""
    found, path = _id_listing(spark, sf)
    return reads.with_pending_flag(listing.listing_page(found, path, 2, 20, max_size=100), S.staged(spark, sf)).select(*KEY, "body_chars", "has_pending")


@query("article_listing_total", ORACLE["article_search_total"])
def article_listing_total(spark, sf):
    return listing.listing_info(spark, _id_listing(spark, sf)[1], 20)


@query("has_pending", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL}
SELECT p.type_key, p.id, s.id IS NOT NULL AS has_pending FROM prior p
LEFT JOIN staged s ON s.type_key = p.type_key AND s.id = p.id""")
def has_pending(spark, sf):
    return reads.with_pending_flag(S.prior(spark, sf).select(*KEY), S.staged(spark, sf))


@query("pending_list", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL}
SELECT type_key, id, (SELECT count(*) > 100 FROM staged) AS capped FROM staged ORDER BY type_key, id LIMIT 100""")
def pending_list(spark, sf):
    """First 100 pending rows and whether there are more."""
    s = S.staged(spark, sf).select(*KEY)
    more = s.agg((F.count(F.lit(1)) > 100).alias("capped")).scalar()
    return newest(s, [F.col("type_key"), F.col("id")], 100).withColumn("capped", more)


@query("pending_by_type", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL}
SELECT type_key, count(*) AS n FROM staged GROUP BY type_key""")
def pending_by_type(spark, sf):
    return S.staged(spark, sf).groupBy("type_key").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@query("find_article", f"""{S.SNAPSHOTS_SQL}, {S.STAGED_SQL}
SELECT coalesce(p.type_key, s.type_key) AS type_key, coalesce(p.id, s.id) AS id,
  CASE WHEN p.id IS NOT NULL THEN 'live' ELSE 'pending' END AS "where"
FROM prior p FULL OUTER JOIN staged s ON s.type_key = p.type_key AND s.id = p.id""")
def find_article(spark, sf):
    return reads.locate(S.prior(spark, sf), S.staged(spark, sf))


@query("body_term_search", """
SELECT source AS type_key, 'D' || doc_id AS id FROM documents WHERE contains(lower(text), 'license')""")
def body_term_search(spark, sf):
    """Over all documents and their whole texts."""
    d = S.load(spark, sf, "documents").select(F.col("source").alias("type_key"), F.concat(F.lit("D"), F.col("doc_id")).alias("id"), F.col("text").alias("body_text"))
    return reads.search_bodies(d, "License").select(*KEY)


@query("indexed_term_search", ORACLE["body_term_search"])
def indexed_term_search(spark, sf):
    """The same through a skip index of the documents' files."""
    d, path = S.load(spark, sf, "documents"), scratch_dir(spark, "trigrams")
    textindex.write(textindex.build(d, F.col("text")), path)
    found = textindex.search(d, spark.read.parquet(path), F.col("text"), "License")
    return found.select(F.col("source").alias("type_key"), F.concat(F.lit("D"), F.col("doc_id")).alias("id"))


@query("corpus_counts", """
SELECT source AS type_key, count(*) AS n, CASE WHEN source < 'src2' THEN CAST(replace(source, 'src', '') AS INT) END AS ordinal
FROM documents GROUP BY source""")
def corpus_counts(spark, sf):
    """Configured types in their order, the others after them by name."""
    d = S.load(spark, sf, "documents").select(F.col("source").alias("type_key"))
    known = d.filter("type_key < 'src2'").distinct().withColumn(
        "ordinal", F.regexp_replace("type_key", "src", "").cast("int")
    )
    return reads.corpus_counts(d, known)


@query("index_parity", f"""WITH {S.EVERY_SQL}, i AS (SELECT type_key, count(*) AS n FROM every WHERE lang <> 'de' GROUP BY 1),
l AS (SELECT type_key, count(*) AS n FROM every GROUP BY 1)
SELECT l.type_key, l.n AS live_n, coalesce(i.n, 0) AS index_n FROM l LEFT JOIN i USING (type_key)
WHERE l.n <> coalesce(i.n, 0)""")
def index_parity(spark, sf):
    """An index that lost one language against the live rows."""
    live = S.everything(spark, sf)
    return reads.index_parity(live, diff.hash_index(live.filter("lang <> 'de'")))


@query("article_dossier", f"""WITH {S.HISTORY_SQL}, mine AS (SELECT * FROM history WHERE id = 'C1'),
top AS (SELECT max(turn) AS t FROM mine)
SELECT 'live' AS kind, type_key, id, content_hash AS what, 0::BIGINT AS at_ms FROM mine, top WHERE turn = t
UNION ALL SELECT 'archive', type_key, id, content_hash, at_ms FROM mine, top WHERE turn < t
UNION ALL (SELECT 'history', type_key, id, role, at_ms FROM mine ORDER BY at_ms DESC LIMIT 50)""")
def article_dossier(spark, sf):
    """Live row, versions and latest history of one article."""
    from tidemark.operators.ordering import latest_by_key

    h = S.history(spark, sf)
    live = latest_by_key(h, KEY, F.col("turn"))
    archive = h.join(live.select(*KEY, "turn"), [*KEY, "turn"], "left_anti")
    trail = h.select(
        *KEY, F.col("archived_at").alias("ts"), F.col("role").alias("op"),
        F.date_format("archived_at", "yyyy-MM").alias("month"),
    )
    out = reads.dossier("talk", "C1", live, archive.filter("turn < 0"), archive, trail, ["2023-11"])
    return out.select(
        "kind", *KEY, "what", F.coalesce(F.unix_millis("at"), F.lit(0)).cast("bigint").alias("at_ms")
    )


@query("metadata_field_diff", f"""{S.SNAPSHOTS_SQL}
SELECT c.type_key, c.id, 'lang' AS field, to_json(p.lang)::VARCHAR AS old, to_json(c.lang)::VARCHAR AS new
FROM prior p JOIN current_ c ON c.type_key = p.type_key AND c.id = p.id WHERE p.lang <> c.lang""")
def metadata_field_diff(spark, sf):
    meta = F.parse_json(F.to_json(F.struct("lang", "n_chars"))).alias("metadata")
    return reads.metadata_diff(
        S.prior(spark, sf).select(*KEY, "metadata_hash", meta), S.current(spark, sf).select(*KEY, "metadata_hash", meta)
    )


@query("overview", f"""{S.GATED_SQL}
SELECT (SELECT count(*) FROM prior) AS corpus, (SELECT count(*) FROM staged) AS pending, '2024-01-30' AS latest_run,
  (SELECT count(*) FROM gated WHERE action = 'held-risky') AS held""")
def overview(spark, sf):
    live, pending = S.run_tables(spark, sf)
    held = review.gate(review.with_risk(pending.select(*KEY, *review.DIGEST), live)).filter("action = 'held-risky'")
    return reads.overview(live, pending, S.log_lines(spark, sf).select("run_date"), held)


# ── bodies ───────────────────────────────────────────────────────────────────

LINES = """
ol AS (SELECT type_key, id, unnest(string_split(body_text, chr(10))) AS line, -1 AS s FROM prior),
nl AS (SELECT type_key, id, unnest(string_split(body_text, chr(10))) AS line, 1 AS s FROM current_),
d AS (SELECT type_key, id, line, sum(s) AS d FROM (SELECT * FROM ol UNION ALL SELECT * FROM nl) GROUP BY ALL)"""


@query("body_line_delta", f"""{S.SNAPSHOTS_SQL}, {LINES}
SELECT type_key, id, CAST(sum(greatest(d, 0)) AS BIGINT) AS added, CAST(sum(greatest(-d, 0)) AS BIGINT) AS removed
FROM d WHERE d <> 0 GROUP BY ALL""")
def body_line_delta(spark, sf):
    old, new = S.prior(spark, sf), S.current(spark, sf)
    return bodies.line_delta(old, new, changed=reads.differing(old, new, "content_hash"))


KB_HOST = "kb.example"


def _landed(spark, sf):
    """Pages with where the request ended: in place, at a folder page, or in the knowledge base."""
    p = S.load(spark, sf, "pages")
    turn = F.col("page_id") % 10
    home = F.concat(F.lit("https://"), urls.host(F.col("url")), F.lit("/"))
    final = (
        F.when(turn == 3, home)
        .when(turn == 5, F.concat(F.lit("https://kb.example/article/K"), F.col("page_id").cast("string")))
        .otherwise(F.col("url"))
    )
    return p.select(
        F.lit("manual").alias("type_key"), F.col("page_id").cast("string").alias("id"), "url",
        final.alias("final_url"), "html",
    )


HOST_SQL = "lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1))"
PATH_SQL = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


@query("page_hosts", f"""
SELECT page_id, {HOST_SQL} AS host, {PATH_SQL} AS path,
  coalesce(list_filter(string_split({PATH_SQL}, '/'), lambda x: x <> '')[1], '') AS first_segment FROM pages""")
def page_hosts(spark, sf):
    u = F.col("url")
    return S.load(spark, sf, "pages").select(
        "page_id", urls.host(u).alias("host"), urls.path(u).alias("path"), urls.first_segment(u).alias("first_segment")
    )


@query("page_redirects", f"""
SELECT CAST(page_id AS VARCHAR) AS id, CASE WHEN contains({HOST_SQL}, '.net') THEN 'js-rendered'
  WHEN page_id % 10 = 5 THEN 'in-kb'
  WHEN page_id % 10 = 3 AND url <> 'https://' || {HOST_SQL} || '/' AND (
    regexp_matches({PATH_SQL}, '(?i)/[^/]+\\.[a-z0-9]+$')
    OR coalesce(list_filter(string_split({PATH_SQL}, '/'), lambda x: x <> '')[1], '') <> '') THEN 'moved'
  ELSE 'read' END AS outcome FROM pages""")
def page_redirects(spark, sf):
    """What the URLs alone decide; pages of one domain are known to need a browser."""
    w = _landed(spark, sf)
    js = urls.host(F.col("url")).contains(".net")
    kind = pages.page_outcome(F.col("url"), F.col("final_url"), F.lit(None).cast("string"), js, KB_HOST)
    return w.select("id", F.when(kind == "too-short", "read").otherwise(kind).alias("outcome"))


EXTRACTED = f"""
WITH texts AS (SELECT page_id, url, {pages.article_text_sql('html')} AS body FROM pages),
kinds AS (SELECT *, CASE WHEN page_id % 10 = 5 THEN 'in-kb'
  WHEN page_id % 10 = 3 AND url <> 'https://' || {HOST_SQL} || '/' AND (
    regexp_matches({PATH_SQL}, '(?i)/[^/]+\\.[a-z0-9]+$')
    OR coalesce(list_filter(string_split({PATH_SQL}, '/'), lambda x: x <> '')[1], '') <> '') THEN 'moved'
  WHEN length(body) < 40 THEN 'too-short'
  WHEN regexp_matches(body, '^#{{0,3}}[ ]*404 - Page Not Found')
    OR contains(lower(left(body, 400)), 'the page you are looking for does not exist') THEN 'soft-404'
  ELSE 'ok' END AS outcome FROM texts)"""


def _extracted(spark, sf):
    return bodies.with_outcome(bodies.extract_bodies(_landed(spark, sf)), kb_host=KB_HOST)


@query("extract_bodies", f"""{EXTRACTED}
SELECT CAST(page_id AS VARCHAR) AS id, outcome, CASE WHEN outcome = 'ok' THEN length(body) END::INTEGER AS chars,
  CASE WHEN outcome = 'ok' THEN sha256(body) END AS hash FROM kinds""")
def extract_bodies(spark, sf):
    """Texts of all landed pages."""
    out = _extracted(spark, sf)
    return out.select("id", "outcome", F.length("body_text").alias("chars"), F.sha2("body_text", 256).alias("hash"))


@query("extract_outcomes", f"{EXTRACTED} SELECT outcome, count(*) AS n FROM kinds GROUP BY outcome")
def extract_outcomes(spark, sf):
    return _extracted(spark, sf).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("enrich_report", f"""
SELECT 'manual' AS type_key, count(*) FILTER (page_id % 10 NOT IN (3, 5)) AS enriched,
  count(*) FILTER (page_id % 10 IN (3, 5)) AS failed, (SELECT count(*) FROM conversations) AS skipped,
  count(*) + (SELECT count(*) FROM conversations) AS total, count(*) FILTER (page_id % 4 = 0) AS staged FROM pages""")
def enrich_report(spark, sf):
    """Report of a job that stores pages as they are; the conversations stand for articles
    that already have a body, every fourth page for one fetched again, whose result waits."""
    landed = _landed(spark, sf).withColumn("body_text", F.col("html")).withColumn("raised", F.lit(None).cast("string"))
    results = bodies.with_outcome(landed, kb_host=KB_HOST)
    skipped = S.load(spark, sf, "conversations").select(F.lit("manual").alias("type_key"))
    return bodies.enrich_report(results, skipped, results.filter(F.col("id").cast("bigint") % 4 == 0))


@query("enrich_errors", f"""{EXTRACTED}
SELECT CAST(page_id AS VARCHAR) AS id, url AS link FROM kinds WHERE outcome <> 'ok'""")
def enrich_errors(spark, sf):
    """The pages whose extraction failed; each has a message."""
    return bodies.enrich_errors(_extracted(spark, sf)).filter("error <> ''").select("id", "link")


@query("next_data", r"""
WITH d AS (SELECT doc_id, doc_id % 2 = 0 AS mdx, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents)
SELECT doc_id, sha256(CASE WHEN mdx THEN regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g')
  ELSE '# Doc ' || doc_id || chr(10) || chr(10) || '## GET /v1/' || doc_id || chr(10) || chr(10) || '**Read**'
    || chr(10) || chr(10) || t END) AS hash
FROM d""")
def next_data(spark, sf):
    """Pages that carry their text as JSON: comment blocks of a source, or an API description."""
    d = S.load(spark, sf, "documents")
    body = text.strip(F.col("text"))
    name = F.col("doc_id").cast("string")
    source = F.concat(F.lit("/* import x */ code(); /*\n"), body, F.lit("\n*/ more(); /**/"))
    op = F.to_json(F.struct(F.lit("Read").alias("summary"), body.alias("description")))
    api = F.concat(
        F.lit('{"info":{"title":"Doc '), name, F.lit('"},"paths":{"/v1/'), name, F.lit('":{"get":'), op,
        F.lit(',"head":{"summary":"no"}}}}'),
    )
    doc = F.when(
        F.col("doc_id") % 2 == 0, F.to_json(F.struct(source.alias("compiledSource")))
    ).otherwise(F.concat(F.lit('{"swaggerFile":'), api, F.lit("}")))
    html = F.concat(
        F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"docData":'), doc,
        F.lit("}}}</script></html>"),
    )
    out = bodies.with_embedded_body(d.select("doc_id", html.alias("html")), "body")
    return out.select("doc_id", F.sha2("body", 256).alias("hash"))


@query("repo_items", r"""
SELECT doc_id, kind, CASE WHEN t <> '' THEN sha256(t) END AS hash,
  CASE WHEN t = '' THEN 'empty repository ' || kind || ' body (no description)' END AS body_error
FROM (SELECT doc_id, ['issue', 'pull', 'readme', 'file'][1 + doc_id % 4] AS kind,
  CASE WHEN doc_id % 7 = 0 AND doc_id % 4 < 2 THEN '' ELSE regexp_replace(text, '^\s+|\s+$', '', 'g') END AS t
  FROM documents)""")
def repo_items(spark, sf):
    """Documents as landed repository items of four kinds."""
    d = S.load(spark, sf, "documents")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("issue", "pull", "readme", "file")]), (F.col("doc_id") % 4 + 1).cast("int"))
    empty = (F.col("doc_id") % 7 == 0) & (F.col("doc_id") % 4 < 2)
    payload = (
        F.when(kind == "file", F.col("text"))
        .when(kind == "readme", F.to_json(F.struct(F.base64(F.encode("text", "UTF-8")).alias("content"), F.lit("base64").alias("encoding"))))
        .otherwise(F.to_json(F.struct(F.when(~empty, F.col("text")).alias("body"))))
    )
    out = bodies.repo_body(d.select("doc_id", kind.alias("kind"), payload.alias("payload")))
    return out.select("doc_id", "kind", F.sha2("body_text", 256).alias("hash"), "body_error")


@query("repo_urls", """
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'readme' WHEN 1 THEN 'issue' WHEN 2 THEN 'pull' WHEN 3 THEN 'file' END AS kind,
  'o' || page_id AS owner, 'r' AS repo,
  CASE page_id % 5 WHEN 1 THEN CAST(page_id AS VARCHAR) WHEN 2 THEN CAST(page_id AS VARCHAR) WHEN 3 THEN 'docs/a.md' END AS target,
  page_id % 5 = 4 AS bad FROM pages""")
def repo_urls(spark, sf):
    """URL shapes of repository items."""
    n = F.col("page_id").cast("string")
    base = F.concat(F.lit("https://code.example/o"), n, F.lit("/r"))
    m = F.col("page_id") % 5
    u = (
        F.when(m == 0, base).when(m == 1, F.concat(base, F.lit("/issues/"), n))
        .when(m == 2, F.concat(base, F.lit("/pull/"), n)).when(m == 3, F.concat(base, F.lit("/blob/main/docs/a.md")))
        .otherwise(F.concat(base, F.lit("/wiki")))
    )
    t = urls.repo_target(u)
    return S.load(spark, sf, "pages").select(
        "page_id", t["kind"].alias("kind"), t["owner"].alias("owner"), t["repo"].alias("repo"),
        t["target"].alias("target"), t["error"].isNotNull().alias("bad"),
    )


@query("extraction_work", r"""
SELECT doc_id FROM documents WHERE NOT ((n_chars % 4 = 0 AND regexp_matches(text, '\S')) OR n_chars % 4 = 2)""")
def extraction_work(spark, sf):
    """Articles due for extraction: no body yet and no settled error."""
    c = _contents(spark, sf)
    return c.filter(bodies.due(c)).select("doc_id")


@query("extraction_limit", """
SELECT source AS type_key, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 7""")
def extraction_limit(spark, sf):
    """The first seven articles of each type, as a work limit takes them."""
    d = S.load(spark, sf, "documents").select(F.col("source").alias("type_key"), "doc_id")
    return top_per_group(d, ["type_key"], [F.col("doc_id")], 7)


@query("known_and_extra_types", """
SELECT source AS type_key, source < 'src2' AS known FROM documents GROUP BY source""")
def known_and_extra_types(spark, sf):
    """Types of the corpus split into configured ones and extra ones."""
    seen = S.load(spark, sf, "documents").select(F.col("source").alias("type_key"))
    known = seen.filter("type_key < 'src2'").distinct()
    extra = ingest.unknown_types(known, seen).withColumn("known", F.lit(False))
    return known.withColumn("known", F.lit(True)).unionByName(extra)


@query("corpus_totals", f"""WITH {S.EVERY_SQL}
SELECT count(*) AS total, count(*) FILTER (has_body = 1) AS bodied, max(modified_ms) AS newest FROM every""")
def corpus_totals(spark, sf):
    return runs.corpus_totals(S.everything(spark, sf).withColumn("captured_at", F.col("modified_ms")))


@query("held_lists", """
SELECT event_id, CASE k % 4 WHEN 3 THEN 0 ELSE k END AS n
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def held_lists(spark, sf):
    """State documents of several generations, each with its list of held rows."""
    e = S.log_lines(spark, sf).select("event_id", "k")
    items = F.to_json(F.when(F.col("k") > 0, F.sequence(F.lit(1), F.greatest("k", F.lit(1)))).otherwise(F.array().cast("array<int>")))
    m = F.col("k") % 4
    doc = (
        F.when(m == 0, items).when(m == 1, F.concat(F.lit('{"held":0,"entries":'), items, F.lit("}")))
        .when(m == 2, F.concat(F.lit('{"ids":[9],"holds":'), items, F.lit("}"))).otherwise('{"other":[1]}')
    )
    return e.select("event_id", F.size(canon.held_list(F.parse_json(doc))).cast("bigint").alias("n"))
