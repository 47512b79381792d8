"""Two snapshots, hits, log lines and history, derived by Spark from the driver tables.

Every document takes part: its *fate* says what happened between the tracked snapshot
(``prior``) and the one just read (``current``). Two of ten fates mean that a document is on
one side only, as it was added or removed; together the two sides hold every document with
its whole text. The SQL fragments below say the same to the checker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import canon
from tidemark.functions.text import is_blank
from tidemark.session import configure, cut_lineage

NOW = "2024-01-31 00:00:00"
DAY_MS = 86_400_000
BASE_MS = 1_700_000_000_000


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


FATES = {0: "added", 9: "removed", 1: "relabelled", 2: "shortened", 3: "emptied", 4: "failed"}


def fate(doc_id: Column) -> Column:
    m = F.call_function("div", doc_id, F.lit(20)) % 10
    out = None
    for value, name in FATES.items():
        out = F.when(m == value, name) if out is None else out.when(m == value, name)
    return out.otherwise("kept")


def _articles(df: DataFrame, lang: Column, body: Column, error: Column, modified: Column, *more: str) -> DataFrame:
    shaped = df.select(
        F.col("source").alias("type_key"),
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("id"),
        "doc_id", lang.alias("lang"), "n_chars", "source",
        body.alias("body_text"), error.alias("body_error"), modified.alias("modified_ms"), *more,
    )
    return shaped.select(
        *[c for c in shaped.columns if c != "source"],
        canon.sorted_struct_hash(lang=F.col("lang"), n_chars=F.col("n_chars"), source=F.col("source")).alias(
            "metadata_hash"
        ),
        canon.sorted_struct_hash(body_text=F.col("body_text"), bodyError=F.col("body_error")).alias("content_hash"),
        F.when(is_blank(F.col("body_text")), 0).otherwise(1).alias("has_body"),
        F.length("body_text").alias("body_chars"),
        F.lit(None).cast("bigint").alias("updated_published_ms"),
    )


def prior(spark: SparkSession, sf: str) -> DataFrame:
    """The tracked (live) snapshot."""
    d = load(spark, sf, "documents").withColumn("fate", fate(F.col("doc_id"))).filter("fate <> 'added'")
    return _articles(
        d, F.col("lang"), F.col("text"), F.lit(None).cast("string"),
        F.lit(BASE_MS) + F.col("doc_id") * 60000,
    )


def everything(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as live rows, with their whole texts."""
    d = load(spark, sf, "documents")
    return _articles(d, F.col("lang"), F.col("text"), F.lit(None).cast("string"), F.lit(BASE_MS) + F.col("doc_id") * 60000)


def _as_read(d: DataFrame, f: Column, *more: str) -> DataFrame:
    """Documents as they are after the fate ``f``."""
    body = (
        F.when(f == "shortened", F.expr("left(text, cast(floor(length(text) * 3 / 10) as int))"))
        .when(f == "emptied", "").otherwise(F.col("text"))
    )
    later = F.when(f == "shortened", DAY_MS).otherwise(0)
    return _articles(
        d, F.when(f == "relabelled", "xx").otherwise(F.col("lang")), body,
        F.when(f == "failed", "HTTP 404"), F.lit(BASE_MS) + F.col("doc_id") * 60000 + later, *more,
    )


def current(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot just read (staged)."""
    return _as_read(load(spark, sf, "documents").withColumn("fate", fate(F.col("doc_id"))).filter("fate <> 'removed'"), F.col("fate"))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """Current rows that are new or differ from live in metadata or body: what waits in pending."""
    same = prior(spark, sf).select("type_key", "id", "metadata_hash", "content_hash")
    return current(spark, sf).join(same, ["type_key", "id", "metadata_hash", "content_hash"], "left_anti")


def run_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Live and pending as a run has them: narrow digest tables, from one scan of the documents.

    Queries that use a zone several times start from these tables, which outlive lost
    executors, rather than from the documents each time.
    """
    d = load(spark, sf, "documents").withColumn("fate", fate(F.col("doc_id"))).withColumn("side", F.explode(F.array(F.lit("prior"), F.lit("current"))))
    there = F.when(F.col("side") == "prior", F.col("fate") != "added").otherwise(F.col("fate") != "removed")
    f = F.when(F.col("side") == "prior", "kept").otherwise(F.col("fate"))
    both = cut_lineage(spark, _as_read(d.filter(there), f, "side").drop("body_text"), "zones")
    live, now_read = (both.filter(F.col("side") == side).drop("side") for side in ("prior", "current"))
    same = live.select("type_key", "id", "metadata_hash", "content_hash")
    return live, now_read.join(same, ["type_key", "id", "metadata_hash", "content_hash"], "left_anti")


def _sql_side(name: str, gone: int, lang: str, body: str, error: str, modified: str) -> str:
    return f"""
{name}_rows AS (
  SELECT source AS type_key, 'D' || doc_id AS id, doc_id, {lang} AS lang, n_chars, source,
         {body} AS body_text, {error} AS body_error, {modified} AS modified_ms
  FROM documents WHERE doc_id // 20 % 10 <> {gone}),
{name} AS (
  SELECT *,
    sha256('{{"lang":' || to_json(lang) || ',"n_chars":' || n_chars || ',"source":' || to_json(source) || '}}')
      AS metadata_hash,
    sha256('{{' || CASE WHEN body_error IS NULL THEN '' ELSE '"bodyError":' || to_json(body_error) || ',' END
      || '"body_text":' || to_json(body_text) || '}}') AS content_hash,
    CASE WHEN regexp_matches(body_text, '\\S') THEN 1 ELSE 0 END AS has_body,
    length(body_text) AS body_chars
  FROM {name}_rows)"""


PRIOR_SQL = _sql_side("prior", 0, "lang", "text", "NULL::VARCHAR", f"{BASE_MS} + doc_id * 60000")
CURRENT_SQL = _sql_side(
    "current_", 9,
    "CASE WHEN doc_id // 20 % 10 = 1 THEN 'xx' ELSE lang END",
    "CASE WHEN doc_id // 20 % 10 = 2 THEN left(text, CAST(floor(length(text) * 3 / 10) AS INT)) "
    "WHEN doc_id // 20 % 10 = 3 THEN '' ELSE text END",
    "CASE WHEN doc_id // 20 % 10 = 4 THEN 'HTTP 404' END",
    f"{BASE_MS} + doc_id * 60000 + CASE WHEN doc_id // 20 % 10 = 2 THEN {DAY_MS} ELSE 0 END",
)
SNAPSHOTS_SQL = f"WITH {PRIOR_SQL}, {CURRENT_SQL}"
EVERY_SQL = _sql_side("every", -1, "lang", "text", "NULL::VARCHAR", f"{BASE_MS} + doc_id * 60000")
STAGED_SQL = """
staged AS (
  SELECT c.* FROM current_ c LEFT JOIN prior p
    ON p.type_key = c.type_key AND p.id = c.id
   AND p.metadata_hash = c.metadata_hash AND p.content_hash = c.content_hash
  WHERE p.id IS NULL)"""
# Risk, changed parts and gate action of each staged row against live.
RATED_SQL = """
rated AS (
  SELECT s.*, p.id IS NOT NULL AS has_live, p.metadata_hash AS prior_hash,
    coalesce(p.body_chars, 0) AS live_chars,
    CASE WHEN p.id IS NOT NULL AND coalesce(s.body_error, '') <> '' THEN 'body-error' END AS f1,
    CASE WHEN p.has_body = 1 AND s.has_body = 0 THEN 'body-dropped'
         WHEN p.has_body = 1 AND s.has_body = 1 AND p.body_chars > 0 AND s.body_chars < p.body_chars * 0.5
         THEN 'body-shrank-' || CAST(round_even((1.0 - CAST(s.body_chars AS DOUBLE) / p.body_chars) * 100, 0) AS INT)
              || '%' END AS f2,
    CASE WHEN p.metadata_hash <> s.metadata_hash THEN 'metadata' END AS c1,
    CASE WHEN p.content_hash <> s.content_hash THEN 'content' END AS c2
  FROM staged s LEFT JOIN prior p ON p.type_key = s.type_key AND p.id = s.id),
gated AS (
  SELECT *, concat_ws(',', f1, f2) AS risk, concat_ws(',', c1, c2) AS changed,
    CASE WHEN prior_hash IS NULL THEN 'new' WHEN prior_hash <> metadata_hash THEN 'changed' ELSE 'unchanged' END AS op,
    CASE WHEN f1 IS NOT NULL OR f2 = 'body-dropped' THEN 'held-risky' ELSE 'promoted' END AS action
  FROM rated)"""
GATED_SQL = f"{SNAPSHOTS_SQL}, {STAGED_SQL}, {RATED_SQL}"


def hits(spark: SparkSession, sf: str, whole: bool = False) -> DataFrame:
    """Documents as raw search hits: ``document_type``, ``hit`` VARIANT and ``seq``; with ``whole`` the excerpt is the whole text.

    ``title`` stands in both places, so the top-level one must win; one document in seven
    has no language and one in eleven an empty date.
    """
    d = load(spark, sf, "documents")
    raw = F.struct(
        F.concat(F.lit("P"), F.col("doc_id").cast("string")).alias("permanentid"),
        F.lit("raw title").alias("title"),
        "lang", "n_chars",
        F.when(F.col("n_chars") % 11 != 0, F.lit(BASE_MS) + F.col("doc_id") * 60000).otherwise(0).alias("date"),
        F.array("lang", "source").alias("tags"),
        F.col("text").alias("details"),
    )
    hit = F.struct(
        F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
        F.concat(F.lit("https://kb.example/"), F.col("doc_id").cast("string")).alias("clickUri"),
        (F.col("text") if whole else F.substring("text", 1, 80)).alias("excerpt"),
        raw.alias("raw"),
    )
    return d.select(
        F.col("source").alias("document_type"), F.parse_json(F.to_json(hit)).alias("hit"), F.col("doc_id").alias("seq")
    )


def type_config(spark: SparkSession, sf: str) -> DataFrame:
    """One configuration row per source: ``details`` is content, all else but tags metadata."""
    kept = ["title", "lang", "n_chars", "date", "permanentid", "clickUri"]
    return load(spark, sf, "documents").select(F.col("source").alias("document_type")).distinct().select(
        "document_type", F.col("document_type").alias("type_key"),
        F.array(*[F.lit(k) for k in kept]).alias("keep_metadata"),
        F.array(F.lit("details")).alias("keep_content"),
    )


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as structured log lines."""
    e = load(spark, sf, "events")
    return shape_lines(e)


def shape_lines(e: DataFrame) -> DataFrame:
    """Works on a table and on a stream of it."""
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("ts").cast("timestamp").alias("ts"), "event_id",
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("fn"), (F.col("user_id") % 8).cast("string")).alias("source"),
        F.col("event_type").alias("action"),
        F.concat(F.lit("T"), (F.col("user_id") % 13).cast("string")).alias("type_key"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("id"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("run_date"),
        F.col("value").alias("duration_ms"), k.alias("k"),
    )


LINES_SQL = """
lines AS (
  SELECT ts, event_id, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
    'fn' || (user_id % 8) AS source, event_type AS action, 'T' || (user_id % 13) AS type_key,
    'U' || user_id AS id, strftime(ts, '%Y-%m-%d') AS run_date, value AS duration_ms,
    CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events)"""


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as version history: an article per conversation, a version per turn."""
    c = load(spark, sf, "conversations")
    return c.select(
        F.lit("talk").alias("type_key"), F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("id"),
        "turn", F.timestamp_millis(F.lit(BASE_MS) + F.col("turn") * 60000).alias("archived_at"),
        "role", F.sha2("text", 256).alias("content_hash"),
    )


HISTORY_SQL = f"""
history AS (
  SELECT 'talk' AS type_key, 'C' || conv_id AS id, turn, {BASE_MS} + turn * 60000 AS at_ms, role,
    sha256(text) AS content_hash FROM conversations)"""
