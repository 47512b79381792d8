"""Run views, health, log analytics and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import health as H
from tidemark.operators import KEY, logs, runs
from tidemark.operators.diff import classify_incoming
from tidemark.operators.ordering import top_per_group
from tidemark.queries import scenario as S
from tidemark.queries.registry import ORACLE, query
from tidemark.session import scratch_dir
from tidemark.sources import buckets
from tidemark.streaming import arrivals, gates, jobs, late, quantiles

NOW = S.NOW
LINES = f"WITH {S.LINES_SQL}"


def _n(name="n"):
    return F.count(F.lit(1)).alias(name)


# ── run state from the log lines ─────────────────────────────────────────────


@query("latest_run", f"""{LINES}
SELECT run_date AS run_id, max(epoch_us(ts)) AS ran_us FROM lines GROUP BY 1 ORDER BY 2 DESC LIMIT 1""")
def latest_run(spark, sf):
    ran = S.log_lines(spark, sf).groupBy(F.col("run_date").alias("run_id")).agg(F.max("ts").alias("ran_at"))
    return runs.latest_run(ran).select("run_id", F.unix_micros("ran_at").alias("ran_us"))


@query("age_labels", f"""{LINES}, a AS (SELECT event_id, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(ts)) / 1e6 AS sec FROM lines)
SELECT event_id, CASE WHEN sec < 3600 THEN round_even(sec / 60, 0)::BIGINT || 'm ago'
  WHEN sec < 86400 THEN round_even(sec / 3600, 1)::DECIMAL(20,1) || 'h ago'
  ELSE round_even(sec / 86400, 1)::DECIMAL(20,1) || 'd ago' END AS age FROM a WHERE sec >= 60""")
def age_labels(spark, sf):
    """How long ago each line was written, as a status page says it."""
    micros = F.unix_micros(S.now()) - F.unix_micros("ts")
    rows = S.log_lines(spark, sf).select("event_id", micros.alias("us")).filter("us >= 60000000")
    return rows.select("event_id", H.age_text(F.col("us") / 1000).alias("age"))


@query("status_health", f"""{LINES},
t AS (SELECT type_key, count(*) AS stored, count(*) FILTER (action = 'purchase') AS bodied,
        count(*) FILTER (level = 'ERROR') AS errors, max(ts) AS newest FROM lines GROUP BY 1),
i AS (SELECT type_key, count(*) AS expected, count(*) FILTER (action = 'view') AS written,
        count(*) FILTER (action <> 'view') AS skipped,
        CASE WHEN count(*) FILTER (k = 0) > count(*) FILTER (k = 1) THEN 'partial' ELSE 'ok' END AS status
      FROM lines GROUP BY 1)
SELECT type_key, stored, expected, written + skipped AS written, status, bodied, errors,
  CASE WHEN TIMESTAMP '{NOW}' - newest > INTERVAL 7 DAY THEN 'STALE' WHEN status <> 'ok' THEN 'PARTIAL' ELSE 'OK' END AS health
FROM t JOIN i USING (type_key)""")
def status_health(spark, sf):
    """Health per type from stored rows, the last read, extraction and tracking."""
    rows = S.log_lines(spark, sf)
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    disk = rows.groupBy("type_key").agg(_n("stored"))
    index = rows.groupBy("type_key").agg(
        _n("expected"), is_("action", "view").alias("written"),
        F.count_if(F.col("action") != "view").alias("skipped"),
        F.when(is_("k", 0) > is_("k", 1), "partial").otherwise("ok").alias("status"),
    )
    enrich = rows.groupBy("type_key").agg(_n("enriched"), is_("level", "ERROR").alias("failed"))
    tracked = rows.groupBy("type_key").agg(
        is_("action", "purchase").alias("bodied"), is_("level", "ERROR").alias("errors"), F.max("ts").alias("newest")
    )
    return runs.status_report(disk, index, enrich, tracked, S.now())


@query("overall_health", f"""{LINES},
i AS (SELECT bool_or(x) AS p FROM (SELECT count(*) FILTER (k = 0) > count(*) FILTER (k = 1) AS x FROM lines GROUP BY type_key))
SELECT epoch_us((SELECT max(ts) FROM lines)) AS newest_us, p AS any_partial, CASE WHEN p THEN 'PARTIAL' ELSE 'OK' END AS health FROM i""")
def overall_health(spark, sf):
    """Health of the whole corpus."""
    rows = S.log_lines(spark, sf)
    is_ = lambda v: F.count_if(F.col("k") == v)
    index = rows.groupBy("type_key").agg(F.when(is_(0) > is_(1), "partial").otherwise("ok").alias("status"))
    tracked = rows.groupBy("type_key").agg(F.max("ts").alias("newest"))
    ran = rows.groupBy("run_date").agg(F.min("ts").alias("ran_at"))
    out = runs.overall_health(index, tracked, ran, S.now())
    return out.select(F.unix_micros("newest").alias("newest_us"), "any_partial", "health")


@query("run_view", f"""{LINES}, day AS (SELECT * FROM lines WHERE run_date = '2024-01-15'),
types AS (SELECT type_key, CAST(replace(type_key, 'T', '') AS INT) % 3 = 0 AS enrichable FROM lines GROUP BY ALL),
m AS (SELECT type_key, count(*) FILTER (action = 'purchase') AS d, count(*) FILTER (action = 'signup') AS e,
  count(*) FILTER (action = 'view') AS v, count(*) FILTER (action = 'click') AS c, count(*) AS all_n
  FROM day GROUP BY 1),
j AS (SELECT t.*, coalesce(d, 0) AS d, coalesce(e, 0) AS e, coalesce(v, 0) AS v, coalesce(c, 0) AS c, coalesce(all_n, 0) AS a
  FROM types t LEFT JOIN m USING (type_key))
SELECT type_key, enrichable, d > 20 AS dump_done, e > 20 AS enrich_done,
  CASE WHEN d > 20 THEN d WHEN v > 0 THEN v WHEN c > 20 THEN c ELSE 0 END AS staged,
  CASE WHEN d > 20 THEN a WHEN c > 20 THEN a ELSE 0 END AS server_total,
  CASE WHEN (CASE WHEN enrichable THEN e > 20 ELSE d > 20 END) THEN 'done'
    WHEN enrichable AND d > 20 THEN 'enriching' WHEN d <= 20 AND c > 20 THEN 'dumping (resumed)'
    WHEN d <= 20 AND (v > 0 OR c > 20) THEN 'dumping' WHEN d <= 20 THEN 'queued' ELSE '…' END AS state
FROM j""")
def run_view(spark, sf):
    """One day's lines as the run: purchases are finished reads, signups extractions, clicks cursors."""
    rows = S.log_lines(spark, sf)
    types = rows.select("type_key").distinct().withColumn(
        "enrichable", F.regexp_replace("type_key", "T", "").cast("int") % 3 == 0
    )
    day = rows.filter("run_date = '2024-01-15'")
    is_ = lambda v: F.count_if(F.col("action") == v)
    per = day.groupBy("type_key").agg(
        is_("purchase").alias("d"), is_("signup").alias("e"), is_("click").alias("c"), _n("a")
    )
    yes = F.lit(True).alias("done")
    dump = per.filter("d > 20").select("type_key", yes, F.col("d").alias("count_written"), F.col("a").alias("count_server"))
    enrich = per.filter("e > 20").select("type_key", yes, F.col("e").alias("enriched"), F.lit(0).alias("failed"))
    cursor = per.filter("c > 20").select("type_key", F.col("c").alias("written"), F.col("a").alias("count_server"))
    no_cursor = per.filter("a < 0").select("type_key", F.col("e").alias("enriched"), F.lit(0).alias("failed"))
    out = runs.run_view(types, dump, enrich, cursor, no_cursor, day.filter("action = 'view'"))
    return out.select("type_key", "enrichable", "dump_done", "enrich_done", "staged", "server_total", "state")


@query("run_dates", f"""{LINES} SELECT DISTINCT run_date FROM lines ORDER BY run_date DESC LIMIT 30""")
def run_dates(spark, sf):
    return runs.run_dates(S.log_lines(spark, sf))


@query("gate_waiting", f"""{LINES}
SELECT run_date, count(*) AS waiting FROM (
  SELECT d.run_date, t.type_key FROM (SELECT DISTINCT run_date FROM lines) d, (SELECT DISTINCT type_key FROM lines) t
  EXCEPT SELECT run_date, type_key FROM lines WHERE action = 'purchase' AND k < 30) GROUP BY 1""")
def gate_waiting(spark, sf):
    """Types of each run without their last marker."""
    rows = S.log_lines(spark, sf)
    expected = rows.agg(F.collect_set("type_key")).scalar()  # the configured types, a few dozen
    types = rows.select("run_date").distinct().select("run_date", F.explode(expected).alias("type_key"), F.lit(False).alias("enrichable"))
    markers = rows.filter("action = 'purchase' AND k < 30").select("run_date", "type_key", F.lit("dump").alias("stage"))
    return runs.not_terminal(types, markers).groupBy("run_date").agg(F.count("*").alias("waiting"))


@query("hold_ages", f"""{LINES}, g AS (
  SELECT run_date, count(*) AS remaining, max(ts) AS last_ts FROM lines WHERE level = 'ERROR' GROUP BY 1),
h AS (SELECT *, (epoch_us(TIMESTAMP '{NOW}') / 1e6 - epoch_us(last_ts) / 1e6) / 3600.0 AS hours FROM g)
SELECT run_date, remaining, round_even(hours, 1) AS age_hours, hours >= 24.0 AS escalate FROM h""")
def hold_ages(spark, sf):
    """Errors as open holds: how many per run, their age, and whether to escalate."""
    held = S.log_lines(spark, sf).filter("level = 'ERROR'").select("run_date", F.col("ts").alias("updated_at"))
    return runs.hold_ages(held, S.now())


@query("stall_classes", f"""{LINES}
SELECT CASE WHEN k % 5 = 0 THEN 'orphan' WHEN k % 3 = 0 THEN 'skip_active' WHEN k % 2 = 0 AND duration_ms / 100 < 1 THEN 'skip_active'
  WHEN k % 7 >= 3 THEN 'cap' ELSE 'redrive' END AS decision, count(*) AS n FROM lines GROUP BY 1""")
def stall_classes(spark, sf):
    """Log lines as stuck stages."""
    k = F.col("k")
    age = F.when(k % 2 == 0, F.col("duration_ms") / 100)
    kind = H.stall_class(k % 5 != 0, k % 3 != 0, age, k % 7)
    return S.log_lines(spark, sf).groupBy(kind.alias("decision")).agg(_n())


@query("run_modes", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date, CASE WHEN dayofweek(o_orderdate) = 0 THEN 'full' ELSE 'incremental' END
  AS mode FROM orders""")
def run_modes(spark, sf):
    """Order days as run days: Sundays are full."""
    d = F.col("o_orderdate").cast("date")
    return S.load(spark, sf, "orders").select(d.alias("run_date"), H.run_mode(d).alias("mode")).distinct()


@query("error_classes", r"""
WITH m AS (SELECT CASE event_type WHEN 'signup' THEN 'Read timed out' WHEN 'click' THEN 'Connection lost'
  ELSE 'HTTP ' || (CASE event_type WHEN 'purchase' THEN 500 ELSE 400 END + CAST(json_extract_string(props, '$.k') AS INT))
  END AS msg FROM events)
SELECT CASE WHEN contains(msg, '404') THEN 'not-found' WHEN contains(msg, '403') OR contains(msg, '401') THEN 'forbidden'
  WHEN contains(msg, 'timed out') THEN 'timeout' WHEN contains(msg, '429') THEN 'rate-limited' WHEN regexp_matches(msg, '\b5\d\d\b') THEN 'server-error'
  WHEN contains(msg, 'Connection') THEN 'network' ELSE 'other' END AS klass, count(*) AS n FROM m GROUP BY 1""")
def error_classes(spark, sf):
    status = F.when(F.col("action") == "purchase", 500).otherwise(400) + F.col("k")
    message = (
        F.when(F.col("action") == "signup", "Read timed out")
        .when(F.col("action") == "click", "Connection lost")
        .otherwise(F.concat(F.lit("HTTP "), status.cast("string")))
    )
    return runs.error_classes(S.log_lines(spark, sf).select(message.alias("body_error")))


@query("changelog_tally", f"""{LINES}
SELECT action AS op, count(*) AS n FROM lines WHERE run_date = (SELECT max(run_date) FROM lines) GROUP BY 1""")
def changelog_tally(spark, sf):
    """Operations of the latest run."""
    rows = S.log_lines(spark, sf).select(F.col("run_date").alias("run_id"), F.col("action").alias("op"), "ts")
    ran = rows.groupBy("run_id").agg(F.max("ts").alias("ran_at"))
    return runs.changelog_tally(rows.drop("ts"), ran)


@query("type_totals", f"""{LINES}
SELECT type_key, count(*) AS total, count(*) FILTER (action = 'purchase') AS bodied,
  count(*) FILTER (level = 'ERROR') AS errors, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest FROM lines GROUP BY 1""")
def type_totals(spark, sf):
    rows = S.log_lines(spark, sf).select(
        "type_key", F.when(F.col("action") == "purchase", 1).otherwise(0).alias("has_body"),
        F.when(F.col("level") == "ERROR", "HTTP 500").otherwise("").alias("body_error"), F.col("ts").alias("captured_at"),
    )
    return runs.type_totals(rows).withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


# ── log analytics ────────────────────────────────────────────────────────────


@query("latency_by_type", f"""{LINES}
SELECT type_key, round(CAST(sum(CAST(duration_ms AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS avg_ms,
  max(duration_ms) AS max_ms, count(*) AS pages FROM lines WHERE action = 'view' GROUP BY 1""")
def latency_by_type(spark, sf):
    rows = S.log_lines(spark, sf).withColumn("duration_ms", F.col("duration_ms").cast("decimal(18,2)"))
    out = logs.latency_by_type(rows, "view")
    return out.select(
        "type_key", F.round(F.col("avg_ms").cast("double"), 6).alias("avg_ms"),
        F.col("max_ms").cast("double").alias("max_ms"), "pages",
    )


@query("log_errors", f"""{LINES}
SELECT event_id, source, type_key FROM lines WHERE level = 'ERROR' AND ts >= TIMESTAMP '{NOW}' - to_minutes(14400)
ORDER BY ts DESC, event_id DESC LIMIT 100""")
def log_errors(spark, sf):
    return logs.recent_errors(S.log_lines(spark, sf), 14400, S.now(), limit=100).select("event_id", "source", "type_key")


@query("log_search", f"""{LINES}, r AS (
  SELECT * FROM lines WHERE level = 'INFO' AND ts >= TIMESTAMP '{NOW}' - to_minutes(43200))
SELECT event_id, action || ' · ' || type_key || ' · ' || id || ' · ' || run_date AS summary FROM r
WHERE contains(lower(action), 'purch') ORDER BY ts DESC, event_id DESC LIMIT 300""")
def log_search(spark, sf):
    """The 300 newest lines of a level that hold a substring."""
    out = logs.search_logs(S.log_lines(spark, sf), 43200, S.now(), level="info", query="Purch", limit=300)
    return out.select("event_id", "summary")


@query("run_timeline", f"""{LINES}
SELECT event_id, source, action FROM lines WHERE run_date = '2024-01-15' ORDER BY ts, event_id""")
def run_timeline(spark, sf):
    return logs.run_timeline(S.log_lines(spark, sf), "2024-01-15").select("event_id", "source", "action")


@query("article_history", f"""{LINES} SELECT event_id, action FROM lines WHERE id = 'U7'""")
def article_history(spark, sf):
    return logs.article_history(S.log_lines(spark, sf), "U7").select("event_id", "action")


@query("write_conflicts", f"""{LINES}
SELECT event_id, a AS action FROM (SELECT *, CASE WHEN k % 3 = 0 THEN action || '_won' WHEN k % 3 = 1 THEN action || '_lost_412'
  ELSE action END AS a FROM lines) WHERE regexp_matches(a, '(_won|_lost_412)') ORDER BY ts DESC, event_id DESC LIMIT 500""")
def write_conflicts(spark, sf):
    m = F.col("k") % 3
    rows = S.log_lines(spark, sf).withColumn(
        "action", F.concat("action", F.when(m == 0, "_won").when(m == 1, "_lost_412").otherwise(""))
    )
    return logs.write_conflicts(rows, limit=500).select("event_id", "action")


@query("ack_latency", f"""{LINES}
SELECT event_id, duration_ms FROM lines WHERE action = 'click' ORDER BY ts DESC, event_id DESC LIMIT 200""")
def ack_latency(spark, sf):
    rows = S.log_lines(spark, sf).withColumn(
        "action", F.when(F.col("action") == "click", "ack_sent").otherwise(F.col("action"))
    )
    return logs.ack_latency(rows, limit=200).select("event_id", "duration_ms")


@query("group_caps", f"""{LINES}
SELECT source, event_id FROM lines QUALIFY row_number() OVER (PARTITION BY source ORDER BY ts DESC, event_id DESC) <= 5""")
def group_caps(spark, sf):
    """Newest five lines per source."""
    return top_per_group(S.log_lines(spark, sf), ["source"], logs.by_time(S.log_lines(spark, sf)), 5).select("source", "event_id")


def _platform_lines(spark, sf):
    rows = S.log_lines(spark, sf)
    ms = F.col("duration_ms").cast("decimal(18,2)").cast("string")
    billed = F.ceil("duration_ms").cast("string")
    line = F.concat(
        F.lit("REPORT RequestId: x Duration: "), ms, F.lit(" ms  Billed Duration: "), billed,
        F.lit(" ms  Memory Size: 512 MB Max Memory Used: "), (F.col("k") + 100).cast("string"), F.lit(" MB"),
    )
    return rows.select("source", "ts", F.when(F.col("level") == "ERROR", "START x").otherwise(line).alias("message"))


COST_SQL = f"""{LINES}, g AS (
  SELECT source, count(*) AS invocations, CAST(sum(CAST(ceil(duration_ms) AS BIGINT)) AS BIGINT) AS billed_ms,
    max(k) + 100 AS max_memory_mb, max(duration_ms) AS max_duration_ms FROM lines WHERE level <> 'ERROR' GROUP BY 1),
c AS (SELECT *, billed_ms / 1000.0::DOUBLE * (512 / 1024.0::DOUBLE) AS gb FROM g)
"""


@query("cost_rollup", COST_SQL + """
SELECT source, invocations, billed_ms, 512 AS memory_mb, max_memory_mb, max_duration_ms, round_even(gb, 1) AS gb_seconds,
  round_even(gb * 0.0000166667::DOUBLE + invocations * (0.20::DOUBLE / 1000000), 4) AS est_usd FROM c""")
def cost_rollup(spark, sf):
    return logs.cost_rollup(_platform_lines(spark, sf))


@query("cost_totals", COST_SQL + """
SELECT CAST(sum(invocations) AS BIGINT) AS invocations, round_even(sum(round_even(gb, 1)), 1) AS gb_seconds,
  round_even(sum(round_even(gb * 0.0000166667::DOUBLE + invocations * (0.20::DOUBLE / 1000000), 4)), 4) AS est_usd FROM c""")
def cost_totals(spark, sf):
    return logs.cost_totals(logs.cost_rollup(_platform_lines(spark, sf)))


# ── metrics: batch and stream over the same points ───────────────────────────

ACTIONS = {
    "view": "article_staged", "purchase": "article_auto_approved", "signup": "article_held",
    "error": "article_enrich_failed", "click": "sns_published",
}


def _metric_lines(lines):
    action = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])
    return lines.withColumn("final", F.col("k") % 2 == 0).withColumn(
        "batch", F.when(F.col("k") < 50, "auto").otherwise("holds")
    ).withColumn("action", F.element_at(action, F.col("action")))


POINTS_SQL = f"""{LINES}, points AS (
  SELECT ts, 'ArticlesStaged' AS metric, type_key AS dim FROM lines WHERE action = 'view'
  UNION ALL SELECT ts, 'ArticlesAutoApproved', '' FROM lines WHERE action = 'purchase'
  UNION ALL SELECT ts, 'ArticlesHeld', '' FROM lines WHERE action = 'signup'
  UNION ALL SELECT ts, 'EnrichFailed', type_key FROM lines WHERE action = 'error' AND k % 2 = 0
  UNION ALL SELECT ts, 'Published', CASE WHEN k < 50 THEN 'auto' ELSE 'holds' END FROM lines WHERE action = 'click'
  UNION ALL SELECT ts, 'ErrorCount', source FROM lines WHERE level = 'ERROR')
SELECT epoch_ms(time_bucket(INTERVAL 5 MINUTE, ts)) AS window_ms, metric, dim, count(*) AS n FROM points GROUP BY ALL"""


def _ms(df):
    return df.withColumn("window_ms", F.unix_millis("window_start")).drop("window_start")


@query("metric_counts", POINTS_SQL)
def metric_counts(spark, sf):
    """Log-derived metrics in five-minute periods, batch form."""
    return _ms(logs.metric_counts(logs.metric_points(_metric_lines(S.log_lines(spark, sf))), "5 minutes"))


def _stream(spark, sf):
    S.configure(spark)
    return S.shape_lines(jobs.parquet_source(spark, f"{sf.rstrip('/')}/events.parquet"))


def _slices(spark, sf, parts=4, held_back=None):
    """All events as folders of equal spans of time, landed one after the other; the stream takes one per batch.

    Rows for which ``held_back`` is true land one span too late.
    One pass deals the rows to their spans; each span then lands as so many files as there are shuffle partitions, which is what a batch takes.
    """
    staging, path = scratch_dir(spark, "spans"), scratch_dir(spark, "slices")
    e, files = S.load(spark, sf, "events"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = e.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        e.write.parquet(path)
    else:
        span = F.call_function("div", micros - low, F.lit((high - low) // parts + 1)).cast("int")
        if held_back is not None:
            span = F.least(span + F.when(held_back, 1).otherwise(0), F.lit(parts - 1))
        e.withColumn("span", F.coalesce(span, F.lit(0))).write.partitionBy("span").parquet(staging)
        for i in range(parts):
            spark.read.parquet(staging).filter(F.col("span") == i).drop("span").repartition(files).write.mode("append").parquet(path)
    return S.shape_lines(spark.readStream.schema(e.schema).option("maxFilesPerTrigger", files).parquet(path))


@query("stream_metric_windows", POINTS_SQL)
def stream_metric_windows(spark, sf):
    """The same metrics from the stream."""
    windows = jobs.metric_windows(logs.metric_points(_metric_lines(_stream(spark, sf))))
    return _ms(jobs.run_available(windows, spark, "metrics", "update", ["window_start", "metric", "dim"]))


def _late_windows(spark, sf):
    """(folder, stream schema, batch points, keys, counts, last epoch) once a stream with one row in twenty a week late has run."""
    keys, count, base = ["metric", "dim"], [_n()], scratch_dir(spark, "late")
    points = logs.metric_points(_metric_lines(_slices(spark, sf, held_back=F.col("event_id") % 20 == 0)))
    stream, ran = late.windows_with_rows(points, keys, count), []
    store = late.store_epoch(spark, base)

    def run(batch, epoch):
        store(batch, epoch)
        ran.append(epoch)

    stream.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", f"{base}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    full = logs.metric_points(_metric_lines(S.log_lines(spark, sf)))
    return base, stream.schema, full, keys, count, max(ran, default=-1)


@query("stream_late_rows", POINTS_SQL)
def stream_late_rows(spark, sf):
    """The same metrics from a stream whose late rows the watermark has passed, after the back-stop counted their windows again."""
    base, schema, full, keys, count, last = _late_windows(spark, sf)
    late.repair(spark, base, schema, full, keys, count, last)
    return _ms(late.windows_after(spark, base, schema, keys, [last]))


@query("stream_error_alarms", f"""{LINES}
SELECT epoch_ms(time_bucket(INTERVAL 15 MINUTE, ts)) AS window_ms, count(*) AS errors FROM lines WHERE level = 'ERROR' GROUP BY 1""")
def stream_error_alarms(spark, sf):
    return _ms(jobs.run_available(jobs.error_alarms(_stream(spark, sf)), spark, "alarms", "update", ["window_start"]))


@query("stream_p99", f"""{LINES}
SELECT epoch_ms(time_bucket(INTERVAL 15 MINUTE, ts)) AS window_ms, quantile_disc(duration_ms, 0.99) AS p99, count(*) AS n
FROM lines WHERE action = 'view' GROUP BY 1 HAVING quantile_disc(duration_ms, 0.99) > 100""")
def stream_p99(spark, sf):
    """99th percentile per quarter hour over a limit."""
    p99 = jobs.p99_alarms(jobs.latency_p99(_stream(spark, sf), "view"), 100)
    return _ms(jobs.run_available(p99, spark, "p99", "update", ["window_start"]))


@query("stream_p99_exact", f"""{LINES}
SELECT epoch_ms(time_bucket(INTERVAL 1 DAY, ts)) AS window_ms, quantile_disc(duration_ms, 0.99) AS p99, count(duration_ms) AS n
FROM lines WHERE duration_ms IS NOT NULL GROUP BY 1""")
def stream_p99_exact(spark, sf):
    """Exact 99th percentile per day: counts in bins from the stream, narrowed down in the landed rows."""
    bins = quantiles.latency_bins(_stream(spark, sf), "duration_ms", "1 day")
    counted = jobs.run_available(bins, spark, "bins", "update", ["window_start", "bin"])
    found = quantiles.exact_quantile(counted, S.log_lines(spark, sf), "duration_ms", "0.99", "1 day")
    return _ms(found.withColumnRenamed("value", "p99"))


@query("stream_recent_counts", f"""{LINES}, w AS (
  SELECT action, epoch_ms(time_bucket(INTERVAL 10 MINUTE, ts)) - 600000 * unnest(range(0, 6)) AS window_ms FROM lines)
SELECT window_ms, action, count(*) AS n FROM w GROUP BY ALL""")
def stream_recent_counts(spark, sf):
    """Counts of the last hour every ten minutes."""
    return _ms(jobs.run_available(
        jobs.recent_counts(_stream(spark, sf)), spark, "recent", "update", ["window_start", "action"]
    ))


@query("stream_dedup", f"""{LINES} SELECT DISTINCT type_key, id, action AS content_hash FROM lines""")
def stream_dedup(spark, sf):
    """Redelivered versions of an article pass once, in several batches."""
    rows = _slices(spark, sf).select("ts", "type_key", "id", F.col("action").alias("content_hash"))
    return jobs.run_available(jobs.drop_redeliveries(rows), spark, "dedup").drop("ts")


@query("stream_dedup_indexed", ORACLE["stream_dedup"])
def stream_dedup_indexed(spark, sf):
    """The same versions, told from an index of delivered ones instead of keyed state."""
    base = scratch_dir(spark, "deliver")
    rows = _slices(spark, sf).select("ts", "type_key", "id", F.col("action").alias("content_hash"))
    _consumed(rows, arrivals.deliver_once(spark, base, compact_every=2, many=16), base)
    return spark.read.schema(rows.schema).parquet(f"{base}/out").select("type_key", "id", "content_hash")


@query("stream_run_counters", f"""{LINES}
SELECT run_date, type_key, count(*) FILTER (action = 'signup') AS new, count(*) FILTER (action = 'click') AS changed,
  count(*) FILTER (action = 'view') AS unchanged FROM lines GROUP BY ALL""")
def stream_run_counters(spark, sf):
    op = F.create_map(*[F.lit(x) for x in ("signup", "new", "click", "changed", "view", "unchanged")])
    rows = _stream(spark, sf).withColumn("op", F.coalesce(F.element_at(op, F.col("action")), F.lit("other")))
    return jobs.run_available(jobs.run_counters(rows), spark, "counters", "update", ["run_date", "type_key"])


@query("stream_gate_once", f"""{LINES}
SELECT run_date, count(DISTINCT type_key) AS types FROM lines WHERE action <> 'error' GROUP BY 1
HAVING count(DISTINCT type_key) >= 13""")
def stream_gate_once(spark, sf):
    """A run's gate opens once, when all 13 types have logged their last stage, in several batches."""
    markers = _slices(spark, sf).filter("action <> 'error'")
    return jobs.run_available(gates.gate_once(markers, 13), spark, "gate", "update", ["run_date"]).drop("opened_at")


@query("stream_hold_timeout")
def stream_hold_timeout(spark, sf):
    """Holds open for a day of event time (checked against a brute-force replay in the tests)."""
    restore = gates.use_rocksdb(spark)
    rows = _stream(spark, sf).filter("action IN ('error', 'purchase')").withColumn(
        "action", F.when(F.col("action") == "error", "held").otherwise("resolved")
    )
    try:
        return jobs.run_available(gates.escalate_holds(rows), spark, "holds")
    finally:
        restore()


@query("stream_classify", f"""{LINES},
latest AS (SELECT type_key, id, arg_max(action, ts) AS h FROM lines GROUP BY ALL),
idx AS (SELECT DISTINCT type_key, id FROM lines WHERE k < 20)
SELECT l.type_key, l.id, l.h AS metadata_hash,
  CASE WHEN i.id IS NULL THEN 'new' WHEN l.h <> 'view' THEN 'changed' ELSE 'unchanged' END AS op
FROM latest l LEFT JOIN idx i ON i.type_key = l.type_key AND i.id = l.id""")
def stream_classify(spark, sf):
    """The index after arriving rows were classified batch by batch, against the one before; the action stands for the hash."""
    base = scratch_dir(spark, "classify")
    initial = S.log_lines(spark, sf).filter("k < 20").select(*KEY).distinct().withColumn("metadata_hash", F.lit("view"))
    rows = _slices(spark, sf).select(*KEY, F.col("action").alias("metadata_hash"), "ts")
    run = arrivals.classify_epoch(spark, f"{base}/index", f"{base}/staged", initial, compact_every=3)
    rows.writeStream.foreachBatch(run).option("checkpointLocation", f"{base}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    after = arrivals.index_after(spark, f"{base}/index", f"{base}/staged")
    op = F.when(F.col("op") == "edited", "changed").otherwise(F.col("op"))
    return classify_incoming(after, initial).select(*KEY, "metadata_hash", op.alias("op"))


def _manifests(spark, sf):
    """(folder, live rows, stream of four manifests that list them, store to start from)."""
    base = scratch_dir(spark, "consumer")
    live = S.current(spark, sf).select(*KEY, "content_hash", "doc_id")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for i in range(4):
        live.filter(F.col("doc_id") % 4 == i).select(*KEY).repartition(files).write.mode("append").json(f"{base}/manifests")
    manifests = jobs.json_source(spark, f"{base}/manifests", "type_key string, id string", files)
    return base, live, manifests, S.prior(spark, sf).select(*KEY, "content_hash")


def _consumed(manifests, run, base):
    manifests.writeStream.foreachBatch(run).option("checkpointLocation", f"{base}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()


@query("stream_consumer", f"""{S.SNAPSHOTS_SQL}
SELECT coalesce(c.type_key, p.type_key) AS type_key, coalesce(c.id, p.id) AS id, coalesce(c.content_hash, p.content_hash) AS content_hash
FROM prior p FULL JOIN current_ c ON c.type_key = p.type_key AND c.id = p.id""")
def stream_consumer(spark, sf):
    """A consumer's store after polling four manifests that list the articles read."""
    base, live, manifests, start = _manifests(spark, sf)
    run = arrivals.consume_epoch(spark, f"{base}/store", lambda: live.drop("doc_id"), start)
    _consumed(manifests, run, base)
    return arrivals.store_after(spark, f"{base}/store")


@query("stream_consumer_compacted", ORACLE["stream_consumer"])
def stream_consumer_compacted(spark, sf):
    """The same store with its epochs merged into a bucketed base every second epoch."""
    base, live, manifests, start = _manifests(spark, sf)
    run = arrivals.consume_compacted(spark, f"{base}/store", lambda: live.drop("doc_id"), start, compact_every=2, many=16)
    _consumed(manifests, run, base)
    last = max(map(int, buckets.folders(spark, f"{base}/store/delta", "epoch")), default=-1)
    return arrivals.compacted_store(start, f"{base}/store", last, 2)
