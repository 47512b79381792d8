"""Queries over structured log lines: searches, latency, cost and metric counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import newest, top_per_group

# The platform line that closes an invocation, and the prices behind the estimate.
REPORT = (
    r"Duration: ([\d.]+) ms\s+Billed Duration: (\d+) ms\s+"
    r"Memory Size: (\d+) MB\s+Max Memory Used: (\d+) MB"
)
USD_PER_GB_SECOND = 0.0000166667
USD_PER_REQUEST = 0.20 / 1_000_000
# Fields of the one-line summary, in order.
SUMMARY_FIELDS = ["action", "type_key", "id", "run_date", "err_msg", "reason"]


def since(df: DataFrame, minutes: int, now: Column, ts: str = "ts") -> DataFrame:
    return df.filter(F.col(ts) >= now - F.expr(f"INTERVAL {int(minutes)} MINUTES"))


def by_time(lines: DataFrame, latest_first: bool = True) -> list[Column]:
    """Order by time, then by event id where there is one, so that ties do not decide a cut."""
    return [F.desc(c) if latest_first else F.asc(c) for c in ("ts", "event_id") if c in lines.columns]


def recent_errors(lines: DataFrame, minutes: int, now: Column, *, limit: int) -> DataFrame:
    """The ``limit`` newest error lines."""
    return newest(since(lines, minutes, now).filter(F.col("level") == "ERROR"), by_time(lines), limit)


def summary_line(lines: DataFrame) -> Column:
    """The message, else the filled ones of six fields joined by a dot."""
    filled = [
        F.nullif(F.col(c).cast("string"), F.lit("")) if c in lines.columns else F.lit(None).cast("string")
        for c in SUMMARY_FIELDS
    ]
    joined = F.concat_ws(" · ", *filled)
    return F.coalesce(F.nullif(F.col("msg"), F.lit("")), joined) if "msg" in lines.columns else joined


def search_logs(lines: DataFrame, minutes: int, now: Column, level: str = "all", query: str = "",
                source: str = "all", *, limit: int, share: int | None = None) -> DataFrame:
    """Log view: level, substring of the record or its summary, the ``limit`` newest matches first.

    With ``share``, each source contributes at most so many of its matches, so a chatty one
    cannot crowd out the rest; the share is taken in the map stage.
    """
    out = since(lines, minutes, now)
    if source not in ("", "all"):
        out = out.filter(F.col("source") == source)
    if level != "all":
        out = out.filter(F.col("level") == level.upper())
    out = out.withColumn("summary", summary_line(lines))
    if query:
        q = query.lower()
        record = F.lower(F.to_json(F.struct(*lines.columns)))
        out = out.filter(record.contains(q) | F.lower(F.col("summary")).contains(q))
    order = by_time(out)
    if share:
        out = top_per_group(out, ["source"], order, share)
    return newest(out, order, limit)


def run_timeline(lines: DataFrame, run_date) -> DataFrame:
    """All lines of a run, oldest first."""
    return lines.filter(F.col("run_date") == run_date).orderBy(*by_time(lines, False))


def article_history(lines: DataFrame, art_id: str) -> DataFrame:
    return lines.filter(F.col("id") == art_id).orderBy(*by_time(lines, False))


def write_conflicts(lines: DataFrame, *, limit: int) -> DataFrame:
    """Who won and who lost each conditional write."""
    return newest(lines.filter(F.col("action").rlike(r"(_won|_lost_412)")), by_time(lines), limit)


def ack_latency(lines: DataFrame, *, limit: int) -> DataFrame:
    return newest(lines.filter(F.col("action") == "ack_sent"), by_time(lines), limit)


def latency_by_type(lines: DataFrame, action: str = "page_fetched") -> DataFrame:
    """Average and maximum duration and number of pages per type, slowest first."""
    ms = F.col("duration_ms")
    return (
        lines.filter(F.col("action") == action)
        .groupBy("type_key")
        .agg(F.avg(ms).alias("avg_ms"), F.max(ms).alias("max_ms"), F.count(F.lit(1)).alias("pages"))
        .orderBy(F.desc("avg_ms"))
    )


def with_report_fields(df: DataFrame, message: str = "message") -> DataFrame:
    """Add duration, billed time, memory size and peak memory of a platform line; null on other lines.

    The line is matched once; the four numbers are then split out of the match.
    """
    line = F.col(message)
    numbers = F.regexp_replace(line, r"(?s)^REPORT .*?" + REPORT + r".*$", r"$1 $2 $3 $4")
    out = df.withColumn("_numbers", F.when(line.startswith("REPORT "), numbers)).withColumn(
        "_parts", F.when(F.col("_numbers") != line, F.split("_numbers", " "))
    )
    part = lambda i, kind: F.try_element_at("_parts", F.lit(i)).cast(kind)
    return (
        out.withColumn("duration_ms", part(1, "double"))
        .withColumn("billed_ms", part(2, "bigint"))
        .withColumn("memory_mb", part(3, "int"))
        .withColumn("max_memory_mb", part(4, "int"))
        .drop("_numbers", "_parts")
    )


def cost_rollup(lines: DataFrame, message: str = "message", by: str = "source", order: str = "ts") -> DataFrame:
    """Invocations, billed time, peaks, GB-seconds and estimated cost per source.

    The memory size is that of the latest line, as the setting can change.
    """
    parsed = with_report_fields(lines.select(by, order, message), message).filter(F.col("billed_ms").isNotNull())
    grouped = parsed.groupBy(by).agg(
        F.count(F.lit(1)).alias("invocations"), F.sum("billed_ms").alias("billed_ms"),
        F.max_by("memory_mb", order).alias("memory_mb"), F.max("max_memory_mb").alias("max_memory_mb"),
        F.max("duration_ms").alias("max_duration_ms"),
    )
    gb_s = F.col("billed_ms") / 1000.0 * (F.col("memory_mb") / 1024.0)
    return grouped.withColumn("gb_seconds", F.bround(gb_s, 1)).withColumn(
        "est_usd", F.bround(gb_s * USD_PER_GB_SECOND + F.col("invocations") * USD_PER_REQUEST, 4)
    )


def cost_totals(rollup: DataFrame) -> DataFrame:
    return rollup.agg(
        F.sum("invocations").alias("invocations"), F.bround(F.sum("gb_seconds"), 1).alias("gb_seconds"),
        F.bround(F.sum("est_usd"), 4).alias("est_usd"),
    )


# Metric name, the log action it counts, and its dimension.
METRICS = [
    ("ArticlesStaged", "article_staged", "type_key"),
    ("ArticlesAutoApproved", "article_auto_approved", None),
    ("ArticlesHeld", "article_held", None),
    ("EnrichFailed", "article_enrich_failed", "type_key"),
    ("Published", "sns_published", "batch"),
]


def metric_points(lines: DataFrame) -> DataFrame:
    """Log lines as metric points ``(ts, metric, dim)``; one line can feed several metrics.

    A failed extraction counts only when it is final; every error line counts by source.
    """
    def dim(name):
        return F.col(name).cast("string") if name and name in lines.columns else F.lit("")

    points = [
        F.when(
            (F.col("action") == action)
            & (F.coalesce("final", F.lit(False)) if action == "article_enrich_failed" else F.lit(True)),
            F.struct(F.lit(metric).alias("metric"), F.coalesce(dim(d), F.lit("")).alias("dim")),
        )
        for metric, action, d in METRICS
    ]
    points.append(
        F.when(
            F.col("level") == "ERROR",
            F.struct(F.lit("ErrorCount").alias("metric"), F.coalesce("source", F.lit("")).alias("dim")),
        )
    )
    return lines.select("ts", F.explode(F.array_compact(F.array(*points))).alias("_p")).select("ts", "_p.*")


def metric_counts(points: DataFrame, period: str) -> DataFrame:
    return (
        points.groupBy(F.window("ts", period), "metric", "dim")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "metric", "dim", "n")
    )
