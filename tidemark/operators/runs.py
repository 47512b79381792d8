"""Run and health views over the run-state tables.

Run-state tables hold one row per (run, type, stage), so they stay small whatever the
corpus size; the large tables enter these joins only as counts per type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import health as H
from tidemark.functions import risk as R


def run_dates(rows: DataFrame, limit: int = 30) -> DataFrame:
    """Newest run dates first, capped (a list view)."""
    return rows.select("run_date").distinct().orderBy(F.desc("run_date")).limit(limit)


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("ran_at"), F.desc("run_id")).limit(1)


def type_totals(articles: DataFrame) -> DataFrame:
    """Per type: rows, rows with a body, rows with an error, newest capture."""
    error = F.coalesce("body_error", F.lit("")) != ""
    return articles.groupBy("type_key").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("has_body") == 1).alias("bodied"),
        F.count_if(error).alias("errors"), F.max("captured_at").alias("newest"),
    )


def corpus_totals(articles: DataFrame) -> DataFrame:
    return articles.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("has_body") == 1).alias("bodied"),
        F.max("captured_at").alias("newest"),
    )


def error_classes(articles: DataFrame, error: str = "body_error") -> DataFrame:
    """Errors per class, most first."""
    bad = articles.filter(F.coalesce(F.col(error), F.lit("")) != "")
    return (
        bad.groupBy(R.classify_error(F.col(error)).alias("klass"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "klass")
    )


def changelog_tally(changelog: DataFrame, runs: DataFrame) -> DataFrame:
    """Changelog rows of the latest run by operation."""
    last = runs.agg(F.max_by("run_id", "ran_at")).scalar()
    return changelog.filter(F.col("run_id") == last).groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def status_report(disk: DataFrame, dump_index: DataFrame, enrich: DataFrame, tracked: DataFrame,
                  now: Column) -> DataFrame:
    """Per type: stored rows, expected and written by the last read, bodies and errors, health.

    Tracked counts replace those of the extraction report where both exist. A type known
    to the tracking table alone is no part of the report.
    """
    base = disk.join(dump_index, "type_key", "full_outer")
    e = enrich.select("type_key", F.col("enriched").alias("_e"), F.col("failed").alias("_f"))
    t = tracked.select("type_key", F.col("bodied").alias("_b"), F.col("errors").alias("_x"), "newest")
    j = base.join(e, "type_key", "left").join(t, "type_key", "left")
    stale = F.unix_micros(now) / 1e6 - F.unix_micros(F.col("newest")) / 1e6
    partial = F.coalesce(F.col("status") != "ok", F.lit(False)) | F.col("newest").isNull()
    return j.select(
        "type_key", F.coalesce("stored", F.lit(0)).alias("stored"), "expected",
        F.when(
            F.coalesce("written", "skipped").isNotNull(),
            F.coalesce("written", F.lit(0)) + F.coalesce("skipped", F.lit(0)),
        ).alias("written"),
        "status", F.coalesce("_b", "_e").alias("bodied"), F.coalesce("_x", "_f").alias("errors"),
        H.health_label(stale, partial).alias("health"),
    )


def overall_health(dump_index: DataFrame, tracked: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """One row for the whole corpus: stale by the newest capture or run, partial if any type is."""
    newest = tracked.agg(F.max("newest")).scalar()
    return dump_index.agg(
        F.coalesce(F.bool_or(F.col("status") != "ok"), F.lit(False)).alias("any_partial")
    ).select(
        F.greatest(newest, runs.agg(F.max("ran_at")).scalar()).alias("newest"), "any_partial"
    ).select(
        "newest", "any_partial",
        H.health_label(
            F.unix_micros(now) / 1e6 - F.unix_micros("newest") / 1e6,
            F.col("any_partial") | F.col("newest").isNull(),
        ).alias("health"),
    )


def dump_index(per_type: DataFrame, full: Column, limited: Column) -> DataFrame:
    """Status of each type of a read from its counts."""
    present = F.col("written") + F.col("skipped") + F.col("staged")
    failed = F.col("error").isNotNull()
    return per_type.withColumn(
        "status",
        H.run_status(full, limited, F.col("expected"), present, F.col("write_errors"), failed),
    )


def run_index(types: DataFrame) -> DataFrame:
    """One row: how many types were read, and how many of them ok, partial and failed."""
    n = lambda s: F.count_if(F.col("status") == s)
    return types.agg(
        F.count(F.lit(1)).alias("types"), n("ok").alias("ok"), n("partial").alias("partial"),
        n("failed").alias("failed"), F.coalesce(F.sum("written"), F.lit(0)).alias("total_articles"),
    )


def run_index_document(types: DataFrame, mode: str, cutoff: Column, generated: Column) -> DataFrame:
    """The run index as one JSON document: counts and a list with one entry per type."""
    entry = F.struct(*[c for c in types.columns])
    doc = F.struct(
        F.lit(mode).alias("mode"), cutoff.alias("cutoff"), generated.alias("generatedAt"),
        F.sum("written").alias("totalArticles"),
        F.struct(
            F.count(F.lit(1)).alias("types"),
            F.count_if(F.col("status") == "ok").alias("ok"),
            F.count_if(F.col("status") == "partial").alias("partial"),
            F.count_if(F.col("status") == "failed").alias("failed"),
        ).alias("counts"),
        # One entry per configured type, so the list is bounded by the configuration.
        F.array_sort(F.collect_list(entry)).alias("types"),
    )
    return types.agg(F.to_json(doc).alias("document"))


def run_view(types: DataFrame, dump: DataFrame, enrich: DataFrame, dump_cursor: DataFrame,
             enrich_cursor: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row per type of a run with its counts and state.

    ``types`` has ``type_key`` and ``enrichable``; ``dump`` and ``enrich`` have ``done``
    and their counts; the cursors exist only while a stage is under way.
    """
    staged = manifest.groupBy("type_key").agg(F.count(F.lit(1)).alias("_manifest"))
    d = dump.select("type_key", F.col("done").alias("_dd"), "count_written", F.col("count_server").alias("_ds"))
    e = enrich.select("type_key", F.col("done").alias("_ed"), F.col("enriched").alias("_ee"), F.col("failed").alias("_ef"))
    dc = dump_cursor.select("type_key", F.lit(True).alias("_dc"), F.col("written").alias("_dw"), F.col("count_server").alias("_dcs"))
    ec = enrich_cursor.select("type_key", F.lit(True).alias("_ec"), F.col("enriched").alias("_ece"), F.col("failed").alias("_ecf"))
    j = types
    for side in (d, e, dc, ec, staged):
        j = j.join(side, "type_key", "left")
    no, zero = F.lit(False), F.lit(0)
    dump_done, enrich_done = F.coalesce("_dd", no), F.coalesce("_ed", no)
    cursor, ecursor = F.coalesce("_dc", no), F.coalesce("_ec", no)
    count = F.coalesce("count_written", F.nullif(F.col("_manifest"), zero), "_dw", zero)
    return j.select(
        "type_key", "enrichable", dump_done.alias("dump_done"), enrich_done.alias("enrich_done"),
        count.alias("staged"), F.coalesce("_ds", "_dcs", zero).alias("server_total"),
        F.coalesce("_ee", "_ece", zero).alias("enriched"),
        F.coalesce("_ef", "_ecf", zero).alias("failed"),
        H.type_state(F.col("enrichable"), dump_done, enrich_done, cursor, ecursor, count).alias("state"),
        (cursor | ecursor).alias("resumed"),
    )


def not_terminal(types: DataFrame, markers: DataFrame) -> DataFrame:
    """Types of a run whose last stage has no marker yet; none left means the gate opens."""
    stage = F.when(F.col("enrichable"), "enrich").otherwise("dump")
    return types.withColumn("stage", stage).join(markers.select("run_date", "type_key", "stage"),
                                                 ["run_date", "type_key", "stage"], "left_anti")


def hold_ages(held: DataFrame, now: Column, escalate_hours: float = 24.0) -> DataFrame:
    """Per run with open holds: how many remain, their age in hours, and whether to escalate."""
    grouped = held.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("remaining"), F.max("updated_at").alias("_at")
    )
    hours = H.age_hours(F.col("_at").cast("string"), now)
    return grouped.select(
        "run_date", "remaining", F.bround(hours, 1).alias("age_hours"),
        (hours >= escalate_hours).alias("escalate"),
    )


def delete_preview(groups: DataFrame, per_group: int = 5, total: int = 15) -> DataFrame:
    """Dry run of a run deletion: count per group and a few sample names."""
    from tidemark.operators.ordering import top_per_group

    counts = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    sample = top_per_group(groups, ["group"], [F.col("name")], per_group)
    sample = sample.orderBy("group", "name").limit(total)
    names = sample.groupBy("group").agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("sample"))
    return counts.join(names, "group", "left")
