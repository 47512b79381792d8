"""An incremental refresh: read hits, stage edits, fill bodies, track, find deletions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import KEY, bodies, diff, ingest, zones
from tidemark.plans.tracking import track
from tidemark.session import cut_lineage


@dataclass
class Synced:
    live: DataFrame
    pending: DataFrame
    state: DataFrame
    changes: DataFrame
    summary: DataFrame
    bodies: DataFrame
    deletions: DataFrame | None
    report: DataFrame
    errors: DataFrame


def sync(
    hits: DataFrame, types: DataFrame, live: DataFrame, tracked: DataFrame, pages: DataFrame,
    run_id: Column, run_date: Column, now: Column, full: bool = False,
    json_hosts: tuple[str, ...] = (), js_hosts: tuple[str, ...] = (), kb_host: str = "",
    refetch: bool = False, refetch_errors: bool = False,
) -> Synced:
    """New articles go live, edited ones wait in pending; bodies of live articles that lack one
    are taken from the landed ``pages`` (``url, final_url, html``); the result is tracked. An article
    without a link or a landed page gets an error, so it counts as failed and is not due again.
    ``refetch_errors`` asks for those again, ``refetch`` for all; what comes for an article that had a body
    does not overwrite it but waits in pending, in place of an edit that waits there.

    Deletions are looked for in a full read only, on ids as they are, and are only reported.
    The envelopes feed several outputs, so they are written to the shared folder once.
    """
    spark = hits.sparkSession
    read = cut_lineage(spark, ingest.envelopes(hits, types, now, run_date).drop("seq"), "envelopes")
    marked = diff.classify_incoming(read, diff.hash_index(tracked), live)
    fresh, pending = zones.stage(marked)
    stored = live.unionByName(fresh.select(*live.columns))
    able = stored.join(types.filter("enrichable").select("type_key"), "type_key", "left_semi")
    due = F.coalesce(bodies.due(able, refetch, refetch_errors), F.lit(True))
    work = able.filter(due)
    landed = work.select(*KEY, F.col("link").alias("url")).join(pages, "url", "left")
    results = bodies.with_outcome(bodies.extract_bodies(landed, json_hosts), list(js_hosts), kb_host)
    found = cut_lineage(spark, results, "bodies")
    digest = ["metadata_hash", "content_hash", "has_body", "body_chars"]
    fill = lambda rows, results: ingest.with_digest(bodies.merge_bodies(rows.drop(*digest), results, now))
    again = None
    at_once = found
    if refetch:
        again = cut_lineage(spark, found.select(*KEY).join(stored.filter("has_body = 1").select(*KEY), KEY, "left_semi"), "again")
        at_once = found.join(again, KEY, "left_anti")
        waiting = fill(stored.join(again, KEY, "left_semi"), found.join(again, KEY, "left_semi"))
        pending = zones.drop_keys(pending, again).unionByName(waiting.select(*pending.columns))
    next_live = cut_lineage(spark, fill(stored, at_once).select(*live.columns), "live")
    narrow = next_live.select(
        *KEY, "metadata_hash", "content_hash", "has_body", "body_chars", "body_error", "modified_ms"
    )
    out = track(tracked, narrow, run_id, now)
    gone = diff.gone_upstream(tracked, read.select(*KEY), strip_suffix=False).select(*KEY) if full else None
    return Synced(
        live=next_live, pending=pending, state=out["state"], changes=out["changes"],
        summary=out["summary"], bodies=found, deletions=gone,
        report=bodies.enrich_report(found, able.filter(~due), again), errors=bodies.enrich_errors(found),
    )
