"""The daily run: read, classify, extract bodies, rate, gate, promote, audit.

Each step returns frames; the caller writes them to the tables of ``tidemark.sources``.
The order of the steps is the order of their data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import KEY, diff, review, zones
from tidemark.operators.ingest import with_digest


@dataclass
class Staged:
    manifest: DataFrame
    pending: DataFrame


def stage_run(incoming: DataFrame, index: DataFrame, run_date: Column) -> Staged:
    """New and changed rows go to pending with a manifest row each; unchanged rows are skipped."""
    moved = diff.changed_only(diff.classify_incoming(incoming, index))
    manifest = moved.select(
        "op", "id", "type_key", run_date.alias("run_date"), F.lit(None).cast("string").alias("approved_by")
    )
    return Staged(manifest=manifest, pending=moved.drop("op", "prior_hash"))


@dataclass
class Approved:
    records: DataFrame
    held: DataFrame
    approved: DataFrame
    live: DataFrame
    pending: DataFrame
    archive: DataFrame
    index: DataFrame


def approve_run(staged: Staged, live: DataFrame, index: DataFrame, run_date: Column, now: Column,
                already: DataFrame | None = None, hold_flags=review.R.HOLD_FLAGS) -> Approved:
    """Rate the staged rows, promote the safe ones and hold the rest.

    ``already`` are keys an interrupted attempt promoted; they are left out.
    """
    manifest = staged.manifest if already is None else review.not_yet_approved(staged.manifest, already)
    records = review.change_records(manifest, staged.pending, live, index)
    gated = review.gate(records, hold_flags)
    safe = gated.filter(F.col("action") == "promoted")
    out = zones.promote(live, staged.pending, safe, now)
    return Approved(
        records=records,
        held=gated.filter(F.col("action") == "held-risky"),
        approved=review.approved_records(safe, F.lit("auto"), run_date),
        live=out["live"], pending=out["pending"], archive=out["archive"], index=out["index"],
    )


def settle_holds(held: DataFrame, decisions: DataFrame, live: DataFrame, pending: DataFrame,
                 run_date: Column, now: Column) -> dict[str, DataFrame]:
    """Apply decisions to held rows: approved ones are promoted, rejected ones dropped."""
    decided = review.resolve(held, decisions)
    yes = decided.filter(F.col("decision") == "approved")
    no = decided.filter(F.col("decision") == "rejected")
    out = zones.promote(live, pending, yes, now)
    out["pending"] = zones.drop_keys(out["pending"], no)
    out["approved"] = review.approved_records(yes, F.col("actor"), run_date)
    out["rejected"] = no.select(F.lit("rejected").alias("op"), *KEY, "actor", now.alias("ts"))
    out["remaining"] = decided.filter(F.col("decision") == "held").drop("decision", "actor")
    return out


def edit_articles(live: DataFrame, edits: DataFrame, actor: Column, run_date: Column, now: Column) -> dict[str, DataFrame]:
    """Hand-made edits: hash them anew, archive what they displace, and record them as ``edited``.

    ``edits`` has the columns of ``live``; its hashes and lengths are computed here from
    ``metadata`` and ``content``.
    """
    fresh = with_digest(edits.drop("metadata_hash", "content_hash", "has_body", "body_chars", "body_error"))
    out = zones.promote(live, fresh.select(*live.columns), fresh, now)
    tagged = fresh.withColumn("op", F.lit("edited")).withColumn("changed", F.array().cast("array<string>"))
    out["approved"] = review.approved_records(tagged, actor, run_date)
    return out
