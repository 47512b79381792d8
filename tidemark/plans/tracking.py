"""Track a snapshot, reconcile deletions, feed consumers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import KEY, diff, zones
from tidemark.operators.ordering import latest_by_key


def track(tracked: DataFrame, current: DataFrame, run_id: Column, ran_at: Column) -> dict[str, DataFrame]:
    """The next tracked state, the run's change rows, counts per type and the run row."""
    delta = diff.snapshot_diff(tracked, current, run_id)
    summary = diff.track_summary(delta)
    run = diff.run_totals(summary).select(run_id.alias("run_id"), ran_at.alias("ran_at"), "*")
    return {
        "state": delta.drop("change_type", "reasons"),
        "changes": diff.change_rows(delta, run_id),
        "summary": summary,
        "run": run,
    }


def reconcile(tracked: DataFrame, live: DataFrame, upstream: DataFrame, now: Column,
              max_pct: float = 0.25, max_deletes: int | None = None, purge: bool = False) -> dict[str, DataFrame]:
    """Deletions, the guard's verdict, and the tables after the deletions it lets through.

    The verdict is a value inside the plan: when it is to abort, no key passes and every
    table comes out unchanged.
    """
    gone = diff.gone_upstream(tracked, upstream).select(*KEY)
    guard = diff.delete_guard(tracked, gone, max_pct, max_deletes)
    aborted = guard.agg(F.coalesce(F.bool_or("aborted"), F.lit(False))).scalar()
    granted = gone.filter(~aborted)
    out = zones.apply_deletions(live, granted, now, purge)
    out["tracked"] = zones.drop_keys(tracked, granted)
    out["deletions"] = gone
    out["guard"] = guard
    return out


def fresh_for(store: DataFrame, manifest: DataFrame, live: DataFrame) -> DataFrame:
    """Live rows that a manifest lists and whose content the store does not have."""
    keys = manifest.select(*KEY).distinct()
    listed = live.join(keys, KEY, "left_semi")
    return listed.join(store.select(*KEY, "content_hash"), [*KEY, "content_hash"], "left_anti")


def consume(store: DataFrame, manifest: DataFrame, live: DataFrame) -> DataFrame:
    """A consumer's next store after a batch: listed rows are upserted, equal content is skipped.

    The manifest may list a key several times and arrive twice; the result is the same.
    """
    return zones.upsert_in_place(store, fresh_for(store, manifest, live).select(*store.columns))


def backfill(store: DataFrame, manifests: DataFrame, live: DataFrame, run_date) -> DataFrame:
    """Replay one past run to a consumer."""
    return consume(store, manifests.filter(F.col("run_date") == run_date), live)


def merge_pending(entries: DataFrame, order: Column) -> DataFrame:
    """The pending manifest after several stages: the last entry per key, ordered by key."""
    return latest_by_key(entries, KEY, order).orderBy(*KEY)
