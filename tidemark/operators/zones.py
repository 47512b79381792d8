"""Whole-table changes of the zones live, pending, archive and deleted.

Parquet has no MERGE, so every change is a set expression that yields the next frame.
The operators read only the key and pass all other columns through. At scale call them
on the narrow state table (key, hashes, version), and keep the documents themselves in
the append-only ``versions`` table: then a promotion moves a few hundred bytes per row
and never rewrites a body (see ``tidemark.sources.tables``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import KEY


def stage(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split classified rows: new ones go straight to live, edited ones to pending."""
    body = classified.drop("op", "prior_hash")
    op = classified["op"]
    return body.filter(op == "new"), body.filter(op == "edited")


def displaced(live: DataFrame, incoming: DataFrame, archived_at: Column) -> DataFrame:
    """The live rows an overwrite will replace, stamped for the archive."""
    return live.join(incoming.select(*KEY), KEY, "left_semi").withColumn("archived_at", archived_at)


def upsert(live: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows replace live rows of the same key; the rest stays."""
    kept = live.join(incoming.select(*KEY), KEY, "left_anti")
    return kept.unionByName(incoming.select(*live.columns))


def upsert_in_place(live: DataFrame, incoming: DataFrame) -> DataFrame:
    """The same in one full outer join: each side is shuffled once instead of twice."""
    cols = [c for c in live.columns if c not in KEY]
    l = live.select(*KEY, F.struct(*cols).alias("_old"))
    i = incoming.select(*KEY, F.struct(*cols).alias("_new"))
    return l.join(i, KEY, "full_outer").select(*KEY, F.coalesce("_new", "_old").alias("_row")).select(
        *KEY, "_row.*"
    ).select(*live.columns)


def drop_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys.select(*KEY), KEY, "left_anti")


def promote(live: DataFrame, pending: DataFrame, keys: DataFrame, now: Column) -> dict[str, DataFrame]:
    """Archive what is displaced, replace live, take the rows out of pending.

    Returns the next ``live``, ``pending`` and ``index`` and the rows to append to ``archive``.
    """
    incoming = pending.join(keys.select(*KEY), KEY, "left_semi")
    next_live = upsert_in_place(live, incoming)
    return {
        "archive": displaced(live, incoming, now),
        "live": next_live,
        "pending": drop_keys(pending, keys),
        "index": next_live.select(*KEY, "metadata_hash"),
    }


def restore(live: DataFrame, archive: DataFrame, requests: DataFrame, runs: DataFrame,
            run_date: Column, now: Column) -> dict[str, DataFrame]:
    """Write archived versions back; what they displace is archived first.

    ``requests`` names ``(type_key, id, archived_at)``. While today's run is open
    (its phase is not ``done``) every request is refused.
    """
    state = (
        runs.filter(F.col("run_date") == run_date)
        .agg(F.coalesce(F.bool_or(F.col("phase") != "done"), F.lit(False)))
        .scalar()
    )
    asked = requests.select(*KEY, "archived_at").withColumn("_open", state)
    found = archive.select(*KEY, "archived_at").withColumn("_found", F.lit(True))
    status = (
        F.when(F.col("_open"), "refused").when(F.col("_found").isNull(), "not-found").otherwise("restored")
    )
    result = asked.join(found, [*KEY, "archived_at"], "left").select(
        *KEY, "archived_at", status.alias("status")
    )
    granted = result.filter(F.col("status") == "restored").drop("status")
    incoming = archive.join(granted, [*KEY, "archived_at"], "left_semi").drop("archived_at")
    return {
        "result": result,
        "archive": displaced(live, incoming, now),
        "live": upsert_in_place(live, incoming),
        "audit": granted.select(
            F.lit("restored").alias("op"), *KEY, F.col("archived_at").alias("restored_from"),
            run_date.alias("run_date"), now.alias("ts"),
        ),
    }


def apply_deletions(live: DataFrame, deletions: DataFrame, now: Column, purge: bool = False) -> dict[str, DataFrame]:
    """Take deleted keys out of live; unless purged they move to ``deleted``."""
    gone = live.join(deletions.select(*KEY), KEY, "left_semi")
    out = {
        "live": drop_keys(live, deletions),
        "changelog": gone.select(
            F.lit("deleted").alias("op"), *KEY, F.lit("reconcile").alias("source"),
            F.when(F.lit(purge), "purged")
            .otherwise(F.concat(F.lit("archived to deleted/"), F.col("type_key")))
            .alias("detail"),
            now.alias("ts"),
        ),
    }
    if not purge:
        out["deleted"] = gone.withColumn("deleted_at", now)
    return out


def staged_by_run(manifest: DataFrame, pending: DataFrame, run_date) -> DataFrame:
    """Pending keys that one run staged and that still exist."""
    rows = manifest.filter(F.col("run_date") == run_date).select(*KEY).distinct()
    return pending.select(*KEY).join(rows, KEY, "left_semi")


def delete_run(tables: dict[str, DataFrame], manifest: DataFrame, pending: DataFrame, run_date) -> dict[str, DataFrame]:
    """Drop a run's rows from the run tables and the pending rows it staged.

    Live, archive, audit and the hash index are no part of ``tables`` and stay.
    """
    out = {name: df.filter(~F.col("run_date").eqNullSafe(run_date)) for name, df in tables.items()}
    out["pending"] = drop_keys(pending, staged_by_run(manifest, pending, run_date))
    return out


# Days each zone is kept.
RETENTION_DAYS = {"archive": 365, "pending": 30, "runs": 90, "state": 7}


def retain(df: DataFrame, zone: str, stamp: str, now: Column) -> DataFrame:
    """Rows still within the retention of their zone."""
    return df.filter(F.col(stamp) >= now - F.expr(f"INTERVAL {RETENTION_DAYS[zone]} DAYS"))
