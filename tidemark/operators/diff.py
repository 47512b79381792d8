"""Snapshot diff, classification against the hash index, and deletion detection.

All joins are equi-joins on the article key over narrow rows. The key is unique per
side, so a type that holds a third of the corpus still spreads over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import base_id
from tidemark.operators import KEY

# Name of each change reason and the tracked column behind it, in report order.
DIFF_COLUMNS = [
    ("metadata", "metadata_hash"),
    ("content", "content_hash"),
    ("updated_published", "updated_published_ms"),
    ("modified", "modified_ms"),
    ("body_error", "body_error"),
]


def hash_index(live: DataFrame) -> DataFrame:
    """The skip-unchanged index: key and metadata hash."""
    return live.select(*KEY, "metadata_hash")


def classify_incoming(incoming: DataFrame, index: DataFrame, live: DataFrame | None = None) -> DataFrame:
    """Add ``prior_hash`` and ``op`` (new, edited, unchanged).

    With ``live`` given (a gated run), a key missing from the index falls back to the
    hash of the live row.
    """
    idx = index.select(*KEY, F.col("metadata_hash").alias("_idx"))
    out = incoming.join(idx, KEY, "left")
    prior = F.col("_idx")
    if live is not None:
        out = out.join(live.select(*KEY, F.col("metadata_hash").alias("_live")), KEY, "left")
        prior = F.coalesce("_idx", "_live")
    out = out.withColumn("prior_hash", prior)
    op = (
        F.when(F.col("prior_hash").isNull(), "new")
        .when(F.col("prior_hash") == F.col("metadata_hash"), "unchanged")
        .otherwise("edited")
    )
    return out.withColumn("op", op).drop("_idx", "_live")


def changed_only(classified: DataFrame) -> DataFrame:
    """What a run stages: unchanged rows skipped, ``edited`` called ``changed``."""
    return classified.filter(F.col("op") != "unchanged").withColumn(
        "op", F.when(F.col("op") == "edited", "changed").otherwise(F.col("op"))
    )


def change_reasons(columns: list[tuple[str, Column, Column]]) -> Column:
    """Names of the columns whose two values differ; nulls compare equal."""
    return F.array_compact(
        F.array(*[F.when(~a.eqNullSafe(b), F.lit(name)) for name, a, b in columns])
    )


def snapshot_diff(tracked: DataFrame, current: DataFrame, run_id: Column) -> DataFrame:
    """Compare the current snapshot with the tracked state.

    One row per key of either side: ``change_type`` (new, changed, unchanged, removed),
    ``reasons``, and the run stamps carried over from the tracked side. The tracked side
    has ``first_seen_run``, ``last_seen_run``, ``last_changed_run`` and
    ``first_removed_run``; a removed row keeps its last values and stays in the result
    until a reconcile takes it out.
    """
    shared = [c for _, c in DIFF_COLUMNS if c in current.columns and c in tracked.columns]
    payload = [c for c in current.columns if c not in KEY]
    stamps = ["first_seen_run", "last_seen_run", "last_changed_run", "first_removed_run"]
    carried = [c for c in payload if c in tracked.columns]
    t = tracked.select(
        *KEY, F.lit(True).alias("_tracked"),
        *[F.col(c).alias(f"_t_{c}") for c in carried],
        *[
            (F.col(c) if c in tracked.columns else F.lit(None).cast("string")).alias(f"_t_{c}")
            for c in stamps
        ],
    )
    c = current.withColumn("_current", F.lit(True))
    j = c.join(t, KEY, "full_outer")
    is_new = F.col("_tracked").isNull()
    gone = F.col("_current").isNull()
    clean = lambda col, side: (
        F.nullif(F.col(side + col), F.lit("")) if col == "body_error" else F.col(side + col)
    )
    reasons = change_reasons(
        [(name, clean(col, "_t_"), clean(col, "")) for name, col in DIFF_COLUMNS if col in shared]
    )
    j = j.withColumn(
        "reasons", F.when(~is_new & ~gone, reasons).otherwise(F.array().cast("array<string>"))
    )
    kind = (
        F.when(is_new, "new")
        .when(gone, "removed")
        .when(F.size("reasons") > 0, "changed")
        .otherwise("unchanged")
    )
    keep = [
        (F.when(gone, F.col(f"_t_{c}")).otherwise(F.col(c)) if c in carried else F.col(c)).alias(c)
        for c in payload
    ]
    return j.withColumn("change_type", kind).select(
        *KEY, *keep, "change_type", "reasons",
        F.coalesce("_t_first_seen_run", run_id).alias("first_seen_run"),
        F.when(gone, F.col("_t_last_seen_run")).otherwise(run_id).alias("last_seen_run"),
        F.when(F.col("change_type").isin("new", "changed"), run_id)
        .otherwise(F.coalesce("_t_last_changed_run", run_id))
        .alias("last_changed_run"),
        F.when(gone, F.coalesce("_t_first_removed_run", run_id)).alias("first_removed_run"),
    )


def change_rows(diff: DataFrame, run_id: Column) -> DataFrame:
    """The ``changes`` table rows of a run: one per key that is not unchanged."""
    return diff.filter(F.col("change_type") != "unchanged").select(
        run_id.alias("run_id"), *KEY, "change_type", F.array_join("reasons", ",").alias("detail")
    )


def track_summary(diff: DataFrame) -> DataFrame:
    """Counts per type. Totals of a run are the sums over these rows."""
    n = lambda *kinds: F.count_if(F.col("change_type").isin(*kinds))
    return diff.groupBy("type_key").agg(
        n("new", "changed", "unchanged").alias("scanned"),
        n("new").alias("new"),
        n("changed").alias("changed"),
        n("unchanged").alias("unchanged"),
        n("removed").alias("removed"),
    )


def run_totals(summary: DataFrame) -> DataFrame:
    cols = ["scanned", "new", "changed", "unchanged", "removed"]
    return summary.agg(F.count(F.lit(1)).alias("types"), *[F.sum(c).alias(c) for c in cols])


def gone_upstream(tracked: DataFrame, upstream_ids: DataFrame, strip_suffix: bool = True) -> DataFrame:
    """Tracked rows whose id is not upstream any more.

    A reconcile strips the collision suffix first (the upstream never has it); the
    detection inside a full sync compares ids as they are.
    """
    key = base_id(F.col("id")) if strip_suffix else F.col("id")
    up = upstream_ids.select("type_key", F.col("id").alias("_base")).distinct()
    return tracked.withColumn("_base", key).join(up, ["type_key", "_base"], "left_anti").drop("_base")


def delete_guard(
    tracked: DataFrame, deletions: DataFrame, max_pct: float = 0.25, max_deletes: int | None = None
) -> DataFrame:
    """Per type: counts, share, and ``aborted``, which is the same for all rows.

    One type over its share, or the total over the maximum, stops every type.
    """
    counts = (
        tracked.groupBy("type_key").agg(F.count(F.lit(1)).alias("db_count"))
        .join(deletions.groupBy("type_key").agg(F.count(F.lit(1)).alias("deletions")), "type_key", "left")
        .withColumn("deletions", F.coalesce("deletions", F.lit(0)))
        .withColumn("over_pct", F.col("deletions") / F.col("db_count") > max_pct)
    )
    over_total = F.lit(False)
    if max_deletes is not None:
        over_total = F.col("_total") > max_deletes
    verdict = counts.agg(
        F.bool_or("over_pct").alias("_any"), F.sum("deletions").alias("_total")
    ).select((F.col("_any") | over_total).alias("aborted"))
    # One value for the whole run, as a scalar subquery.
    return counts.withColumn("aborted", verdict.scalar())


def two_sided_gap(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys on one side only, with ``side`` = ``left`` or ``right``."""
    l = left.select(*key).distinct().withColumn("_l", F.lit(1))
    r = right.select(*key).distinct().withColumn("_r", F.lit(1))
    j = l.join(r, key, "full_outer").filter(F.col("_l").isNull() | F.col("_r").isNull())
    return j.select(*key, F.when(F.col("_r").isNull(), "left").otherwise("right").alias("side"))
