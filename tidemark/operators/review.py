"""Change records with risk, the approval gate and decisions on held rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import risk as R
from tidemark.functions.text import body_excerpt
from tidemark.operators import KEY
from tidemark.operators.ordering import latest_by_key

DIGEST = ["metadata_hash", "content_hash", "has_body", "body_chars", "body_error"]


def _side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*KEY, *[F.col(c).alias(prefix + c) for c in DIGEST], F.lit(True).alias(prefix + "here"))


def with_risk(pending: DataFrame, live: DataFrame) -> DataFrame:
    """Pending rows with ``risk``, ``changed``, ``live_chars`` and ``pending_chars``."""
    j = pending.join(_side(live, "_l_"), KEY, "left")
    here = F.coalesce("_l_here", F.lit(False))
    return j.select(
        *pending.columns,
        R.risk_flags(
            here, F.col("_l_has_body"), F.col("_l_body_chars"),
            F.col("has_body"), F.col("body_chars"), F.col("body_error"),
        ).alias("risk"),
        R.diff_parts(
            here, F.col("_l_metadata_hash"), F.col("metadata_hash"),
            F.col("_l_content_hash"), F.col("content_hash"),
        ).alias("changed"),
        F.coalesce("_l_body_chars", F.lit(0)).alias("live_chars"),
        F.col("body_chars").alias("pending_chars"),
        here.alias("has_live"),
    )


def change_records(manifest: DataFrame, pending: DataFrame, live: DataFrame, index: DataFrame) -> DataFrame:
    """One record per manifest row that still has a pending row.

    ``op`` looks at the metadata hash against the index only: a change of the body
    alone is ``unchanged`` with ``changed = [content]``.
    """
    idx = index.select(*KEY, F.col("metadata_hash").alias("_prior"))
    staged = manifest.select(*KEY, "run_date").join(pending.select(*KEY, *DIGEST), KEY)
    rated = with_risk(staged, live).join(idx, KEY, "left")
    op = (
        F.when(F.col("_prior").isNull(), "new")
        .when(F.col("_prior") != F.col("metadata_hash"), "changed")
        .otherwise("unchanged")
    )
    return rated.select(
        *KEY, F.col("type_key").alias("document_type"), op.alias("op"), "risk", "changed",
        "live_chars", "pending_chars", "run_date", "metadata_hash",
    )


def risk_breakdown(records: DataFrame, by: list[str]) -> DataFrame:
    op = lambda name: F.count_if(F.col("op") == name)
    flag = lambda name: F.count_if(R.has_flag(F.col("risk"), name))
    return records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        op("new").alias("new"), op("changed").alias("changed"), op("unchanged").alias("unchanged"),
        flag("body-shrank").alias("body_shrank"),
        flag("body-dropped").alias("body_dropped"),
        flag("body-error").alias("body_error"),
    )


def gate(
    rated: DataFrame, hold_flags=R.HOLD_FLAGS, include_risky: bool = False,
    reject: bool = False, dry_run: bool = False,
) -> DataFrame:
    """Add ``action``: preview, rejected, held-risky or promoted.

    ``hold_flags`` names the flags that hold a row; ``None`` means that any flag does.
    """
    if include_risky:
        held = F.lit(False)
    elif hold_flags is None:
        held = F.size("risk") > 0
    else:
        held = R.is_held(F.col("risk"), hold_flags)
    if dry_run:
        action = F.lit("preview")
    elif reject:
        action = F.lit("rejected")
    else:
        action = F.when(held, "held-risky").otherwise("promoted")
    return rated.withColumn("action", action)


def review_manifest(manifest: DataFrame, pending: DataFrame, live: DataFrame, **gate_options) -> DataFrame:
    """The gate over manifest rows; rows whose pending copy is gone get ``missing-pending``."""
    rated = gate(with_risk(pending.select(*KEY, *DIGEST), live), **gate_options)
    j = manifest.join(rated.select(*KEY, "risk", "changed", "action"), KEY, "left")
    empty = F.array().cast("array<string>")
    # Parts found by the diff replace the parts the stage recorded.
    own = F.col("changed")
    recorded = F.col("staged_changed") if "staged_changed" in manifest.columns else empty
    return j.select(
        *manifest.columns,
        F.coalesce("risk", empty).alias("risk"),
        F.when(F.size(F.coalesce(own, empty)) > 0, own).otherwise(recorded).alias("changed"),
        F.coalesce("action", F.lit("missing-pending")).alias("action"),
    )


def risk_index(records: DataFrame, order: Column) -> DataFrame:
    """Last record per key, as later lines of the change file replace earlier ones."""
    return latest_by_key(records, KEY, order)


def attach_risk(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """Manifest rows with the run's risk record, defaults where there is none."""
    j = manifest.drop("risk", "changed", "op").join(index.select(*KEY, "risk", "changed", "op"), KEY, "left")
    empty = F.array().cast("array<string>")
    return (
        j.withColumn("risk", F.coalesce("risk", empty))
        .withColumn("changed", F.coalesce("changed", empty))
        .withColumn("op", F.coalesce("op", F.lit("changed")))
    )


def not_yet_approved(manifest: DataFrame, approved: DataFrame) -> DataFrame:
    """A resumed run leaves out what it already promoted."""
    return manifest.join(approved.select(*KEY), KEY, "left_anti")


def held_entries(held: DataFrame, pending: DataFrame, live: DataFrame) -> DataFrame:
    """Held rows with both lengths, the error and the first 200 characters of the live body.

    ``pending`` and ``live`` carry ``body_text``; held rows are the small side, and the
    join takes their keys to the bodies.
    """
    p = pending.select(
        *KEY, F.length(F.coalesce("body_text", F.lit(""))).alias("pending_chars"),
        F.coalesce("body_error", F.lit("")).alias("error_msg"),
    )
    # Cut the body before the join, so only lengths and excerpts are moved.
    l = live.select(
        *KEY, F.length(F.coalesce("body_text", F.lit(""))).alias("live_chars"),
        body_excerpt(F.col("body_text")).alias("live_excerpt"),
    )
    return (
        held.select(*KEY, "risk", "changed", "op").join(p, KEY).join(l, KEY, "left")
        .withColumn("live_chars", F.coalesce("live_chars", F.lit(0)))
        .withColumn("live_excerpt", F.coalesce("live_excerpt", F.lit("")))
    )


def resolve(held: DataFrame, decisions: DataFrame) -> DataFrame:
    """Held rows with ``decision``: approved, rejected or held.

    ``decisions`` has ``action`` and ``actor`` with a key for one row, and null keys for
    a decision on all rows of the run: approve_all, reject_all, auto_escalate. An
    escalation rejects.
    """
    single = decisions.filter(F.col("id").isNotNull()).select(
        *KEY, F.col("action").alias("_one"), F.col("actor").alias("_actor")
    )
    whole = decisions.filter(F.col("id").isNull()).agg(
        F.struct(
            F.coalesce(F.bool_or(F.col("action") == "approve_all"), F.lit(False)).alias("yes"),
            F.coalesce(
                F.bool_or(F.col("action").isin("reject_all", "auto_escalate")), F.lit(False)
            ).alias("no"),
            F.max("actor").alias("actor"),
        ).alias("whole")
    )
    j = held.join(single, KEY, "left").withColumn("_all", whole.scalar())
    decision = (
        F.when(F.col("_one") == "approve", "approved")
        .when(F.col("_one") == "reject", "rejected")
        .when(F.col("_all.yes"), "approved")
        .when(F.col("_all.no"), "rejected")
        .otherwise("held")
    )
    return j.select(
        *held.columns, decision.alias("decision"),
        F.when(decision != "held", F.coalesce("_actor", "_all.actor", F.lit("unknown"))).alias("actor"),
    )


def approved_records(promoted: DataFrame, actor: Column, run_date: Column) -> DataFrame:
    """Changed-ids rows of a promotion, with the fields consumers rely on."""
    return promoted.select(
        "op", "id", "type_key", F.col("type_key").alias("type"),
        F.col("type_key").alias("document_type"), run_date.alias("run_date"),
        actor.alias("approved_by"), F.col("metadata_hash").alias("hash"),
        "changed",
    )
