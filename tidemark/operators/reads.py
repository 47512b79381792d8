"""Read queries over the zones and run tables: drill-downs, searches, one article's story."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import canon
from tidemark.functions import risk as R
from tidemark.operators import KEY
from tidemark.operators.ordering import newest
from tidemark.session import cut_lineage


def run_changes(rows: DataFrame, run_date, type_key: str | None = None, op: str | None = None,
                risk: str | None = None) -> DataFrame:
    """Rows of one run by type, op and risk (a name also matches its magnitudes).

    ``run_date`` is a partition column, so only that run is read. There is no scan cap:
    every row that matches is in the result.
    """
    out = rows.filter(F.col("run_date") == run_date)
    if type_key:
        out = out.filter(F.col("type_key") == type_key)
    if op:
        out = out.filter(F.col("op") == op)
    if risk:
        out = out.filter(R.has_flag(F.coalesce("risk", F.array().cast("array<string>")), risk))
    return out


CHANGE_KINDS = ("staged", "track", "auto", "holds")


def changes_of_kind(tables: dict[str, DataFrame], kind: str, run_date, type_key: str | None = None, op: str | None = None,
                    risk: str | None = None) -> DataFrame:
    """A run's drill-down: what was staged, rated (track), approved at once (auto) or approved from the holds.

    ``tables`` has a table per kind, each partitioned by run. Staged rows are shown one type at a time. Columns that a kind does not have
    come as nulls, its lists as empty ones.
    """
    if kind not in CHANGE_KINDS:
        raise ValueError(f"kind of change: {kind!r}, not one of {', '.join(CHANGE_KINDS)}")
    if kind == "staged" and not type_key:
        raise ValueError("staged changes are listed by type")
    rows, none = tables[kind], F.lit(None).cast("string")
    listed = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>")) if c in rows.columns else F.array().cast("array<string>")
    shaped = rows.select(
        "run_date", "id", "type_key", "op", listed("changed").alias("changed"), listed("risk").alias("risk"),
        *[(F.col(c) if c in rows.columns else none).alias(c) for c in ("document_type", "approved_by")])
    return run_changes(shaped, run_date, type_key, op, risk).drop("run_date")


def search_ids(df: DataFrame, query: str, col: str = "id") -> DataFrame:
    """Case-insensitive substring of the id."""
    return df.filter(F.lower(F.col(col)).contains(query.lower())) if query else df


def search_rows(df: DataFrame, query: str) -> DataFrame:
    """Case-insensitive substring of the whole row as JSON."""
    return df.filter(F.lower(F.to_json(F.struct("*"))).contains(query.lower())) if query else df


def search_bodies(df: DataFrame, term: str, body: str = "body_text") -> DataFrame:
    return df.filter(F.lower(F.col(body)).contains(term.lower()))


def with_pending_flag(rows: DataFrame, pending: DataFrame) -> DataFrame:
    p = pending.select(*KEY).distinct().withColumn("has_pending", F.lit(True))
    return rows.join(p, KEY, "left").withColumn("has_pending", F.coalesce("has_pending", F.lit(False)))


def locate(live: DataFrame, pending: DataFrame) -> DataFrame:
    """Where each key is found; live is preferred to pending."""
    both = live.select(*KEY, F.lit(0).alias("_p"), F.lit("live").alias("where")).unionByName(
        pending.select(*KEY, F.lit(1).alias("_p"), F.lit("pending").alias("where"))
    )
    return both.groupBy(*KEY).agg(F.min_by("where", "_p").alias("where"))


def corpus_counts(live: DataFrame, types: DataFrame) -> DataFrame:
    """Live rows per type; configured types first in their order, others after by name."""
    counts = live.groupBy("type_key").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(types.select("type_key", "ordinal"), "type_key", "left").orderBy(
        F.col("ordinal").asc_nulls_last(), "type_key"
    )


def index_parity(live: DataFrame, index: DataFrame) -> DataFrame:
    """Types whose count by the hash index and by the live rows differ."""
    a = live.groupBy("type_key").agg(F.count(F.lit(1)).alias("live_n"))
    b = index.groupBy("type_key").agg(F.count(F.lit(1)).alias("index_n"))
    j = a.join(b, "type_key", "full_outer").select(
        "type_key", F.coalesce("live_n", F.lit(0)).alias("live_n"),
        F.coalesce("index_n", F.lit(0)).alias("index_n"),
    )
    return j.filter(F.col("live_n") != F.col("index_n"))


def dossier(type_key: str, art_id: str, live: DataFrame, pending: DataFrame, archive: DataFrame,
            audit: DataFrame, months: list[str], limit: int = 50) -> DataFrame:
    """Everything about one article: its live and pending rows, versions and latest history."""
    mine = (F.col("type_key") == type_key) & (F.col("id") == art_id)
    shape = lambda df, kind, at, what: df.filter(mine).select(
        F.lit(kind).alias("kind"), *KEY, at.cast("timestamp").alias("at"), what.cast("string").alias("what")
    )
    none = F.lit(None)
    history = newest(audit.filter(mine & F.col("month").isin(months)), [F.desc("ts")], limit)
    return (
        shape(live, "live", none, F.col("content_hash"))
        .unionByName(shape(pending, "pending", none, F.col("content_hash")))
        .unionByName(shape(archive, "archive", F.col("archived_at"), F.col("content_hash")))
        .unionByName(shape(history, "history", F.col("ts"), F.col("op")))
    )


def differing(old: DataFrame, new: DataFrame, digest: str, how: str = "full_outer") -> DataFrame:
    """Keys whose ``digest`` differs between two snapshots, as a table, so that joins with it know its size.

    With ``full_outer``, keys of one side only are among them.
    """
    o, n = old.select(*KEY, F.col(digest).alias("_o")), new.select(*KEY, F.col(digest).alias("_n"))
    keys = o.join(n, KEY, how).filter(~F.col("_o").eqNullSafe(F.col("_n"))).select(*KEY)
    return cut_lineage(old.sparkSession, keys, "differing")


def metadata_diff(old: DataFrame, new: DataFrame, meta: Column | None = None) -> DataFrame:
    """One row per key and field whose values differ, both sides as whole JSON values.

    If both sides have ``metadata_hash``, the keys whose hashes differ are found first and only their
    metadata are read further. Both sides are joined once on the article key; the field union is then
    local to a row, so fields are never shuffled.
    """
    if "metadata_hash" in old.columns and "metadata_hash" in new.columns:
        changed = differing(old, new, "metadata_hash", "inner")
        old, new = old.join(changed, KEY, "left_semi"), new.join(changed, KEY, "left_semi")
    meta = F.col("metadata") if meta is None else meta
    o = old.select(*KEY, canon.as_map(meta).alias("_o"))
    n = new.select(*KEY, canon.as_map(meta).alias("_n"))
    j = o.join(n, KEY)
    fields = F.array_union(F.map_keys("_o"), F.map_keys("_n"))
    rows = j.select(*KEY, "_o", "_n", F.explode(fields).alias("field"))
    # A key that is absent and one that holds null compare equal.
    side = lambda m: F.coalesce(F.to_json(F.element_at(F.col(m), F.col("field"))), F.lit("null"))
    return (
        rows.select(*KEY, "field", side("_o").alias("_a"), side("_n").alias("_b"))
        .filter(F.col("_a") != F.col("_b"))
        .select(*KEY, "field", F.col("_a").alias("old"), F.col("_b").alias("new"))
    )


def overview(live: DataFrame, pending: DataFrame, runs: DataFrame, held: DataFrame) -> DataFrame:
    """One row: corpus size, pending size, latest run and held rows."""
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return runs.agg(F.max("run_date").alias("latest_run")).select(
        n(live).alias("corpus"), n(pending).alias("pending"), "latest_run", n(held).alias("held")
    )


def changes_since(changes: DataFrame, runs: DataFrame, since: Column) -> DataFrame:
    """What changed in the runs after a moment, by kind."""
    later = runs.filter(F.col("ran_at") > since).select("run_id")
    return changes.join(later, "run_id", "left_semi").groupBy("change_type").agg(
        F.count(F.lit(1)).alias("n")
    )


def trail(df: DataFrame, month: str, *, limit: int, order: str = "ts", tie: str = "id") -> DataFrame:
    """The ``limit`` newest rows of one month of a trail; ``month`` is its partition."""
    return newest(df.filter(F.col("month") == month), [F.desc(order), F.desc(tie)], limit)
