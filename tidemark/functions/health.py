"""Ages, health labels and run states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STALE_SECONDS = 7 * 24 * 3600


def age_seconds(stamp: Column, now: Column, bad: float | None = None) -> Column:
    """Seconds between an ISO stamp and ``now``; an unreadable stamp gives ``bad``."""
    ts = F.try_to_timestamp(stamp)
    age = F.unix_micros(now) / 1e6 - F.unix_micros(ts) / 1e6
    return F.coalesce(age, F.lit(bad).cast("double"))


def age_hours(stamp: Column, now: Column) -> Column:
    """Hours, an unreadable stamp counts as fresh (0)."""
    return age_seconds(stamp, now, 0.0) / 3600.0


def age_text(ms: Column) -> Column:
    """Short age such as ``42s ago`` or ``3.5h ago``."""
    sec = ms / 1000
    minutes, hours = sec / 60, sec / 3600
    whole = lambda c: F.bround(c, 0).cast("bigint").cast("string")
    tenth = lambda c: F.bround(c, 1).cast("decimal(20,1)").cast("string")
    return (
        F.when(ms.isNull(), "?")
        .when(sec < 60, F.concat(whole(sec), F.lit("s ago")))
        .when(minutes < 60, F.concat(whole(minutes), F.lit("m ago")))
        .when(hours < 24, F.concat(tenth(hours), F.lit("h ago")))
        .otherwise(F.concat(tenth(hours / 24), F.lit("d ago")))
    )


def health_label(stale_seconds: Column, any_partial: Column) -> Column:
    return (
        F.when(stale_seconds > STALE_SECONDS, "STALE").when(any_partial, "PARTIAL").otherwise("OK")
    )


def stall_class(
    run_open: Column,
    queue_empty: Column,
    cursor_age_h: Column,
    redrives: Column,
    stall_age_h: float = 1.0,
    max_redrives: int = 3,
) -> Column:
    """What to do with a stuck stage, first rule that applies."""
    return (
        F.when(~run_open, "orphan")
        .when(~queue_empty, "skip_active")
        .when(cursor_age_h.isNotNull() & (cursor_age_h < stall_age_h), "skip_active")
        .when(redrives >= max_redrives, "cap")
        .otherwise("redrive")
    )


def run_mode(run_date: Column, requested: Column | None = None) -> Column:
    """A requested mode wins; otherwise Sunday is full and other days incremental."""
    scheduled = F.when(F.dayofweek(run_date) == 1, "full").otherwise("incremental")
    if requested is None:
        return scheduled
    wanted = F.lower(F.trim(F.coalesce(requested, F.lit(""))))
    return F.when(wanted.isin("incremental", "full"), wanted).otherwise(scheduled)


def run_status(
    full: Column, limited: Column, expected: Column, present: Column, write_errors: Column, failed: Column
) -> Column:
    """``failed``, else ``partial`` on write errors or a short full read, else ``ok``."""
    short = full & ~limited & expected.isNotNull() & (present < expected)
    return F.when(failed, "failed").when((write_errors > 0) | short, "partial").otherwise("ok")


def type_state(
    enrichable: Column, dump_done: Column, enrich_done: Column, dump_cursor: Column,
    enrich_cursor: Column, staged: Column,
) -> Column:
    """Where one type of a run stands."""
    terminal = F.when(enrichable, enrich_done).otherwise(dump_done)
    return (
        F.when(terminal, "done")
        .when(enrichable & dump_done, F.when(enrich_cursor, "enriching (resumed)").otherwise("enriching"))
        .when(~dump_done & dump_cursor, "dumping (resumed)")
        .when(~dump_done & (staged > 0), "dumping")
        .when(~dump_done, "queued")
        .otherwise("…")
    )


def run_phase(
    status_phase: Column, approve_done: Column, track_done: Column, scrape_done: Column, any_dump_done: Column
) -> Column:
    """The recorded phase, else the furthest marker reached."""
    derived = (
        F.when(approve_done, "done")
        .when(track_done, "approve")
        .when(scrape_done, "track")
        .when(any_dump_done, "scrape")
        .otherwise("unknown")
    )
    return F.coalesce(F.nullif(status_phase, F.lit("")), derived)
