"""Risk flags of an overwrite, the gate on them, and error classes.

All inputs are narrow columns (flags, lengths, hashes) that ingest already wrote, so
no body text travels through a join to be judged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flags that stop an automatic overwrite.
HOLD_FLAGS = ("body-dropped", "body-error")

# Error classes and the substrings that select them, first match wins.
ERROR_CLASSES = [
    ("not-found", ["404", "not found"]),
    ("forbidden", ["403", "forbidden", "401", "unauthor"]),
    ("timeout", ["timeout", "timed out"]),
    ("rate-limited", ["429", "rate"]),
    ("server-error", ["server error"]),
    ("parse/empty", ["parse", "no body", "empty", "extract"]),
    ("network", ["network", "fetch", "connection"]),
]
SERVER_STATUS = r"\b5\d\d\b"


def risk_flags(
    has_live: Column,
    live_has_body: Column,
    live_chars: Column,
    pending_has_body: Column,
    pending_chars: Column,
    pending_error: Column,
) -> Column:
    """Flags in order: ``body-error``, then ``body-dropped`` or ``body-shrank-N%``."""
    had = has_live & (live_has_body == 1)
    shrunk = had & (pending_has_body == 1) & (live_chars > 0) & (pending_chars < live_chars * 0.5)
    percent = F.bround((F.lit(1.0) - pending_chars / live_chars) * 100, 0).cast("int")
    error = F.when(has_live & (F.coalesce(pending_error, F.lit("")) != ""), F.lit("body-error"))
    body = F.when(had & (pending_has_body == 0), F.lit("body-dropped")).when(
        shrunk, F.concat(F.lit("body-shrank-"), percent.cast("string"), F.lit("%"))
    )
    return F.array_compact(F.array(error, body))


def diff_parts(
    has_live: Column, live_meta: Column, meta: Column, live_content: Column, content: Column
) -> Column:
    """Which of ``metadata`` and ``content`` differ from live; empty without a live row."""
    return F.array_compact(
        F.array(
            F.when(has_live & ~live_meta.eqNullSafe(meta), F.lit("metadata")),
            F.when(has_live & ~live_content.eqNullSafe(content), F.lit("content")),
        )
    )


def change_kind(parts: Column) -> Column:
    meta = F.array_contains(parts, "metadata")
    body = F.array_contains(parts, "content")
    return (
        F.when(meta & body, "metadata+content")
        .when(meta, "metadata-only")
        .when(body, "content-only")
        .otherwise("no-op")
    )


def has_flag(risk: Column, flag: str) -> Column:
    """A flag by name, or by name with a magnitude behind it (``body-shrank-42%``)."""
    return F.exists(risk, lambda x: (x == flag) | x.startswith(flag + "-"))


def is_held(risk: Column, hold_flags=HOLD_FLAGS) -> Column:
    return F.arrays_overlap(risk, F.array(*[F.lit(f) for f in hold_flags]))


def classify_error(message: Column) -> Column:
    """Ordered substring rules over a lower-cased message."""
    m = F.lower(message)
    out = None
    for name, needles in ERROR_CLASSES:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | m.contains(needle)
        if name == "server-error":
            hit = hit | m.rlike(SERVER_STATUS)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def body_change_op(error: Column, had_body: Column) -> Column:
    return (
        F.when(F.coalesce(error, F.lit("")) != "", "body-error")
        .when(had_body, "body-changed")
        .otherwise("body-added")
    )
