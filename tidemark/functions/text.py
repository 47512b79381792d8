"""Names, dates and cell escapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as a Unicode-aware strip sees it: (?U)\s plus the four separators it misses.
_WS = r"[\s\x1c-\x1f]"
# The same characters one by one, for trimming without a regular expression.
_WS_CHARS = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# A sample is cut from this many characters when they suffice.


def or_missing(*cols: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def or_zero(*cols: Column) -> Column:
    """First number that is neither null nor zero."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in cols])


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of every kind, not only blanks."""
    return F.btrim(c, F.lit(_WS_CHARS))


def squeeze(c: Column) -> Column:
    """Collapse whitespace runs to one blank and strip."""
    return strip(F.regexp_replace(c, rf"(?U){_WS}+", " "))


def is_blank(c: Column) -> Column:
    """True when a text holds nothing but whitespace; the search ends at the first other character."""
    return ~c.rlike(r"(?U)[^\s\x1c-\x1f]")


def sanitize_name(c: Column) -> Column:
    """A file-safe name: other characters become ``_``, runs collapse, ends are trimmed."""
    safe = F.regexp_replace(c, r"[^A-Za-z0-9_-]", "_")
    return F.regexp_replace(F.regexp_replace(safe, r"_+", "_"), r"^_+|_+$", "")


def stable_id(*candidates: Column) -> Column:
    """Sanitised first non-empty candidate, at most 120 characters."""
    return F.substring(sanitize_name(F.coalesce(or_missing(*candidates), F.lit("article"))), 1, 120)


def base_id(c: Column) -> Column:
    """Drop the ``__<n>`` that a collision added."""
    return F.regexp_replace(c, r"__\d+$", "")


def sample_of(c: Column) -> Column:
    """One-line sample of the whole text, 200 characters and an ellipsis when cut; empty for a null."""
    flat = squeeze(F.coalesce(c, F.lit("")))
    return F.when(F.length(flat) > 200, F.concat(F.substring(flat, 1, 200), F.lit("…"))).otherwise(flat)


def filter_date(ms: Column) -> Column:
    """Epoch milliseconds as ``YYYY/MM/DD@HH:MM:SS`` in UTC."""
    return F.date_format(F.timestamp_millis(ms), "yyyy/MM/dd'@'HH:mm:ss")


def display_date(ms: Column) -> Column:
    """Epoch milliseconds as ``Jan 5, 2026``; null and zero give the empty string."""
    return F.when(F.coalesce(ms, F.lit(0)) == 0, "").otherwise(
        F.date_format(F.timestamp_millis(ms), "MMM d, yyyy")
    )


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def file_stamp(ts: Column) -> Column:
    """ISO stamp without ``:`` and ``.``, for object names."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), "[:.]", "-")


def csv_cell(c: Column) -> Column:
    """Quoted CSV cell: quotes doubled, newlines turned into blanks."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), '"', '""'), "\n", " ")
    return F.concat(F.lit('"'), body, F.lit('"'))


def md_cell(c: Column) -> Column:
    """Markdown table cell: pipes escaped, newlines turned into blanks."""
    return F.regexp_replace(F.regexp_replace(c, r"\|", r"\\|"), "\n", " ")


def body_excerpt(c: Column, width: int = 200) -> Column:
    return F.translate(F.substring(F.coalesce(c, F.lit("")), 1, width), "\n", " ")
