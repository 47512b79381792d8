"""URL parts and what a repository link points at."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Lenient, as landed URLs may hold blanks and other characters that a strict parser rejects.
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1)


def segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda p: p != "")


def first_segment(url: Column) -> Column:
    return F.coalesce(F.get(segments(url), F.lit(0)), F.lit(""))


def repo_target(url: Column) -> Column:
    """Struct ``kind, owner, repo, target, error`` for a code-host URL.

    Four shapes are known: repository (readme), issue, pull request and file.
    """
    p = segments(url)
    n = F.size(p)
    at = lambda i: F.get(p, F.lit(i))
    kind = (
        F.when(n == 2, "readme")
        .when((n >= 4) & (at(2) == "issues"), "issue")
        .when((n >= 4) & (at(2) == "pull"), "pull")
        .when((n >= 5) & (at(2) == "blob"), "file")
    )
    target = (
        F.when(kind.isin("issue", "pull"), at(3))
        .when(kind == "file", F.array_join(F.slice(p, 5, F.greatest(n - 4, F.lit(1))), "/"))
    )
    error = F.when(n < 2, F.concat(F.lit("unrecognized repository URL: "), url)).when(
        kind.isNull(), F.concat(F.lit("unsupported repository URL shape: "), url)
    )
    return F.struct(
        kind.alias("kind"),
        F.when(n >= 2, at(0)).alias("owner"),
        F.when(n >= 2, at(1)).alias("repo"),
        target.alias("target"),
        error.alias("error"),
    )


def item_url(item_id: Column, template: str, link: Column) -> Column:
    """The page of an item from its number (``template`` holds ``{}``), else its link."""
    before, after = template.split("{}")
    return F.coalesce(
        F.when(item_id != "", F.concat(F.lit(before), item_id, F.lit(after))),
        F.nullif(link, F.lit("")),
    )
