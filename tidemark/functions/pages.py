"""Text of a landed page by one scan over its tags, and its outcome class as one CASE over its columns."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.urls import first_segment, host, path

MIN_BODY = 40

# Elements that are no part of an article, elements that may be hidden, where the article is, and how tags show in its text.
DROPPED = ("script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form", "button")
HIDDEN = ("div", "span", "p", "section")
REGIONS = ("main", "article", "body")
BLOCKS = ("p", "div", "section", "article", "ul", "ol", "table", "tr", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6")
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]

BLANK = "[ \\t\\r\\n\\f]"
NAME = re.compile(r"<(/?)([a-z]\w*)", re.I | re.A)
UNSEEN = re.compile(f"display{BLANK}*:{BLANK}*none", re.I)
ENDS = {tag: re.compile(f"</{tag}{BLANK}*>", re.I) for tag in ("script", "style")}
OPENING = {"li": "\n- ", "br": "\n", **dict.fromkeys(BLOCKS, "\n\n"), **{f"h{n}": "\n\n" + "#" * n + " " for n in range(1, 7)}}
CLOSING = dict.fromkeys(BLOCKS, "\n\n")
TIDY = [(re.compile(p), t) for p, t in ((" *\n *", "\n"), ("\n\n\n+", "\n\n"), (" +", " "), ("^[ \n]+|[ \n]+$", ""))]


def tags(html: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, name, closes) of every tag; comments and the insides of script and style come as one nameless tag each.

    What is looked for and not found is not looked for again, so the scan is linear in the page whatever is left open in it.
    """
    at, size, missing = 0, len(html), set()
    while (at := html.find("<", at)) >= 0:
        end = -1
        if html.startswith("<!--", at) and "comment" not in missing:
            end = html.find("-->", at + 4)
            if end >= 0:
                yield at, end + 3, "", False
                at = end + 3
                continue
            missing.add("comment")
        end = html.find(">", at) + 1
        if not end:
            return
        found = NAME.match(html, at, end)
        name, closes = (found[2].lower(), bool(found[1])) if found else ("", False)
        if name in ENDS and not closes and name not in missing:
            if last := ENDS[name].search(html, end, size):
                yield at, last.end(), "", False
                at = last.end()
                continue
            missing.add(name)
        yield at, end, name, closes
        at = end


def left_out(html: str, found: list[tuple[int, int, str, bool]]) -> list[tuple[int, int]]:
    """Stretches of boilerplate and hidden elements, from their opening to their own closing tag, by start. One that is never closed is not left out."""
    open_by: dict[str, list[tuple[int, bool]]] = {tag: [] for tag in (*DROPPED, *HIDDEN)}
    out = []
    for start, end, name, closes in found:
        if not name:
            out.append((start, end))
        elif (held := open_by.get(name)) is not None:
            # A paragraph does not nest: the next one closes it.
            if held and (closes or name == "p"):
                since, drop = held.pop()
                if drop:
                    out.append((since, end if closes else start))
            if not closes:
                held.append((start, name in DROPPED or bool(UNSEEN.search(html, start, end))))
    return sorted(out)


def page_text(html: str) -> str:
    """The page's text with headings and list items marked: that of main, else article, else body, else all."""
    found = list(tags(html))
    pieces: list[tuple[str, str, bool]] = []  # text before a tag that stays, its name, whether it closes
    stretches, k = left_out(html, found), 0
    at, text = 0, []
    for begin, stop, name, closes in [*found, (len(html), len(html), "", False)]:
        while k < len(stretches) and stretches[k][0] <= begin:
            start, end = stretches[k]
            if end > at:
                text.append(html[at:start])
                at = end
            k += 1
        if begin >= at:
            pieces.append(("".join([*text, html[at:begin]]), name, closes))
            at, text = stop, []
    first = last = None
    for region in REGIONS:
        first = next((i for i, (_, name, closes) in enumerate(pieces) if name == region and not closes), None)
        last = next((i for i in range(len(pieces) - 1, -1, -1) if pieces[i][1] == region and pieces[i][2]), None)
        if first is not None and last is not None and first < last and (last > first + 1 or pieces[last][0]):
            break
    else:
        first, last = -1, len(pieces)
    parts = []
    for i, (before, name, closes) in enumerate(pieces[first + 1 : last + 1], first + 1):
        for entity, char in ENTITIES:
            before = before.replace(entity, char)
        parts.append(" ".join(re.split(f"{BLANK}+", before)))
        if i < last:
            parts.append((CLOSING if closes else OPENING).get(name, ""))
    out = "".join(parts)
    for pattern, mark in TIDY:
        out = pattern.sub(mark, out)
    return out


@F.pandas_udf(StringType())
def article_text(html: pd.Series) -> pd.Series:
    """``page_text`` of every page; null for a null page."""
    return html.map(lambda page: None if page is None else page_text(page))


def article_text_sql(html: str) -> str:
    """The text by patterns instead of a scan, as SQL over a column that is written once. Equal where boilerplate holds no element of its own kind."""
    cleaned = [("(?is)<!--.*?-->", "")]
    cleaned += [(f"(?is)<{tag}\\b[^>]*>.*?</{tag}{BLANK}*>", "") for tag in DROPPED]
    cleaned += [(f"(?is)<{tag}\\b[^>]*display{BLANK}*:{BLANK}*none[^>]*>.*?</{tag}{BLANK}*>", "") for tag in HIDDEN]
    plain = [(f"{BLANK}+", " "), *[(f"(?i)<h{n}\\b[^>]*>", "\n\n" + "#" * n + " ") for n in range(1, 7)]]
    plain += [("(?i)<li\\b[^>]*>", "\n- "), ("(?i)<br[^>]*>", "\n"), (f"(?i)</?({'|'.join(BLOCKS)})\\b[^>]*>", "\n\n"), ("<[^>]*>", "")]
    plain += [*ENTITIES, *[(p.pattern, t) for p, t in TIDY]]

    def steps(column: str, pairs) -> str:
        for pattern, text in pairs:
            p, t = pattern.replace("'", "''"), text.replace("'", "''")
            column = f"regexp_replace({column}, '{p}', '{t}', 'g')"
        return column

    regions = ", ".join(f"nullif(regexp_extract(_c, '(?is)<{tag}\\b[^>]*>(.*)</{tag}{BLANK}*>', 1), '')" for tag in REGIONS)
    return f"(SELECT {steps('_r', plain)} FROM (SELECT coalesce({regions}, _c) AS _r FROM (SELECT {steps(html, cleaned)} AS _c)))"


# How a page that is missing says so with status 200.
SOFT_404_START = r"^#{0,3}\s*404 - Page Not Found"
SOFT_404_TEXT = "the page you are looking for does not exist"


def moved_home(url: Column, final_url: Column) -> Column:
    """A redirect to a folder page: the page asked for is gone."""
    was_file = path(url).rlike(r"(?i)/[^/]+\.[a-z0-9]+$")
    return (
        (final_url != url)
        & path(final_url).endswith("/")
        & (was_file | (first_segment(url) != first_segment(final_url)))
    )


def page_outcome(
    url: Column, final_url: Column, body: Column, js_rendered: Column, kb_host: str
) -> Column:
    """``no-link``, ``js-rendered``, ``in-kb``, ``moved``, ``too-short``, ``soft-404`` or ``ok``."""
    text = F.coalesce(body, F.lit(""))
    # Without a knowledge-base host no redirect counts as one into it.
    in_kb = (host(final_url) == kb_host) & (host(url) != kb_host) if kb_host else F.lit(False)
    return (
        F.when(F.coalesce(url, F.lit("")) == "", "no-link")
        .when(js_rendered, "js-rendered")
        .when(in_kb, "in-kb")
        .when(moved_home(url, final_url), "moved")
        .when(F.length(text) < MIN_BODY, "too-short")
        .when(
            text.rlike(SOFT_404_START) | F.lower(F.substring(text, 1, 400)).contains(SOFT_404_TEXT),
            "soft-404",
        )
        .otherwise("ok")
    )


def outcome_error(outcome: Column, url: Column, final_url: Column, body: Column) -> Column:
    """The error text stored with a page that gave no body; null when it did."""
    kb_id = F.nullif(F.regexp_extract(final_url, r"/article/(K\d+)", 1), F.lit(""))
    return (
        F.when(outcome == "no-link", "no link to fetch")
        .when(
            outcome == "js-rendered",
            F.concat(
                F.lit("JS-rendered host "), host(url),
                F.lit(": body not in fetched HTML (needs headless browser)"),
            ),
        )
        .when(
            outcome == "in-kb",
            F.concat(F.lit("redirected into the knowledge base: "), F.coalesce(kb_id, final_url)),
        )
        .when(
            outcome == "moved",
            F.concat(
                F.lit("redirected to landing page "), final_url,
                F.lit(" (original page moved/removed)"),
            ),
        )
        .when(
            outcome == "too-short",
            F.concat(
                F.lit("extracted body too short ("),
                F.length(F.coalesce(body, F.lit(""))).cast("string"), F.lit(" chars)"),
            ),
        )
        .when(outcome == "soft-404", "soft 404 (HTTP 200 'Page Not Found')")
    )
