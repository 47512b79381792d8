"""Body extraction over landed pages: choose work, extract, classify, merge, report.

The page table is joined to the work list by URL. Texts are made by one scan over a page's tags, in Arrow batches, all else by column expressions,
on rows where they already lie; there is no shuffle by type, so one type that holds most pages does not slow the job down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import canon, pages
from tidemark.functions import risk as R
from tidemark.functions.text import strip
from tidemark.functions.urls import host
from tidemark.operators import KEY


def due(articles: DataFrame, refetch: bool = False, refetch_errors: bool = False) -> Column:
    """Whether an article needs a fetch: no body and no error yet, or asked for again."""
    if refetch:
        return F.lit(True)
    settled = canon.body_settled(F.col("content"))
    if refetch_errors:
        settled = settled & ~canon.text_field(F.col("content"), canon.ERROR_KEY).isNotNull()
    return ~settled


def extract_bodies(work: DataFrame, json_hosts: tuple[str, ...] = ()) -> DataFrame:
    """``body_text``, ``sections`` and ``raised`` of ``(type_key, id, url, final_url, html)``.

    Pages of ``json_hosts`` hold their text as data, which is used if it is long enough; else the markup is read.
    A row without a page is told so in ``raised``.
    """
    shaped = work.select(*KEY, "url", F.coalesce("final_url", "url", F.lit("")).alias("final_url"), "html")
    body = pages.article_text(F.col("html"))
    if json_hosts:
        shaped = with_embedded_body(shaped, "_data")
        data = host(F.col("url")).isin(list(json_hosts)) & (F.length("_data") >= pages.MIN_BODY)
        body = F.when(data, F.col("_data")).otherwise(body)
    # One element exploded: filters and later columns then use the text instead of repeating its expression.
    return shaped.select(
        *KEY, "url", "final_url", F.explode(F.array(body)).alias("body_text"), F.lit(None).cast("map<string,string>").alias("sections"),
        F.when(F.col("html").isNull(), "no page landed").alias("raised"),
    )


# The element that holds the page's data.
SCRIPT_OPEN = '<script id="__NEXT_DATA__" type="application/json">'
SCRIPT_CLOSE = "</script>"


def with_embedded_body(df: DataFrame, name: str, html: str = "html") -> DataFrame:
    """Add the body of pages that carry their data as JSON in a script element.

    Comment blocks of a compiled source, else an API description; empty where there is
    neither. The order of paths is that of the VARIANT, which is by name. The steps are
    columns of their own so that the page is parsed once per row.
    """
    # Literal splits: a lazy group over a whole page costs several times as much.
    rest = F.split_part(F.col(html), F.lit(SCRIPT_OPEN), F.lit(2))
    script = F.when(rest.contains(SCRIPT_CLOSE), F.substring_index(rest, SCRIPT_CLOSE, 1))
    doc = F.try_variant_get(
        F.try_parse_json(script), "$.props.pageProps.docData", "variant"
    )
    out = df.withColumn("_doc", doc)
    out = out.withColumn("_source", canon.text_field(F.col("_doc"), "compiledSource")).withColumn(
        "_spec", canon.field(F.col("_doc"), "swaggerFile")
    )
    out = out.withColumn("_paths", canon.as_map(canon.field(F.col("_spec"), "paths"))).withColumn(
        "_info", canon.field(F.col("_spec"), "info")
    )
    body = (
        F.when(F.col("_source").isNotNull(), comment_blocks(F.col("_source")))
        .when(F.col("_spec").isNotNull(), api_markdown(F.col("_info"), F.col("_paths")))
        .otherwise("")
    )
    return out.withColumn(name, body).drop("_doc", "_source", "_spec", "_paths", "_info")


def comment_blocks(source: Column) -> Column:
    """Text of the ``/* … */`` blocks, import and export lines left out."""
    blocks = F.transform(F.regexp_extract_all(source, F.lit(r"(?s)/\*(.*?)\*/"), F.lit(1)), strip)
    kept = F.filter(blocks, lambda b: (b != "") & ~b.rlike(r"^(import|export)\s"))
    return strip(F.regexp_replace(F.array_join(kept, "\n\n"), r"\n{3,}", "\n\n"))


# The operations an API page lists.
HTTP_METHODS = ["get", "post", "put", "delete", "patch"]


def api_markdown(info: Column, path_map: Column) -> Column:
    """Title, description and one heading per path and method."""
    some = lambda v, key: F.nullif(canon.text_field(v, key), F.lit(""))
    head = F.array(F.concat(F.lit("# "), some(info, "title")), some(info, "description"))

    def operation(path, e):
        op = e["value"]
        title = F.coalesce(some(op, "summary"), some(op, "x-displayname"))
        return F.array(
            F.concat(F.lit("## "), F.upper(e["key"]), F.lit(" "), path),
            F.concat(F.lit("**"), title, F.lit("**")),
            some(op, "description"),
        )

    def path_blocks(p):
        ops = F.filter(
            F.map_entries(canon.as_map(p["value"])),
            lambda e: e["key"].isin(HTTP_METHODS) & canon.is_object(e["value"]),
        )
        return F.flatten(F.transform(ops, lambda e: operation(p["key"], e)))

    paths = F.filter(
        F.map_entries(path_map),
        lambda p: canon.is_object(p["value"]),
    )
    blocks = F.concat(head, F.flatten(F.transform(paths, path_blocks)))
    return strip(F.array_join(F.array_compact(blocks), "\n\n"))


def repo_body(items: DataFrame) -> DataFrame:
    """Bodies of landed repository items: ``kind`` and ``payload`` (API JSON, or text for a file)."""
    doc = F.try_parse_json(F.col("payload"))
    content = F.coalesce(canon.text_field(doc, "content"), F.lit(""))
    readme = F.when(
        canon.text_field(doc, "encoding") == "base64",
        F.decode(F.unbase64(F.regexp_replace(content, "\n", "")), "UTF-8"),
    ).otherwise(content)
    raw = (
        F.when(F.col("kind") == "file", F.col("payload"))
        .when(F.col("kind") == "readme", readme)
        .otherwise(F.coalesce(canon.text_field(doc, "body"), F.lit("")))
    )
    body = strip(raw)
    return items.withColumn("body_text", F.nullif(body, F.lit(""))).withColumn(
        "body_error",
        F.when(
            F.coalesce(body, F.lit("")) == "",
            F.concat(F.lit("empty repository "), F.col("kind"), F.lit(" body (no description)")),
        ),
    )


def with_outcome(extracted: DataFrame, js_hosts: list[str] = (), kb_host: str = "") -> DataFrame:
    """Add ``outcome`` and ``body_error``; a row whose extraction raised keeps its message."""
    js = host(F.col("url")).isin(list(js_hosts)) if js_hosts else F.lit(False)
    u, f, b = F.col("url"), F.col("final_url"), F.col("body_text")
    kind = pages.page_outcome(u, f, b, js, kb_host)
    early = ["no-link", "js-rendered", "in-kb", "moved"]
    # Whatever is known from the URLs alone is decided before the page is looked at.
    outcome = F.when(F.col("raised").isNotNull() & ~kind.isin(early), "raised").otherwise(kind)
    out = extracted.withColumn("outcome", outcome)
    return out.withColumn(
        "body_error",
        F.when(F.col("outcome") == "raised", F.col("raised")).otherwise(
            pages.outcome_error(F.col("outcome"), u, f, b)
        ),
    ).withColumn("body_text", F.when(F.col("outcome") == "ok", F.col("body_text")))


def merge_bodies(articles: DataFrame, results: DataFrame, fetched_at: Column) -> DataFrame:
    """Clear the old body keys of ``content``, lay the result over it and keep the rest."""
    r = results.select(*KEY, "body_text", "sections", "body_error", "final_url")
    j = articles.drop("body_text", "body_error").join(r, KEY, "left")
    value = lambda c: F.parse_json(F.to_json(F.struct(c.alias("v"))))
    entry = lambda key, c: F.when(
        c.isNotNull(), F.struct(F.lit(key).alias("key"), F.try_variant_get(value(c), "$.v", "variant").alias("value"))
    )
    overlay = F.map_from_entries(
        F.array_compact(
            F.array(
                entry("body_text", F.col("body_text")),
                entry("sections", F.col("sections")),
                entry("bodyError", F.col("body_error")),
                entry("bodySource", F.col("final_url")),
                entry("fetchedAt", fetched_at.cast("string")),
            )
        )
    )
    base = F.map_filter(canon.as_map(F.col("content")), lambda k, _: ~k.isin(canon.STALE_KEYS))
    merged = canon.as_object(F.map_concat(base, overlay))
    hit = F.col("final_url").isNotNull()
    return j.withColumn("content", F.when(hit, merged).otherwise(F.col("content"))).select(
        *[c for c in articles.columns if c not in ("body_text", "body_error")]
    )


def enrich_errors(results: DataFrame) -> DataFrame:
    """The articles that failed, with where and why."""
    return results.filter(F.col("body_error").isNotNull()).select(*KEY, F.col("url").alias("link"), F.col("body_error").alias("error"))


def enrich_report(results: DataFrame, skipped: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """Per type: enriched, failed, skipped, total, and how many results wait in pending (``staged``).

    A returned error counts as failed. A staged row is one of the enriched or failed too.
    """
    done = results.select("type_key", F.when(F.col("body_error").isNull(), "enriched").otherwise("failed").alias("k"))
    all_rows = done.unionByName(skipped.select("type_key", F.lit("skipped").alias("k")))
    if staged is not None:
        all_rows = all_rows.unionByName(staged.select("type_key", F.lit("staged").alias("k")))
    n = lambda k: F.count_if(F.col("k") == k)
    return all_rows.groupBy("type_key").agg(
        n("enriched").alias("enriched"), n("failed").alias("failed"), n("skipped").alias("skipped"),
        F.count_if(F.col("k") != "staged").alias("total"), n("staged").alias("staged"),
    )


def enrich_changelog(results: DataFrame, had_body: Column, run_id: Column, ts: Column) -> DataFrame:
    return results.select(
        run_id.alias("run_id"), ts.alias("ts"),
        R.body_change_op(F.col("body_error"), had_body).alias("op"), *KEY,
        F.lit("enrich").alias("source"), F.col("body_error").alias("detail"),
    )


def line_delta(old: DataFrame, new: DataFrame, body: str = "body_text", changed: DataFrame | None = None) -> DataFrame:
    """Added and removed lines per article, counted as multisets.

    Lines are counted per (article, line digest) on each side and compared per line, so a
    long article is spread over many tasks and no text is shuffled. ``changed`` (the keys a
    snapshot diff found) keeps the rest of the corpus out.
    """
    def lines(df, side):
        if changed is not None:
            df = df.join(changed.select(*KEY), KEY, "left_semi")
        return df.select(*KEY, F.explode(F.split(body, "\n")).alias("line")).select(
            *KEY, F.unhex(F.md5("line")).alias("_line"), F.lit(side).alias("_s")
        )

    counts = (
        lines(old, -1).unionByName(lines(new, 1))
        .groupBy(*KEY, "_line")
        .agg(F.sum("_s").alias("d"))
        .filter(F.col("d") != 0)
    )
    return counts.groupBy(*KEY).agg(
        F.sum(F.greatest("d", F.lit(0))).alias("added"),
        F.sum(F.greatest(-F.col("d"), F.lit(0))).alias("removed"),
    )

