"""From raw search hits to keyed envelopes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import canon, text
from tidemark.operators.ordering import numbered
from tidemark.session import cut_lineage


@dataclass(frozen=True)
class HitFields:
    """Where a hit keeps its identity. Paths are VARIANT paths into the hit."""

    ids: tuple[str, ...] = ("$.raw.kb_id", "$.raw.permanentid", "$.uniqueId", "$.title")
    page_ids: tuple[str, ...] = ("$.raw.permanentid", "$.uniqueId")
    modified: tuple[str, ...] = (
        "$.raw.updated_published_date", "$.raw.lastmodifieddate", "$.raw.date",
    )
    published: tuple[str, ...] = ("$.raw.original_published_date", "$.raw.firstpublisheddate")
    link: tuple[str, ...] = ("$.clickUri", "$.raw.clickableuri")
    title: str = "$.title"
    excerpt: str = "$.excerpt"


def _get(hit: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(hit, path, kind)


def hit_id(hit: Column, fields: HitFields = HitFields()) -> Column:
    return text.stable_id(*[_get(hit, p, "string") for p in fields.ids])


def hit_page_key(hit: Column, fields: HitFields = HitFields()) -> Column:
    """What overlapping pages are deduplicated by; null when a hit has neither id."""
    return text.or_missing(*[_get(hit, p, "string") for p in fields.page_ids])


def hit_modified_ms(hit: Column, fields: HitFields = HitFields()) -> Column:
    """First modification time that is set; zero counts as unset."""
    return text.or_zero(*[_get(hit, p, "bigint") for p in fields.modified])


def hit_link(hit: Column, fields: HitFields = HitFields()) -> Column:
    return F.coalesce(text.or_missing(*[_get(hit, p, "string") for p in fields.link]), F.lit(""))


def with_flat_fields(df: DataFrame, name: str, hit: str = "hit") -> DataFrame:
    """Add all fields of a hit as one map: the ``raw`` bag, over which top-level keys win.

    The top-level map is a column of its own, because an expression inside a lambda is
    evaluated once per element.
    """
    top = F.map_filter(canon.as_map(F.col(hit)), lambda k, _: k != "raw")
    raw = canon.as_map(F.try_variant_get(hit, "$.raw", "variant"))
    out = df.withColumn("_top", top).withColumn("_raw", raw)
    hidden = F.map_filter("_raw", lambda k, _: ~F.map_contains_key("_top", k))
    return out.withColumn(name, F.map_concat(hidden, F.col("_top"))).drop("_top", "_raw")


def selects(keep: Column, name: Column) -> Column:
    """Keep-list test. A null list is the wildcard; an empty list selects nothing."""
    return keep.isNull() | F.array_contains(keep, name)


def split_fields(df: DataFrame) -> DataFrame:
    """Add ``metadata`` and ``content`` by the keep-lists ``keep_metadata`` and ``keep_content``.

    A field in both lists goes to content; a field in neither is dropped.
    """
    df = with_flat_fields(df, "_fields")
    return df.withColumn(
        "content",
        canon.as_object(F.map_filter("_fields", lambda k, _: selects(F.col("keep_content"), k))),
    ).withColumn(
        "metadata",
        canon.as_object(
            F.map_filter(
                "_fields",
                lambda k, _: ~selects(F.col("keep_content"), k) & selects(F.col("keep_metadata"), k),
            )
        ),
    ).drop("_fields")


def dedup_hits(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """Drop repeats from overlapping pages: first by ``order`` wins, rows without a key all stay.

    ``order`` must be unique per row and fit in a BIGINT. The winners are found on
    (key, order) alone and joined back on both, so no wide row enters the aggregate
    and a hot key is spread by its orders.
    """
    tagged = df.withColumn("_key", F.nullif(key, F.lit(""))).withColumn("_order", order)
    winners = (
        tagged.filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min("_order").alias("_order"))
    )
    keyed = tagged.join(winners, ["_key", "_order"], "left_semi")
    loose = tagged.filter(F.col("_key").isNull())
    return keyed.unionByName(loose).select(*df.columns)


def collision_suffixes(df: DataFrame, order: Column, bucket_width: int = 1_000_000) -> DataFrame:
    """``(type_key, _order, _n)`` of the 2nd, 3rd, … row of one (type, id); narrow throughout."""
    narrow = df.select("type_key", "id", order.alias("_order"))
    bucket = F.floor(F.col("_order") / bucket_width)
    ranked = numbered(narrow, ["type_key", "id"], [F.col("_order")], bucket, "_n")
    return ranked.filter(F.col("_n") > 1).select("type_key", "_order", "_n")


def collision_ids(df: DataFrame, order: Column, bucket_width: int = 1_000_000) -> DataFrame:
    """Give the 2nd, 3rd, … row of one (type, id) the id ``id__2``, ``id__3``, …

    ``order`` is a unique BIGINT position. The numbers are found on three narrow columns and
    written as a table, so that Spark knows their size when it joins them to the documents:
    the usual few are broadcast and no document is shuffled; many are joined by shuffle.
    """
    suffixes = cut_lineage(df.sparkSession, collision_suffixes(df, order, bucket_width), "suffixes")
    out = df.withColumn("_order", order).join(suffixes, ["type_key", "_order"], "left")
    suffixed = F.concat(F.col("id"), F.lit("__"), F.col("_n").cast("string"))
    return out.withColumn("id", F.coalesce(suffixed, F.col("id"))).select(*df.columns)


def envelopes(hits: DataFrame, types: DataFrame, captured_at: Column, run_date: Column,
              fields: HitFields = HitFields()) -> DataFrame:
    """Hits (``document_type``, ``hit`` VARIANT, ``seq``) to envelopes plus the narrow digest columns.

    ``types`` is the type configuration; it has one row per configured type. It is written as a table first, so that
    Spark knows its size and need not shuffle the hits by type.
    """
    joined = hits.join(cut_lineage(hits.sparkSession, types, "types"), "document_type")
    split = split_fields(joined)
    out = split.select(
        run_date.alias("run_date"),
        captured_at.alias("captured_at"),
        "type_key",
        hit_id(F.col("hit"), fields).alias("id"),
        "document_type",
        F.coalesce(_get(F.col("hit"), fields.title, "string"), F.lit("")).alias("title"),
        hit_link(F.col("hit"), fields).alias("link"),
        hit_modified_ms(F.col("hit"), fields).alias("modified_ms"),
        "metadata",
        "content",
        "seq",
    )
    return with_digest(collision_ids(out, F.col("seq")))


def with_digest(df: DataFrame) -> DataFrame:
    """Add the hashes, lengths and flags that later joins read instead of the documents."""
    error = canon.text_field(F.col("content"), canon.ERROR_KEY)
    return (
        df.withColumn("metadata_hash", canon.canonical_hash(F.col("metadata")))
        .withColumn("content_hash", canon.content_hash(F.col("content")))
        .withColumn("has_body", canon.has_body(F.col("content")).cast("int"))
        .withColumn("body_chars", F.coalesce(F.length(canon.body_text(F.col("content"))), F.lit(0)))
        .withColumn("body_error", error)
    )


def tracking_records(df: DataFrame, created: str, original: str, updated: str) -> DataFrame:
    """The 13 narrow columns that change tracking keeps per article.

    The three names are the metadata keys of the dates; only real numbers count.
    """
    meta = F.col("metadata")
    return df.filter(F.coalesce(F.col("id"), F.lit("")) != "").select(
        "type_key", "id", "document_type", "title", "link",
        canon.number_field(meta, created).alias("created_ms"),
        canon.number_field(meta, original).alias("original_published_ms"),
        canon.number_field(meta, updated).alias("updated_published_ms"),
        "modified_ms", "captured_at", "metadata_hash", "content_hash", "has_body", "body_error",
    )


def flat_listing(hits: DataFrame, fields: HitFields = HitFields()) -> DataFrame:
    """Name, link, summary and two display dates per hit."""
    hit = F.col("hit")
    modified = hit_modified_ms(hit, fields)
    published = text.or_zero(*[_get(hit, p, "bigint") for p in fields.published])
    return hits.select(
        F.coalesce(_get(hit, fields.title, "string"), F.lit("")).alias("name"),
        hit_link(hit, fields).alias("link"),
        F.coalesce(_get(hit, fields.excerpt, "string"), F.lit("")).alias("summary"),
        text.display_date(published).alias("publication_date"),
        text.display_date(modified).alias("modification_date"),
        modified.alias("mod_ms"),
    )


def listing_filter(
    doc_type: str | None = None, product: str | None = None,
    start_ms: int | None = None, end_ms: int | None = None,
    type_col: str = "document_type", product_col: str = "products", date_col: str = "date_ms",
) -> Column:
    """Conjunction of the given parts: type equal, product among the values, date in [start, end)."""
    cond = F.lit(True)
    if doc_type:
        cond = cond & (F.col(type_col) == doc_type)
    if product:
        cond = cond & F.array_contains(product_col, product)
    if start_ms is not None:
        cond = cond & (F.col(date_col) >= start_ms)
    if end_ms is not None:
        cond = cond & (F.col(date_col) < end_ms)
    return cond


def incremental_read(df: DataFrame, cutoff, end, date: Column, modified: Column) -> DataFrame:
    """Rows dated in [cutoff, end) whose modification time is unset or not before the cutoff.

    Without a date filter (a full read) the caller reads ``df`` itself: rows without a
    date are then included.
    """
    return df.filter((date >= cutoff) & (date < end)).filter(modified.isNull() | (modified >= cutoff))


def only_types(df: DataFrame, include=None, exclude=None, ids=None, col: str = "type_key") -> DataFrame:
    """Include list, then exclude list (exclude wins), then ids; empty lists do not filter."""
    if include:
        df = df.filter(F.col(col).isin(list(include)))
    if exclude:
        df = df.filter(~F.coalesce(F.col(col).isin(list(exclude)), F.lit(False)))
    if ids:
        df = df.filter(F.col("id").isin(list(ids)))
    return df


def unknown_types(types: DataFrame, names: DataFrame) -> DataFrame:
    """Asked-for type names (column ``type_key``) that the configuration does not have."""
    return names.select("type_key").distinct().join(types.select("type_key"), "type_key", "left_anti")
