"""Field catalogue, facets, fill rates and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import canon
from tidemark.functions.text import is_blank, sample_of
from tidemark.session import cut_lineage


def field_rows(hits: DataFrame, hit: str = "hit", keys: list[str] = ("type_key", "seq")) -> DataFrame:
    """One row per field of each hit: ``field``, ``source``, ``value``. Top-level fields win.

    Clashes are settled within a row, so no shuffle is needed for them.
    """
    top = F.map_filter(canon.as_map(F.col(hit)), lambda k, _: k != "raw")
    raw = canon.as_map(F.try_variant_get(hit, "$.raw", "variant"))

    def tagged(entries, source):
        return F.transform(
            entries,
            lambda e: F.struct(e["key"].alias("field"), F.lit(source).alias("source"), e["value"].alias("value")),
        )

    # Maps as columns of their own: inside a lambda they would be built once per element.
    maps = hits.select(*keys, top.alias("_top"), raw.alias("_raw"))
    hidden = F.filter(F.map_entries("_raw"), lambda e: ~F.map_contains_key("_top", e["key"]))
    rows = F.concat(tagged(F.map_entries("_top"), "top"), tagged(hidden, "raw"))
    return maps.select(*keys, F.inline(rows))


def field_catalogue(rows: DataFrame, totals: DataFrame, order: str = "seq") -> DataFrame:
    """Per type and field: occurrences, coverage, type names, source and the first sample.

    ``totals`` has ``type_key`` and ``total``; it is one row per type. All aggregates
    combine in the map stage, so a field that every hit carries costs one row per task.
    The first value that is not blank is kept as it is, and only those of the result are made samples.
    """
    def plain(value: Column) -> Column:
        return F.when(canon.type_name(value) == "null", F.lit("")).otherwise(
            F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
        )

    value = F.col("value")
    named = rows.select(
        "type_key", "field", "source", F.col(order).alias("_order"), "value",
        canon.type_name(value).alias("_type"), is_blank(plain(value)).alias("_blank"),
    )
    first = F.when(~F.col("_blank"), F.col("_order"))
    grouped = named.groupBy("type_key", "field").agg(
        F.min_by("source", "_order").alias("source"),
        F.array_sort(F.collect_set("_type")).alias("types"),
        F.count(F.lit(1)).alias("occurrences"),
        F.min_by("value", first).alias("_value"),
    ).withColumn("sample", sample_of(plain(F.col("_value")))).drop("_value")
    return grouped.join(totals, "type_key").withColumn(
        "coverage", F.bround(F.col("occurrences") / F.col("total"), 3)
    ).drop("total")


def with_section(catalogue: DataFrame, types: DataFrame) -> DataFrame:
    """Where the type configuration puts each field: content, metadata or unselected."""
    from tidemark.operators.ingest import selects

    j = catalogue.join(types.select("type_key", "keep_metadata", "keep_content"), "type_key")
    section = (
        F.when(selects(F.col("keep_content"), F.col("field")), "content")
        .when(selects(F.col("keep_metadata"), F.col("field")), "metadata")
        .otherwise("unselected")
    )
    return j.withColumn("section", section).drop("keep_metadata", "keep_content")


def facet(df: DataFrame, values: Column, by: list[str] = ()) -> DataFrame:
    """Count the rows that carry each value of a multi-valued field."""
    distinct = F.array_distinct(values)
    return (
        df.select(*by, F.explode(distinct).alias("value"))
        .groupBy(*by, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_facets(counts: DataFrame, *, limit: int) -> DataFrame:
    """The ``limit`` most frequent values, as a search service with such a limit lists them."""
    return counts.orderBy(F.desc("n"), "value").limit(limit)


def with_types(by_type: DataFrame) -> DataFrame:
    """Of each value the number of rows and the types that have it, from counts per type."""
    return by_type.groupBy("value").agg(F.sum("n").alias("n"), F.array_sort(F.collect_set("type_key")).alias("types"))


def hidden_values(by_type: DataFrame, *, limit: int) -> DataFrame:
    """Values found inside some type but absent from the global list of ``limit`` values, with those types.

    The values with their types are written once; the list and what it lacks are both read from there, so the rows are taken apart once.
    """
    values = cut_lineage(by_type.sparkSession, with_types(by_type), "facet_values")
    return values.join(top_facets(values, limit=limit).select("value"), "value", "left_anti")


def equal_tags(df: DataFrame, tags: Column, row_id: Column) -> DataFrame:
    """Pairs of tags that exactly the same rows carry.

    Rows of a tag are reduced to a fingerprint: their number and three order-free sums
    over 64-bit hashes of the row ids. Only tags with one fingerprint can be carried by the same
    rows, so no pair is formed inside a row, and a tag on a third of all rows costs one
    number per task. Within one fingerprint each tag is paired with the smallest of
    its group only, and a pair counts once the rows that both tags share are as many as each has.
    Row ids must be unique.
    """
    rows = df.select(F.explode(F.array_distinct(tags)).alias("tag"), row_id.alias("_id"))
    wide = lambda c: F.sum(c.cast("decimal(20,0)"))
    marks = rows.groupBy("tag").agg(
        F.count(F.lit(1)).alias("n"),
        wide(F.xxhash64("_id")).alias("_a"),
        wide(F.xxhash64(F.lit("b"), "_id")).alias("_b"),
        F.bit_xor(F.xxhash64(F.lit("c"), "_id")).alias("_c"),
    )
    keys = ["n", "_a", "_b", "_c"]
    heads = marks.groupBy(*keys).agg(F.min("tag").alias("same_as"), F.count(F.lit(1)).alias("_k"))
    pairs = cut_lineage(df.sparkSession, (
        marks.join(heads.filter("_k > 1"), keys)
        .filter(F.col("tag") != F.col("same_as"))
        .select("same_as", "tag", "n")
    ), "tag_pairs")
    # Verified row by row: each pair is looked for in the rows of its own tag only.
    carried = df.select(F.array_distinct(tags).alias("_tags")).withColumn("tag", F.explode("_tags"))
    shared = carried.join(pairs, "tag").filter(F.array_contains("_tags", F.col("same_as")))
    return shared.groupBy("same_as", "tag", "n").agg(F.count(F.lit(1)).alias("_shared")).filter("_shared = n").drop("_shared")


def fill_rate(df: DataFrame, columns: list[str], by: str = "type_key") -> DataFrame:
    """Rows and the share of rows with a value, per type, for each column."""
    filled = lambda c: F.count(F.nullif(F.col(c).cast("string"), F.lit("")))
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"),
        *[filled(c).alias(f"{c}_n") for c in columns],
    ).select(
        by, "total", *[f"{c}_n" for c in columns],
        *[F.bround(F.col(f"{c}_n") * 100.0 / F.col("total"), 1).alias(f"{c}_pct") for c in columns],
    )


def lifecycle_split(df: DataFrame, state: str, values: list[str], by: str = "type_key") -> DataFrame:
    """Counts per type with one column per lifecycle value (the values are given, so one pass)."""
    return df.groupBy(by).agg(*[F.count_if(F.col(state) == v).alias(v) for v in values])


def date_histogram(df: DataFrame, ts: Column, unit: str) -> DataFrame:
    return (
        df.groupBy(F.date_trunc(unit, ts).cast("date").alias("period"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
