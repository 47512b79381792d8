"""Scans: article trees, JSON lines, hash indexes and page tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import canon
from tidemark.functions.text import is_blank

def article_tree(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Every ``*.json`` below the type folders: (articles, rejects).

    Files and folders whose name starts with ``_`` are no articles; Spark's listing skips
    them. A file that is not JSON goes to the rejects with its path; a row without an id is
    dropped.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    parsed = files.select(
        F.col("_metadata.file_path").alias("file_path"), F.try_parse_json("value").alias("v"), "value"
    )
    rejects = parsed.filter(F.col("v").isNull()).select("file_path", "value")
    get = lambda p, kind: F.try_variant_get("v", p, kind)
    articles = parsed.filter(F.col("v").isNotNull()).select(
        F.element_at(F.split("file_path", "/"), -2).alias("type_key"),
        F.coalesce(get("$.id", "string"), F.lit("")).alias("id"),
        F.coalesce(get("$.documentType", "string"), F.lit("")).alias("document_type"),
        F.coalesce(get("$.title", "string"), F.lit("")).alias("title"),
        F.coalesce(get("$.link", "string"), F.lit("")).alias("link"),
        canon.number_field(F.col("v"), "modifiedMs").alias("modified_ms"),
        F.coalesce(get("$.capturedAt", "string"), F.lit("")).alias("captured_at"),
        get("$.metadata", "variant").alias("metadata"),
        get("$.content", "variant").alias("content"),
    )
    return articles.filter(F.col("id") != ""), rejects


def article_lines(spark: SparkSession, path: str) -> DataFrame:
    """Articles stored one per line, as one VARIANT column ``v``."""
    return spark.read.option("singleVariantColumn", "v").json(path)


def json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines with a schema; blank and malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_lines_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the same file that are neither blank nor JSON, for counting."""
    lines = spark.read.text(path)
    return lines.filter(~is_blank(F.col("value")) & F.try_parse_json("value").isNull())


def run_manifest(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    """All types' manifest rows of one run: a partition of one table."""
    return spark.read.parquet(path).filter(F.col("run_date") == run_date)


def hash_index_file(spark: SparkSession, path: str) -> DataFrame:
    """Import a hash index kept as one JSON object ``{"<type> <id>": hash}``, gzip or plain."""
    doc = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    pairs = doc.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select(
        F.col("key").alias("k"), F.col("value").cast("string").alias("metadata_hash")
    )
    parts = F.split("k", " ", 2)
    return pairs.select(
        F.get(parts, F.lit(0)).alias("type_key"), F.get(parts, F.lit(1)).alias("id"), "metadata_hash"
    ).filter(F.col("id") != "")


# An entry of a JSON map of texts, without the quote and comma that end it: a key, a value, and what may stand around them.
ENTRY = r'^\s*\{?\s*"((?:[^"\\]|\\.)*)"\s*:\s*"((?:[^"\\]|\\.)*)"?\s*\}?\s*$'


def hash_index_entries(spark: SparkSession, path: str) -> DataFrame:
    """The same index read entry by entry: files are cut where an entry ends, so one map is read by many tasks and no row holds more than an entry.

    Any white space between entries will do. A quote and a comma in a row inside a key or value would look like the end of an entry; such a
    file, like any that is no map of texts, is refused rather than read wrong. Gzip files can be read too, but not cut, each by one task.
    """
    lines = spark.read.option("lineSep", '",').text(path).filter(~is_blank(F.col("value")) & ~F.col("value").rlike(r"^\s*\{\s*\}\s*$"))
    key, value = (F.regexp_extract("value", ENTRY, i) for i in (1, 2))
    text = lambda raw: F.get_json_object(F.concat(F.lit('{"t":"'), raw, F.lit('"}')), "$.t")
    sound = F.col("value").rlike(ENTRY)
    named = lines.select(
        F.when(sound, text(key)).otherwise(F.raise_error(F.concat(F.lit("not an entry of a hash index: "), F.substring("value", 1, 80)))).alias("k"),
        text(value).alias("metadata_hash"))
    parts = F.split("k", " ", 2)
    return named.select(F.get(parts, F.lit(0)).alias("type_key"), F.get(parts, F.lit(1)).alias("id"), "metadata_hash").filter(F.col("id") != "")


def write_hash_index_entries(index: DataFrame, path: str) -> None:
    """The index as text files of entries, each file a stretch of one JSON map."""
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("t"))), r'(?s)^\{"t":(.*)"\}$', 1)
    rows = index.select(F.concat(quoted(F.concat_ws(" ", "type_key", "id")), F.lit('":'), quoted(F.col("metadata_hash"))).alias("value"))
    rows.write.mode("overwrite").option("lineSep", '",').text(path)


def empty_index(spark: SparkSession) -> DataFrame:
    """What a first run starts from."""
    return spark.createDataFrame([], "type_key string, id string, metadata_hash string")


def upstream_ids(hits: DataFrame) -> DataFrame:
    """The ids-only sweep: two narrow columns of the upstream snapshot."""
    return hits.select("type_key", "id")
