"""The type configuration as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "ordinal int, type_key string, document_type string, keep_metadata array<string>, "
    "keep_content array<string>, enrichable boolean, html_field string"
)


def type_table(spark: SparkSession, types: dict[str, dict]) -> DataFrame:
    """One row per type. ``metadata`` and ``content`` are ``"*"`` or a list of names.

    The defaults are all metadata and no content. A null list in the table is the
    wildcard; ``["*"]`` is a list with the literal name ``*`` and matches nothing else.
    """
    def keep(value, default):
        value = value or default
        return None if value == "*" else list(value)

    rows = [
        (
            n, key, conf.get("documentType") or "", keep(conf.get("metadata"), "*"),
            keep(conf.get("content"), []), bool(conf.get("enrichable", False)), conf.get("htmlField"),
        )
        for n, (key, conf) in enumerate(types.items())
    ]
    return spark.createDataFrame(rows, SCHEMA)


def readable(types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Types that can be read, and those that fail because they name no document type."""
    return types.filter("document_type <> ''"), types.filter("document_type = ''")
