"""Sinks: appends, audit trails, CSV and JSON exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import csv_cell

CSV_HEADER = "Name,Link,Summary,Publication Date,Modification Date"
CSV_COLUMNS = ["name", "link", "summary", "publication_date", "modification_date"]


def append_monthly(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Append rows to a trail partitioned by month, one write for all of them."""
    df.withColumn("month", F.date_format(F.col(ts), "yyyy-MM")).write.mode("append").partitionBy(
        "month"
    ).json(path)


def audit_frames(records: DataFrame, actor: str, source: str, ts: Column) -> dict[str, DataFrame]:
    """Rows for the three trails of a promotion.

    ``records`` feeds three writes: pass a frame read from a table (see ``cut_lineage``).
    """
    decisions = records.select(
        "id", "type", F.lit("approved").alias("op"),
        F.coalesce("approved_by", F.lit(actor)).alias("actor"), F.lit(source).alias("source"),
        "run_date", ts.alias("ts"),
    )
    stamped = records.withColumn("ts", ts)
    return {
        "changed_ids": stamped, "decisions": decisions, "changes": stamped.filter(F.col("op") == "changed"),
    }


def write_audit(records: DataFrame, base: str, actor: str, source: str, ts: Column) -> None:
    for name, frame in audit_frames(records, actor, source, ts).items():
        append_monthly(frame, f"{base}/{name}")


def csv_lines(listing: DataFrame) -> DataFrame:
    """Each row as one CSV line, all cells quoted, newlines turned into blanks."""
    return listing.select(F.concat_ws(",", *[csv_cell(F.col(c)) for c in CSV_COLUMNS]).alias("value"))


def write_csv(listing: DataFrame, path: str) -> None:
    """Part files with the five fixed headers, every cell quoted, quotes doubled."""
    cells = listing.select(*[F.regexp_replace(F.coalesce(c, F.lit("")), "\n", " ").alias(c) for c in CSV_COLUMNS])
    named = cells.toDF(*CSV_HEADER.split(","))
    named.write.mode("overwrite").option("header", True).option("quoteAll", True).option(
        "escape", '"'
    ).option("emptyValue", "").csv(path)


def write_article_json(articles: DataFrame, path: str) -> None:
    """Text export: one JSON document per line, one folder per type."""
    doc = F.to_json(F.struct(*[c for c in articles.columns if c != "type_key"]))
    articles.select("type_key", doc.alias("value")).write.mode("overwrite").partitionBy("type_key").text(path)


def write_document(doc: DataFrame, path: str) -> None:
    """A one-row JSON report (run index, enrich report)."""
    doc.coalesce(1).write.mode("overwrite").text(path)


def enrich_report_document(report: DataFrame, generated: Column) -> DataFrame:
    """The extraction report as one JSON document, one entry per type."""
    entry = F.struct("type_key", "enriched", "failed", "skipped", "total", "staged")
    return report.agg(
        F.to_json(
            F.struct(generated.alias("generatedAt"), F.array_sort(F.collect_list(entry)).alias("types"))
        ).alias("document")
    )
