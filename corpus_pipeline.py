"""The corpus pipeline: quality, near copies, benchmark passages, personal data, and the mix, stage by stage.

Each stage reads what the stage before it has written. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, mixing, pii, quality, simhash
from tidemark.llm.common import stored, table


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def apart(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with all further columns of docs renamed while it works, so that none can clash with a column of its own."""

    @functools.wraps(stage)
    def run_apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = docs.columns
        names = [c if c in COLUMNS else f"__column_{i}" for i, c in enumerate(before)]
        return stage(spark, docs.toDF(*names), sf_dir).select(*names).toDF(*before)

    return run_apart


@apart
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from all labels but the held-out fold."""
    model = quality.fit(table(spark, sf_dir, "documents"), quality.learnable(table(spark, sf_dir, "labels")))
    return quality.score(docs, model, docs.columns).filter("score >= 0.5").select(*docs.columns)


@apart
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies: op5's links of fingerprints, and texts that share 4 / 5 of their shingles."""
    return simhash.first_of_each(docs, prints=True)


@apart
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@apart
def remove_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data; n_chars is that of the new text."""
    return pii.sanitise(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality", keep_quality), ("near_copies", drop_near_copies), ("decontamination", drop_benchmark),
    ("personal_data", remove_private), ("mix", mix),
]
# A learned classifier cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
