"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# A word: any run without blank or control white space.
WORD = r"[^\x20\x09-\x0D]+"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL check if there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Number of tasks for work whose size the optimiser cannot see (explodes, Python)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Used where a frame feeds several plans: it is computed once, survives lost executors, and
    Spark knows its size when it picks joins.
    """
    return cut_lineage(df.sparkSession, df, name)


def words_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def numbered(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """``df`` with ``name``, 1, 2, 3, ... in ``order``, without a window over all rows.

    Rows are dealt by ranges of the order and sorted; each task numbers its own rows, and the result is written, so that the ranges stay what they are.
    Then each range's first number is added: one row per task, which bounds what is broadcast. Rows equal in ``order`` get numbers in any order.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = [pa.array(np.full(batch.num_rows, task)), pa.array(np.arange(at + 1, at + 1 + batch.num_rows))]
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, "_task", "_at"])

    many = partitions(df.sparkSession)
    schema = ", ".join([*[f"`{c}` {t}" for c, t in df.dtypes], "_task long, _at long"])
    own = stored(df.repartitionByRange(many, *order).sortWithinPartitions(*order).mapInArrow(count, schema), "numbered")
    sizes = own.groupBy("_task").agg(F.max("_at").alias("n"))
    before = sizes.select("_task", (F.sum("n").over(Window.orderBy("_task")) - F.col("n")).alias("_before"))
    return own.join(F.broadcast(before), "_task").withColumn(name, F.col("_before") + F.col("_at")).drop("_task", "_at", "_before")
