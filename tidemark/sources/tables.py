"""Where the zones live.

``versions`` holds every document once, append-only, partitioned by ``run_date``. ``state``
is the narrow table of all zones: key, zone, hashes and the version it points at. A run
appends the documents it staged and writes one new ``state`` snapshot; bodies are never
rewritten and archived versions stay where they are. Snapshots are partitions named by the
run, and a run counts once its row is in ``runs``, which is written last. A retried run
overwrites its own partitions and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import KEY


def _overwrite_partition(df: DataFrame, path: str, *by: str) -> None:
    # Rebalance gathers the rows of a partition and splits the large ones by size, so a type
    # with a third of the corpus gets as many files as it needs.
    (
        df.hint("rebalance", *by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    )


def append_versions(df: DataFrame, path: str) -> None:
    """Write a run's documents. ``run_date`` must be a column; a retry replaces that run only."""
    _overwrite_partition(df, path, "run_date", "type_key")


def write_snapshot(df: DataFrame, path: str, run_id: str) -> None:
    """One snapshot partition; written as it lies, as all rows share the partition."""
    df.withColumn("snapshot", F.lit(run_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("snapshot").parquet(path)


def read_snapshot(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("snapshot") == run_id).drop("snapshot")


def write_articles(df: DataFrame, path: str) -> None:
    """Articles by type; a large type is split over files by size."""
    df.hint("rebalance", "type_key").write.mode("overwrite").partitionBy("type_key").parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int) -> None:
    """A table bucketed and sorted by the key: diffs against it need no shuffle of this side."""
    df.write.mode("overwrite").bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(table)


def documents_of(state: DataFrame, versions: DataFrame) -> DataFrame:
    """The documents a (small) set of state rows points at; ``run_date`` prunes the scan."""
    return versions.join(state.select(*KEY, "run_date", "content_hash"),
                         [*KEY, "run_date", "content_hash"], "left_semi")
