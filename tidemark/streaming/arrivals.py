"""Arriving articles: classify against the index, stage, then move the index on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import KEY
from tidemark.operators.diff import changed_only, classify_incoming
from tidemark.operators.ordering import latest_by_key
from tidemark.plans.tracking import fresh_for
from tidemark.sources import buckets
from tidemark.sources.tables import read_snapshot, write_snapshot


COMPACT_EVERY = 64  # epochs between two whole snapshots of the index


def index_after(spark: SparkSession, index_path: str, staged_path: str, epoch: int | None = None,
                compact_every: int = COMPACT_EVERY) -> DataFrame:
    """The index once ``epoch`` is done: a snapshot and the rows that the epochs since then have staged.

    Without ``epoch``, the first snapshot and all epochs there are.
    """
    base = -1 if epoch is None else (epoch + 1) // compact_every * compact_every - 1
    index = read_snapshot(spark, index_path, str(base)).select(*KEY, "metadata_hash")
    if epoch is not None and base >= epoch:
        return index
    folders = [staged_path] if epoch is None else [f"{staged_path}/epoch={e}" for e in range(base + 1, epoch + 1)]
    staged = spark.read.option("basePath", staged_path).parquet(*folders)
    rows = staged.select(*KEY, "metadata_hash", "epoch").unionByName(index.withColumn("epoch", F.lit(base)))
    return latest_by_key(rows, KEY, F.col("epoch")).drop("epoch")


def classify_epoch(spark: SparkSession, index_path: str, staged_path: str, initial: DataFrame,
                   compact_every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over rows ``type_key, id, metadata_hash, ts``.

    An epoch writes only the rows it stages; they are the index's delta. Every ``compact_every`` epochs the
    index is written whole. A replayed epoch reads what earlier ones have written, so it writes the same rows again.
    The index is narrow; its join with the batch spreads by article key.
    """
    write_snapshot(initial.select(*KEY, "metadata_hash"), index_path, "-1")

    def run(batch: DataFrame, epoch: int) -> None:
        index = index_after(spark, index_path, staged_path, epoch - 1, compact_every)
        latest = latest_by_key(batch, KEY, F.col("ts"))
        staged = changed_only(classify_incoming(latest, index))
        staged.write.mode("overwrite").parquet(f"{staged_path}/epoch={epoch}")
        if (epoch + 1) % compact_every == 0:
            rows = spark.read.parquet(f"{staged_path}/epoch={epoch}").select(*KEY, "metadata_hash")
            write_snapshot(index.join(rows.select(*KEY), KEY, "left_anti").unionByName(rows), index_path, str(epoch))

    return run


def store_after(spark: SparkSession, store_path: str, epoch: int | None = None) -> DataFrame:
    """A consumer's store once ``epoch`` (or the last one) is done: of each key the row written last."""
    rows = spark.read.parquet(store_path)
    if epoch is not None:
        rows = rows.filter(F.col("epoch") <= epoch)
    last = rows.groupBy(*KEY).agg(F.max("epoch").alias("epoch"))
    return rows.join(last, [*KEY, "epoch"], "left_semi").drop("epoch")


def consume_epoch(spark: SparkSession, store_path: str, live: Callable[[], DataFrame],
                  initial: DataFrame) -> Callable[[DataFrame, int], None]:
    """A polling consumer as a ``foreachBatch`` function over new manifest rows.

    An epoch writes only the rows it upserts; to find them, only keys and hashes of the store are read.
    The stream's checkpoint remembers which manifests were processed. ``live`` is read anew
    for each batch, as it moves between runs.
    """
    initial.write.mode("overwrite").parquet(f"{store_path}/epoch=-1")

    def run(batch: DataFrame, epoch: int) -> None:
        fresh = fresh_for(store_after(spark, store_path, epoch - 1), batch, live())
        fresh.select(*initial.columns).write.mode("overwrite").parquet(f"{store_path}/epoch={epoch}")

    return run


def _base(epoch: int, compact_every: int) -> int:
    """The last epoch that the base holds once ``epoch`` is done; -1 is the initial store."""
    return (epoch + 1) // compact_every * compact_every - 1


def compacted_store(initial: DataFrame, path: str, epoch: int, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """The store once ``epoch`` is done: the base and the rows of the epochs since, of each key the last."""
    spark, base = initial.sparkSession, _base(epoch, compact_every)
    rows = buckets.read(initial, f"{path}/base", str(base)).drop("bucket")
    if base == epoch:
        return rows
    since = spark.read.option("basePath", f"{path}/delta").parquet(*[f"{path}/delta/epoch={e}" for e in range(base + 1, epoch + 1)])
    both = since.select(*initial.columns, "epoch").unionByName(rows.withColumn("epoch", F.lit(base)))
    return latest_by_key(both, KEY, F.col("epoch")).drop("epoch")


def consume_compacted(spark: SparkSession, path: str, live: Callable[[], DataFrame], initial: DataFrame,
                      compact_every: int = COMPACT_EVERY, many: int = buckets.BUCKETS) -> Callable[[DataFrame, int], None]:
    """The same consumer with a store that does not grow by the epoch.

    An epoch writes the rows it upserts as a delta. Every ``compact_every`` epochs the deltas are merged into a bucketed base, of which only the
    touched buckets are rewritten; then the deltas and commits before the base that is left are removed. So an epoch reads the base and at
    most ``compact_every`` deltas, and never more than twice as many are kept. A replayed epoch finds what it needs and writes the same again.
    """
    return _with_deltas(spark, path, lambda held, batch, _: fresh_for(held, batch, live()), initial, compact_every, many)


def _with_deltas(spark: SparkSession, path: str, fresh: Callable[[DataFrame, DataFrame, int], DataFrame], initial: DataFrame,
                 compact_every: int, many: int) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds ``fresh(held, batch, epoch)`` to a store of bucketed base and deltas."""
    buckets.create(initial, f"{path}/base", "-1", buckets=many)

    def run(batch: DataFrame, epoch: int) -> None:
        held = compacted_store(initial, path, epoch - 1, compact_every)
        found = fresh(held, batch, epoch).select(*initial.columns)
        found.write.mode("overwrite").parquet(f"{path}/delta/epoch={epoch}")
        base = _base(epoch - 1, compact_every)
        if _base(epoch, compact_every) == epoch:
            since = spark.read.option("basePath", f"{path}/delta").parquet(*[f"{path}/delta/epoch={e}" for e in range(base + 1, epoch + 1)])
            rows = latest_by_key(since, KEY, F.col("epoch")).select(*initial.columns)
            buckets.upsert(f"{path}/base", str(base), str(epoch), rows, buckets=many)
            buckets.keep_commits(spark, f"{path}/base", [str(base), str(epoch)])
            for old in buckets.folders(spark, f"{path}/delta", "epoch"):
                if int(old) <= base:
                    buckets.remove(spark, f"{path}/delta/epoch={old}")

    return run


VERSION = "type_key string, id string, seen boolean"


def deliver_once(spark: SparkSession, path: str, version: tuple[str, ...] = ("id", "content_hash"), compact_every: int = COMPACT_EVERY,
                 many: int = buckets.BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each version of an article once, to ``out`` below ``path``, with no state in the stream.

    What the stream would have to remember for ever lies in an index of delivered versions: a bucketed base and the deltas of the last epochs, which are
    removed once the base holds them. An epoch reads that index (a narrow row a version) instead of keeping it in its executors' memory, so it suits
    few large epochs rather than many small ones. Of rows of one version in one epoch the one with the least ``ts`` is written; which epoch
    a version comes in, and how late, does not matter.
    """
    # A version is a key of its own for the base, whose key is (type_key, id); nulls are values.
    whole = F.to_json(F.struct("type_key", *version), {"ignoreNullFields": "false"})
    key = [F.coalesce("type_key", F.lit("")).alias("type_key"), whole.alias("id")]

    def deliver(held: DataFrame, batch: DataFrame, epoch: int) -> DataFrame:
        rows = batch.select(*key, F.struct(*batch.columns).alias("_whole"))
        first = latest_by_key(rows, KEY, F.coalesce("_whole.ts", F.timestamp_micros(F.lit(0))), newest=False)
        folder = f"{path}/out/epoch={epoch}"
        first.join(held.select(*KEY), KEY, "left_anti").select("_whole.*").write.mode("overwrite").parquet(folder)
        return spark.read.schema(batch.schema).parquet(folder).select(*key, F.lit(True).alias("seen"))

    return _with_deltas(spark, f"{path}/index", deliver, spark.createDataFrame([], VERSION), compact_every, many)
