"""Windows that survive late rows: a side path for them in the same epoch, and a batch back-stop that counts exactly their windows again.

A stateful window forgets what lies behind the watermark and drops rows that come for it later. Here the rows travel next to the windows in one query. Each
epoch writes the windows that changed and, beside them, the rows whose window the watermark had passed; the clock it judges by is the latest event time of
earlier epochs, kept in a table, so a replayed epoch finds the same rows. The clock is never behind Spark's own watermark: no dropped row is missed, and a row that
was both counted and set aside does no harm, as the back-stop counts whole windows again and adds nothing to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.operators.ordering import latest_by_key
from tidemark.sources import buckets
from tidemark.streaming.jobs import COUNT_PERIOD, LATENESS


def windows_with_rows(rows: DataFrame, keys: list[str], aggs: list[Column], period: str = COUNT_PERIOD, lateness: str = LATENESS) -> DataFrame:
    """The stream of windows (``value`` holds the aggregates) and, next to it, that of the plain rows (``ts``), for ``store_epoch``.

    Rows without an event time belong to no window.
    """
    timed = rows.withWatermark("ts", lateness)
    groups = timed.groupBy(F.window("ts", period), *keys).agg(F.struct(*aggs).alias("value"))
    place = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys]
    plain = timed.select("ts", F.window("ts", period).alias("window"), *keys)
    kind = groups.schema["value"].dataType
    return groups.select(F.lit("window").alias("kind"), *place, "value", F.lit(None).cast("timestamp").alias("ts")).unionByName(
        plain.select(F.lit("late").alias("kind"), *place, F.lit(None).cast(kind).alias("value"), "ts")
    )


def _clock(spark: SparkSession, path: str, epoch: int):
    """The latest event time up to ``epoch``, in microseconds; none before the first."""
    return None if epoch < 0 else spark.read.schema("latest long").parquet(f"{path}/clock/epoch={epoch}").first()["latest"]


def store_epoch(spark: SparkSession, path: str, lateness: str = LATENESS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over ``windows_with_rows``: one write of windows and late rows, then the clock."""

    def run(batch: DataFrame, epoch: int) -> None:
        before, seen = _clock(spark, path, epoch - 1), Observation()
        limit = F.timestamp_micros(F.lit(before).cast("long")) - F.expr(f"INTERVAL {lateness}")
        kept = (F.col("kind") == "window") | F.coalesce(F.col("window_end") <= limit, F.lit(False))
        found = batch.observe(seen, F.max(F.unix_micros("ts")).alias("latest")).filter(kept)
        found.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/found/epoch={epoch}")
        latest = max((t for t in (before, seen.get["latest"]) if t is not None), default=None)
        spark.createDataFrame([(latest,)], "latest long").coalesce(1).write.mode("overwrite").parquet(f"{path}/clock/epoch={epoch}")

    return run


def _found(spark: SparkSession, path: str, schema: StructType, kind: str) -> DataFrame:
    whole = StructType([*schema.fields, StructField("epoch", IntegerType())])
    if not buckets.folders(spark, f"{path}/found", "epoch"):  # nothing has arrived
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(f"{path}/found").filter(F.col("kind") == kind)


def late_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The repair table: rows that came behind the watermark, with window, keys and epoch."""
    return _found(spark, path, schema, "late").drop("kind", "value")


def repair(spark: SparkSession, path: str, schema: StructType, full: DataFrame, keys: list[str], aggs: list[Column], upto: int,
           after: int = -1, period: str = COUNT_PERIOD) -> DataFrame:
    """The back-stop: windows that got late rows in the epochs after ``after`` up to ``upto`` are aggregated again from ``full``.

    Only those groups are read from ``full`` past the semi-join; they are written under ``upto``, so a second run writes the same again.
    """
    place = ["window_start", *keys]
    late = late_rows(spark, path, schema).filter((F.col("epoch") > after) & (F.col("epoch") <= upto))
    touched = f"{path}/touched/upto={upto}"
    late.select(*place).distinct().write.mode("overwrite").parquet(touched)
    rows = full.withColumn("window_start", F.window("ts", period)["start"])
    again = _same_group(rows, spark.read.schema(StructType([schema[c] for c in place])).parquet(touched), place, "left_semi")
    out = again.groupBy(*place).agg(F.struct(*aggs).alias("value"))
    out.write.mode("overwrite").parquet(f"{path}/repaired/upto={upto}")
    return spark.read.schema(out.schema).parquet(f"{path}/repaired/upto={upto}")


def _same_group(left: DataFrame, right: DataFrame, place: list[str], how: str) -> DataFrame:
    """A join on groups in which a null key is a key."""
    right = right.select(*[F.col(c).alias(f"_{c}") for c in place])
    same = F.lit(True)
    for c in place:
        same = same & left[c].eqNullSafe(right[f"_{c}"])
    return left.join(right, same, how)


def windows_after(spark: SparkSession, path: str, schema: StructType, keys: list[str], upto: list[int] = ()) -> DataFrame:
    """Each group as it was written last; a repair named in ``upto`` comes after the epochs it covers."""
    place = ["window_start", *keys]
    rows = _found(spark, path, schema, "window").select(*place, "value", (F.col("epoch") * 2).alias("turn"))
    kind = StructType([schema[c] for c in (*place, "value")])
    for e in upto:
        fixed = spark.read.schema(kind).parquet(f"{path}/repaired/upto={e}")
        rows = rows.unionByName(fixed.withColumn("turn", F.lit(2 * e + 1)))
    return latest_by_key(rows, place, F.col("turn")).select(*place, "value.*")
