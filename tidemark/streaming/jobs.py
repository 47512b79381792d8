"""Sources, windows and sinks of the streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.session import scratch_dir

# How far back late rows are accepted, and the alarm periods and threshold.
LATENESS = "48 hours"
COUNT_PERIOD = "5 minutes"
ALARM_PERIOD = "15 minutes"
P99_LIMIT_MS = 2500


def json_source(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Growing manifests and trails as a stream of lines."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def parquet_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream; the schema is that of the files."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A stream takes folders only, but a glob may also match one file; this one matches this very name.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def metric_windows(points: DataFrame, period: str = COUNT_PERIOD, lateness: str = LATENESS) -> DataFrame:
    """Tumbling counts per metric and dimension."""
    return (
        points.withWatermark("ts", lateness)
        .groupBy(F.window("ts", period), "metric", "dim")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "metric", "dim", "n")
    )


def error_alarms(lines: DataFrame, period: str = ALARM_PERIOD, lateness: str = LATENESS) -> DataFrame:
    """Windows with at least one error, all sources together."""
    return (
        lines.filter(F.col("level") == "ERROR")
        .withWatermark("ts", lateness)
        .groupBy(F.window("ts", period))
        .agg(F.count(F.lit(1)).alias("errors"))
        .filter(F.col("errors") > 0)
        .select(F.col("window.start").alias("window_start"), "errors")
    )


def latency_p99(lines: DataFrame, action: str, period: str = ALARM_PERIOD, lateness: str = LATENESS,
                accuracy: int = 10000) -> DataFrame:
    """99th percentile of the duration per window; the sketch keeps state small.

    It is exact up to about ``accuracy`` rows a window; beyond, the rank is off by at most a share of 1 / ``accuracy``.
    """
    return (
        lines.filter(F.col("action") == action)
        .withWatermark("ts", lateness)
        .groupBy(F.window("ts", period))
        .agg(F.percentile_approx("duration_ms", 0.99, accuracy).alias("p99"), F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "p99", "n")
    )


def p99_alarms(p99: DataFrame, limit_ms: float = P99_LIMIT_MS) -> DataFrame:
    return p99.filter(F.col("p99") > limit_ms)


def recent_counts(lines: DataFrame, length: str = "60 minutes", slide: str = "10 minutes",
                  lateness: str = LATENESS) -> DataFrame:
    """Sliding windows behind the 'last N minutes' views."""
    return (
        lines.withWatermark("ts", lateness)
        .groupBy(F.window("ts", length, slide), "action")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "action", "n")
    )


def drop_redeliveries(rows: DataFrame, keys: list[str] = ("type_key", "id", "content_hash"),
                      lateness: str | None = None) -> DataFrame:
    """Deliver each version of an article once, whatever the batches are.

    The state holds one key per version, as the hash index does. With ``lateness`` it is dropped after that
    time, and a version sent again later passes again.
    """
    if lateness is None:
        return rows.dropDuplicates(list(keys))
    return rows.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(list(keys))


def run_counters(records: DataFrame) -> DataFrame:
    """Running counts per run and type while the run is on (update or complete mode).

    The state is one row per (run, type), a few dozen a run, and is kept: a late line still counts.
    """
    n = lambda op: F.count_if(F.col("op") == op)
    return records.groupBy("run_date", "type_key").agg(
        n("new").alias("new"), n("changed").alias("changed"), n("unchanged").alias("unchanged")
    )


def run_available(stream: DataFrame, spark: SparkSession, name: str, mode: str = "append",
                  keys: list[str] | None = None) -> DataFrame:
    """Process all that is there, then return the result table.

    Each epoch overwrites its own folder, so a replayed epoch changes nothing. In update
    mode later epochs replace rows of the same ``keys``.
    """
    base = scratch_dir(spark, name)
    out = f"{base}/out"

    ran = []

    def store(batch: DataFrame, epoch: int) -> None:
        ran.append(epoch)
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint")
        .foreachBatch(store).trigger(availableNow=True).queryName(name).start()
    )
    query.awaitTermination()
    schema = StructType([*stream.schema.fields, StructField("epoch", IntegerType())])
    if not ran:  # nothing has arrived, so there is no folder yet
        return spark.createDataFrame([], stream.schema)
    table = spark.read.schema(schema).parquet(out)
    if mode != "update" or not keys:
        return table.drop("epoch")
    rest = [c for c in stream.columns if c not in keys]
    last = table.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_row"))
    return last.select(*keys, "_row.*").select(*stream.columns)


def at(ts: Column) -> Column:
    """Event time as the type a watermark accepts."""
    return ts.cast("timestamp")
