"""Exact quantiles of windows of any size, by counts in nested bins.

The stream counts rows per window and bin of the value's logarithm. A window has a bounded number of bins (64 an octave, about 2,600 between a microsecond and
a month in milliseconds), so the state does not depend on the rows, and a hot window's rows are summed before they are shuffled. The bin that holds the wanted
rank is known from the counts; a batch pass then narrows it to one of 1,024 finer bins and to the value, reading the landed rows of that bin only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage
from tidemark.streaming.jobs import ALARM_PERIOD, LATENESS

OCTAVE, FINER = 64, 1024
# Doubles have octaves from -1074 to 1024; bins of both signs and zero are kept apart by this distance.
_SPAN = 2048 * OCTAVE * FINER


def fine_bin(value: Column) -> Column:
    """A bin that never falls while the value rises. Zeros are one bin, as are NaN, which are above all."""
    octaves = lambda v: F.floor(F.log2(v) * (OCTAVE * FINER))
    return (
        F.when(F.isnan(value), 3 * _SPAN).when(value == 0, 0)
        .when(value == float("inf"), 2 * _SPAN).when(value == float("-inf"), -2 * _SPAN)
        .when(value > 0, octaves(value) + _SPAN).when(value < 0, -octaves(-value) - _SPAN)
    ).cast("long")


def coarse_bin(fine: Column) -> Column:
    return F.floor(fine / FINER).cast("long")


def latency_bins(lines: DataFrame, value: str, period: str = ALARM_PERIOD, lateness: str | None = LATENESS) -> DataFrame:
    """Rows per window and coarse bin, of a stream (update mode) or, without ``lateness``, of a table. Null values do not count."""
    known = lines.filter(F.col(value).isNotNull())
    if lateness is not None:
        known = known.withWatermark("ts", lateness)
    counted = known.groupBy(F.window("ts", period), coarse_bin(fine_bin(F.col(value))).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), "bin", "n")


def _holding(counts: DataFrame, by: str) -> DataFrame:
    """Of each window the entry ``by`` in which the running number reaches ``rank``, and the rank within it."""
    up_to = F.sum("n").over(Window.partitionBy("window_start").orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_up", up_to).filter((F.col("_up") >= F.col("rank")) & (F.col("_up") - F.col("n") < F.col("rank")))
    return placed.withColumn("rank", F.col("rank") - (F.col("_up") - F.col("n"))).drop("_up", "n")


def exact_quantile(bins: DataFrame, lines: DataFrame, value: str, q: str, period: str = ALARM_PERIOD) -> DataFrame:
    """``window_start, value, n``: the least value that at least the share ``q`` (a decimal, as text) of the window's rows do not exceed.

    ``bins`` come from ``latency_bins``, ``lines`` are the landed rows they were counted from. Of ``lines`` only rows of the bins
    that hold a rank pass the first join, a table of one row a window.
    """
    spark = lines.sparkSession
    sizes = bins.groupBy("window_start").agg(F.sum("n").alias("size"))
    rank = F.greatest(F.ceil(F.lit(q).cast("decimal(9,8)") * F.col("size")).cast("long"), F.lit(1).cast("long"))
    first = _holding(bins.join(sizes.withColumn("rank", rank), "window_start"), "bin")
    wanted = cut_lineage(spark, first, "quantile_bins")
    rows = (
        lines.filter(F.col(value).isNotNull())
        .select(F.window("ts", period)["start"].alias("window_start"), F.col(value).alias("value"), fine_bin(F.col(value)).alias("fine"))
        .withColumn("bin", coarse_bin(F.col("fine")))
    )
    # Values of the bin with their counts; copies of a value are one row from here on.
    values = cut_lineage(
        spark, rows.join(wanted.select("window_start", "bin"), ["window_start", "bin"], "left_semi")
        .groupBy("window_start", "fine", "value").agg(F.count(F.lit(1)).alias("n")), "quantile_values")
    finer = values.groupBy("window_start", "fine").agg(F.sum("n").alias("n")).join(wanted.drop("bin"), "window_start")
    second = _holding(finer, "fine")
    return _holding(values.join(second, ["window_start", "fine"]), "value").select("window_start", "value", F.col("size").alias("n"))
