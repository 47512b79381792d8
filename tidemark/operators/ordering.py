"""Latest-per-key, numbering and top-n per group that hold when one key owns a third of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: Column, newest: bool = True) -> DataFrame:
    """One row per key: the one with the greatest (or smallest) ``order``.

    An aggregate, not a window: each task first keeps one row per key, so a hot key
    sends one row per task over the network instead of all its rows.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if newest else F.min_by
    out = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return out.select(*keys, "_row.*").select(*df.columns)


def numbered(
    df: DataFrame, keys: list[str], order: list[Column], bucket: Column, name: str
) -> DataFrame:
    """Add the 1-based position of a row within its key, as ``row_number`` would.

    ``bucket`` is any value that grows with ``order``. Rows are numbered within
    (key, bucket); the sizes of the earlier buckets of the key are added. So the rows
    of one hot key are spread over its buckets, and only one count per bucket meets
    in a window. Keys and bucket must not be null. The rows are shuffled once: the join
    uses the partitioning of the window.
    """
    b = df.withColumn("_bucket", bucket)
    local = b.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        b.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    joined = local.join(offsets, [*keys, "_bucket"]).select(*local.columns, "_offset")
    return joined.withColumn(name, F.col("_local") + F.col("_offset")).drop("_bucket", "_local", "_offset")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per key. Spark keeps at most ``n`` rows per key in each task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def newest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Newest-first list with a cap (the feature of the list views)."""
    return df.orderBy(*order).limit(n)


def page_size(size: int, max_size: int | None) -> int:
    size = max(1, int(size or 50))
    return min(size, max_size) if max_size else size


def page(df: DataFrame, order: list[Column], number: int, size: int, max_size: int | None = None) -> DataFrame:
    """One page of an ordered listing; ``size`` is at least 1 and at most ``max_size`` if given, ``number`` 1 and up."""
    size = page_size(size, max_size)
    number = max(1, int(number or 1))
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_within(df: DataFrame, order: list[Column], number: int, size: int, max_size: int | None = None) -> DataFrame:
    """The same, but a number past the end shows the last page; this counts the rows first."""
    size = page_size(size, max_size)
    pages = max(1, -(-df.count() // size))
    return page(df, order, max(1, min(int(number), pages)), size, max_size)


def page_info(df: DataFrame, size: int, max_size: int | None = None) -> DataFrame:
    """Total rows and pages of the same listing; reads no columns beyond the filters."""
    size = page_size(size, max_size)
    return df.agg(F.count(F.lit(1)).alias("total")).select(
        "total",
        F.greatest(F.ceil(F.col("total") / size), F.lit(1)).cast("bigint").alias("pages"),
    )
