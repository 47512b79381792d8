"""Ordered listings with a directory, so that any page opens one or two of their ranges.

A listing is sorted once: rows are dealt by ranges of the order, each range is written as a folder with its rows' places, and a directory keeps how many
rows each range has. A page then knows from the directory which ranges it lies in, and reads those places only: no sort, no offset, no count, and the
last page costs what the first does. The order should be total; rows equal in it keep the places they got when the listing was written.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordering import page_size

PLACES = 1 << 33  # of one task in a running id


def write_listing(df: DataFrame, path: str, order: list[Column], ranges: int | None = None) -> None:
    """Write ``df`` in ``order``. The directory is written last; a listing is there once it is. A retry writes the folder anew."""
    many = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(many, *order).withColumn("range", F.spark_partition_id()).sortWithinPartitions("range", *order)
    placed = dealt.withColumn("place", F.monotonically_increasing_id() % PLACES)
    placed.write.mode("overwrite").partitionBy("range").parquet(f"{path}/rows")
    sizes = df.sparkSession.read.parquet(f"{path}/rows").groupBy("range").agg(F.count("*").alias("n")) if placed_any(df.sparkSession, path) else (
        df.sparkSession.createDataFrame([], "range int, n long"))
    sizes.write.mode("overwrite").parquet(f"{path}/directory")


def placed_any(spark: SparkSession, path: str) -> bool:
    """Whether any row was written: an empty listing has no range folder, and so no schema to read."""
    return bool(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{path}/rows").select("path").head(1))


def directory(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(range, rows) by range: as many rows as the listing has ranges."""
    return [(r["range"], r["n"]) for r in spark.read.parquet(f"{path}/directory").orderBy("range").collect()]


def listing_page(like: DataFrame, path: str, number: int, size: int, max_size: int | None = None, within: bool = False) -> DataFrame:
    """A page of the listing, in order. ``like`` gives session and columns; with ``within`` a number past the end shows the last page."""
    spark, size = like.sparkSession, page_size(size, max_size)
    known = directory(spark, path)
    ends = list(accumulate(n for _, n in known))
    number = max(1, int(number or 1))
    if within:
        number = min(number, max(1, -(-(ends[-1] if ends else 0) // size)))
    start, stop = (number - 1) * size, number * size
    wanted = [(r, max(start - (end - n), 0), min(stop - (end - n), n)) for (r, n), end in zip(known, ends) if end > start and end - n < stop]
    if not wanted:
        return like.limit(0)
    rows = spark.read.option("basePath", f"{path}/rows").parquet(*[f"{path}/rows/range={r}" for r, _, _ in wanted])
    own = None
    for r, low, high in wanted:
        here = (F.col("range") == r) & (F.col("place") >= low) & (F.col("place") < high)
        own = here if own is None else own | here
    # At most a page of rows is sorted.
    return rows.filter(own).orderBy("range", "place").select(*like.columns)


def listing_info(spark: SparkSession, path: str, size: int, max_size: int | None = None) -> DataFrame:
    """Total rows and pages, from the directory."""
    size = page_size(size, max_size)
    total = spark.read.parquet(f"{path}/directory").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return total.select("total", F.greatest(F.ceil(F.col("total") / size), F.lit(1)).cast("bigint").alias("pages"))
