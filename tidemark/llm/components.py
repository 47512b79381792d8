"""Connected components of a link table by alternating stars, one written table per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; the root is the smallest node it reaches. ``links``: columns a, b (long).

    A step hangs each node's larger neighbours on its smallest one, then each node's smaller neighbours likewise, until
    nothing moves. Minima are aggregates, so a node with very many links does not gather them in a task; its links are spread by
    the join that AQE may split. Nothing but a count and a sum reaches the driver.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(low.withColumnRenamed("m", "b")).distinct(), "links")
        now = _mark(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
