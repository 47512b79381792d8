"""State tables that change bucket by bucket, each commit with its hash tree.

Rows lie in buckets by a hash of their key. A commit writes the buckets it touches, whole, under its own name, and then a pointer table: for each bucket
and type the commit that holds its rows, their number, and a digest. The pointer table is written last and makes the commit; buckets that were not touched are pointed
at where they lie. Files are never changed, so readers of older commits are not disturbed, and a commit that is run again overwrites
its own folders only.

Digests are order-free sums of row hashes, so the pointer table is the lowest level of a hash tree whose upper levels, per type and in all, are sums of
it. Two commits are compared from the top: types whose sums agree are left out, then buckets; only what differs is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.operators import KEY, diff, zones
from tidemark.session import cut_lineage

BUCKETS = 128  # so many that a bucket of the state at hand is a file or a few; more for more rows
DIGEST = ["n", "one", "two"]


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def _schema(rows: DataFrame) -> StructType:
    return StructType([*rows.schema.fields, StructField("bucket", IntegerType())])


def row_hash(columns: list[str], salt: int) -> Column:
    """A hash of key and columns; hashing passes over nulls, so their places are hashed too."""
    return F.xxhash64(F.lit(salt), *KEY, *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def leaves(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Number of rows and two sums of row hashes, 128 bits together, per bucket and type."""
    wide = lambda salt: F.sum(row_hash(columns, salt).cast("decimal(20,0)"))
    return rows.groupBy("bucket", "type_key").agg(F.count("*").alias("n"), wide(1).alias("one"), wide(2).alias("two"))


def fold(found: DataFrame, *by: str) -> DataFrame:
    """An upper level of the tree: per type, or in all."""
    return found.groupBy(*by).agg(*[F.sum(c).alias(c) for c in DIGEST])


def _commit(rows: DataFrame, path: str, commit: str, buckets: int, columns: list[str], kept: DataFrame | None = None) -> None:
    spark, folder = rows.sparkSession, f"{path}/data/commit={commit}"
    rows.withColumn("bucket", bucket_of(buckets)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
    found = leaves(spark.read.schema(_schema(rows)).parquet(folder), columns).select("bucket", "type_key", *DIGEST, F.lit(commit).alias("data"))
    if kept is not None:
        found = found.unionByName(kept)
    found.write.mode("overwrite").parquet(f"{path}/pointers/commit={commit}")


def create(rows: DataFrame, path: str, commit: str, compared: list[str] | None = None, buckets: int = BUCKETS) -> None:
    """The first commit, of all ``rows``. ``compared`` names the columns whose change is a change of the row; all others than the key by default."""
    _commit(rows, path, commit, buckets, compared or [c for c in rows.columns if c not in KEY])


def pointers(spark: SparkSession, path: str, commit: str) -> DataFrame:
    return spark.read.parquet(f"{path}/pointers/commit={commit}")


def read(rows_like: DataFrame, path: str, commit: str, only: DataFrame | None = None) -> DataFrame:
    """The rows of a commit, with their bucket; with ``only`` (bucket, type_key) those of its buckets and types, and no other bucket's files.

    ``rows_like`` gives session and columns. At most one folder name per bucket reaches the driver.
    """
    spark = rows_like.sparkSession
    found = pointers(spark, path, commit)
    if only is not None:
        found = found.join(only, ["bucket", "type_key"], "left_semi")
    folders = [f"{path}/data/commit={r['data']}/bucket={r['bucket']}" for r in found.select("bucket", "data").distinct().collect()]
    if not folders:
        return spark.createDataFrame([], _schema(rows_like))
    rows = spark.read.schema(_schema(rows_like)).option("basePath", f"{path}/data").parquet(*folders).select(*rows_like.columns, "bucket")
    return rows if only is None else rows.join(only, ["bucket", "type_key"], "left_semi")


def upsert(path: str, base: str, commit: str, incoming: DataFrame, gone: DataFrame | None = None,
           compared: list[str] | None = None, buckets: int = BUCKETS) -> None:
    """Make ``commit`` of ``base``: incoming rows replace rows of their keys or join them, keys of ``gone`` leave. Only their buckets are read and written.

    Keys of ``incoming`` are unique. The number of buckets and the compared columns are those of ``create``.
    """
    spark = incoming.sparkSession
    incoming = cut_lineage(spark, incoming, "incoming")
    keys = incoming.select(*KEY)
    if gone is not None:
        gone = cut_lineage(spark, gone.select(*KEY).distinct(), "gone")
        keys = keys.unionByName(gone)
    touched = keys.select(bucket_of(buckets).alias("bucket")).distinct()
    found = pointers(spark, path, base)
    old = read(incoming, path, base, found.join(touched, "bucket", "left_semi").select("bucket", "type_key").distinct()).drop("bucket")
    rows = zones.upsert_in_place(old, incoming)
    if gone is not None:
        rows = zones.drop_keys(rows, gone)
    kept = found.join(touched, "bucket", "left_anti").select("bucket", "type_key", *DIGEST, "data")
    _commit(rows.select(*incoming.columns), path, commit, buckets, compared or [c for c in incoming.columns if c not in KEY], kept)


def _unlike(one: DataFrame, two: DataFrame, by: list[str]) -> DataFrame:
    left = one.select(*by, *[F.col(c).alias(f"_{c}") for c in DIGEST])
    same = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in DIGEST]
    return left.join(two.select(*by, *DIGEST), by, "full_outer").filter(~(same[0] & same[1] & same[2])).select(*by)


def differing(spark: SparkSession, path: str, before: str, after: str) -> DataFrame:
    """(bucket, type_key) whose rows differ between two commits: types first, then the buckets of those types."""
    one, two = pointers(spark, path, before), pointers(spark, path, after)
    types = _unlike(fold(one, "type_key"), fold(two, "type_key"), ["type_key"])
    return _unlike(*(x.join(types, "type_key", "left_semi") for x in (one, two)), ["bucket", "type_key"])


def tree_diff(tracked_like: DataFrame, current_like: DataFrame, path: str, before: str, after: str, run_id: Column) -> tuple[DataFrame, DataFrame]:
    """(snapshot diff of the buckets and types that differ, those buckets and types). Rows outside them are unchanged and not read."""
    spark = tracked_like.sparkSession
    marked = cut_lineage(spark, differing(spark, path, before, after), "differing")
    tracked, current = (read(like, path, commit, marked).drop("bucket") for like, commit in ((tracked_like, before), (current_like, after)))
    return diff.snapshot_diff(tracked, current, run_id), marked


def tree_summary(delta: DataFrame, marked: DataFrame, path: str, after: str) -> DataFrame:
    """Counts per type as ``track_summary`` has them; rows that were not read are counted from the tree."""
    rest = pointers(delta.sparkSession, path, after).join(marked, ["bucket", "type_key"], "left_anti").groupBy("type_key").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")
    same = rest.select("type_key", F.col("n").alias("scanned"), zero.alias("new"), zero.alias("changed"), F.col("n").alias("unchanged"), zero.alias("removed"))
    both = diff.track_summary(delta).unionByName(same)
    return both.groupBy("type_key").agg(*[F.sum(c).alias(c) for c in both.columns if c != "type_key"])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, in whatever store the path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of the ``name=`` folders below a path, one per commit or epoch."""
    parent = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath().getName() for f in store.listStatus(parent)] if store.exists(parent) else []
    return [f.partition("=")[2] for f in found if f.startswith(f"{name}=")]


def keep_commits(spark: SparkSession, path: str, commits: list[str]) -> None:
    """Forget all other commits: their pointers go, and the data that no kept commit points at, bucket by bucket."""
    used = set()
    for commit in commits:
        used |= {(r["data"], str(r["bucket"])) for r in pointers(spark, path, commit).select("data", "bucket").distinct().collect()}
    for commit in set(folders(spark, f"{path}/pointers", "commit")) - set(commits):
        remove(spark, f"{path}/pointers/commit={commit}")
    for commit in folders(spark, f"{path}/data", "commit"):
        own = folders(spark, f"{path}/data/commit={commit}", "bucket")
        kept = [b for b in own if (commit, b) in used]
        if not kept and commit not in commits:
            remove(spark, f"{path}/data/commit={commit}")
            continue
        for bucket in set(own) - set(kept):
            remove(spark, f"{path}/data/commit={commit}/bucket={bucket}")
