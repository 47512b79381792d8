"""Session settings the package relies on, and where scratch tables go."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results (time zone) or that keep a plan safe at scale.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Deep pages sort across the cluster instead of in one driver-side heap.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    # Aggregates with a bounded number of groups (types x fields) stay in the hash map.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "10000",
    # HTML pages are wide rows: keep an Arrow batch small, by rows and by bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package's settings. Sizes (memory, partitions) stay with the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_base() -> str:
    """One temporary folder of a local run, removed when the process ends."""
    base = tempfile.mkdtemp(prefix="spark-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(spark: SparkSession, df, name: str):
    """Write ``df`` as a table in the shared folder and read it back.

    Used where a frame feeds several outputs: the table survives lost executors,
    so nothing upstream is computed twice.
    """
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

