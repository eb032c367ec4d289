"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Only the day partitions that a write touches are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state lives off-heap and on disk, so it may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Saved pages are large: bound an Arrow batch by bytes, not only by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "snapwatch", **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots.

    The number of shuffle partitions is left to the cluster's own default (AQE coalesces it).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables that one step writes and the next one reads.

    It lies below the shared folder the cluster names in ``spark.checkpoint.dir``, which tests and the bench set
    too. Only a local master without that setting gets a temporary folder, as all its tasks see the same disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="snapwatch-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ``work_dir`` that nothing reads any more; like dropping days it needs a classic session."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, what an action shuffled is deleted when the action ends, not when the driver's heap is next collected.

    For steps that hand on written or checkpointed rows: running the same DataFrame twice would shuffle again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
