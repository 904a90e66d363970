"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings every operator in this package assumes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "lakeshore",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without it gets a private folder; on a cluster executors could not share
    one, so its absence is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lakeshore-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/lakeshore-work/{name}-{uuid.uuid4().hex[:12]}"


def sweep_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete work folders that were made at least so long ago (results that
    read them must have been written by then). Returns how many."""
    probe = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, "probe"))
    work, fs = probe.getParent(), probe.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(work):
        return 0
    before = (time.time() - 3600 * older_than_hours) * 1000
    old = [s.getPath() for s in fs.listStatus(work) if s.getModificationTime() < before]
    for path in old:
        fs.delete(path, True)
    return len(old)


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders of many small files are listed by a few tasks a core, each of
    many folders. Left alone Spark makes a task of each folder, up to 10,000,
    and starting these costs far more than the listing."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(max(1, min(int(before), 4 * spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few places that need a plain path."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_dir", "sweep_scratch", "few_listing_tasks", "local_path", "BASE_CONF"]
