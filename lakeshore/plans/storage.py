"""Tables on plain files: versioned snapshots with a commit log (K1, K8),
defaults on insert (K2) and partition-wise upserts (K3 at scale).

Every write goes to a new folder of its own, ``<path>/attempt=<id>/``, and
becomes visible by one commit record in ``<path>/_commits/``, created whole and
exclusively (:mod:`lakeshore.plans.records`): of two writers that picked the
same version one fails and its folder is never read. A crash or a failed check
at any moment therefore leaves the committed table as it was, and the next
writer goes on: versions are numbered past every record, also one that can't be
read. Upserts that lose the race merge again into what the other committed.

Snapshot tables (full refresh) read the folder of the latest commit. Fact
tables are partitioned by day: a commit names the days its folder holds, and
the table is each day's folder of the latest commit that names it, so an
upsert writes only the days its batch touches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.operators.quality import gate
from lakeshore.operators.upsert import check_keys, upsert
from lakeshore.plans import records

COMMITS = "_commits"
SUMMARIES = "_summary"
# How often an upsert merges again after losing the race for a version.
COMMIT_ATTEMPTS = 20
COMMIT_SCHEMA = "version long, folder string, parts array<string>, note string"


class ConcurrentPublishError(RuntimeError):
    pass


def with_defaults(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """INSERT INTO t(cols) ...: columns the insert omits take their default
    (a literal or a Column such as the run timestamp), others NULL; the
    result is in schema order and schema types."""
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
        elif f.name in defaults:
            d = defaults[f.name]
            c = d if isinstance(d, Column) else F.lit(d)
        else:
            c = F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def _try_read(spark: SparkSession, reader: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return reader()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def committed_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """The commit log: version, folder, parts (the days it holds; NULL for a
    snapshot), note."""
    return _try_read(spark, lambda: spark.read.schema(COMMIT_SCHEMA).option("mode", "DROPMALFORMED")
                     .json(f"{path}/{COMMITS}"))


def current_version(spark: SparkSession, path: str) -> int | None:
    log = committed_versions(spark, path)
    return None if log is None else log.agg(F.max("version")).first()[0]


def next_version(spark: SparkSession, path: str) -> int:
    """The version a writer may commit that has yet to read the table: if it
    is taken by the time of the commit, the table has changed since."""
    return records.next_number(spark, f"{path}/{COMMITS}")


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The latest committed snapshot, or None."""
    log = committed_versions(spark, path)
    folder = None if log is None else log.agg(F.max_by("folder", "version")).first()[0]
    if folder is None:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/{folder}")


def read_parts(spark: SparkSession, path: str, schema: T.StructType, only: Sequence | None = None) -> DataFrame:
    """A day-partitioned table as committed (empty if absent); ``only`` limits
    it to these partition values. One path per day reaches the driver."""
    log = committed_versions(spark, path)
    if log is None:
        return spark.createDataFrame([], schema)
    days = log.select("version", "folder", F.explode("parts").alias("part")).groupBy("part").agg(
        F.max_by("folder", "version").alias("folder"))
    if only is not None:
        days = days.where(F.col("part").isin([str(v) for v in only]))
    name = schema.fields[-1].name
    folders = [f"{path}/{r['folder']}/{name}={r['part']}" for r in days.collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])
    return spark.read.schema(stored).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def read_summary(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str]) -> DataFrame:
    """(``by``, partition, rows) of a day-partitioned table as committed, from
    what its upserts counted; from the rows themselves if any did not."""
    name = schema.fields[-1].name
    log = committed_versions(spark, path)
    kept = T.StructType([*(schema[c] for c in by), schema[name], T.StructField("rows", T.LongType()),
                         T.StructField("folder", T.StringType())])
    if log is None:
        return spark.createDataFrame([], kept).drop("folder")
    days = log.select("version", "folder", F.explode("parts").alias("_part")).groupBy("_part").agg(
        F.max_by("folder", "version").alias("folder"))
    folders = sorted(r[0] for r in days.select("folder").distinct().collect())
    told = _try_read(spark, lambda: spark.read.schema(kept).parquet(*(f"{path}/{SUMMARIES}/{f}" for f in folders)))
    if told is None:
        return read_parts(spark, path, schema).groupBy(*by, name).agg(F.count(F.lit(1)).alias("rows"))
    # A row a day: each day counts in its latest folder only.
    return told.join(F.broadcast(days), (told["folder"] == days["folder"]) & (
        F.col(name).cast("string") == F.col("_part")), "left_semi").drop("folder")


def parts_since(spark: SparkSession, path: str, version: int = 0) -> list[str]:
    """The days that commits after ``version`` wrote (what a refresh that saw
    ``version`` has yet to see)."""
    log = committed_versions(spark, path)
    if log is None:
        return []
    return sorted(r[0] for r in log.where(F.col("version") > version).select(F.explode("parts")).distinct().collect())


def _new_folder() -> str:
    return f"attempt=a{uuid.uuid4().hex}"


def _commit(spark: SparkSession, path: str, version: int, folder: str, note: str = "",
            parts: Sequence[str] | None = None) -> None:
    """Make ``folder`` visible: one small record whose name is the version."""
    record = json.dumps({"version": version, "folder": folder, "parts": parts, "note": note})
    if not records.create(spark, f"{path}/{COMMITS}", f"{version:09d}.json", record):
        raise ConcurrentPublishError(f"{path}: version {version} was committed by another writer")


def _discard(spark: SparkSession, path: str, folder: str) -> None:
    lost = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
    lost.getFileSystem(spark._jsc.hadoopConfiguration()).delete(lost, True)


def _write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    folder = _new_folder()
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/{folder}")
    return folder


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), note: str = "",
                  version: int | None = None) -> int:
    """Full refresh (DROP/CREATE/INSERT or TRUNCATE/INSERT): write a new
    folder, then commit it. Readers of the old version are not disturbed. A
    table made from its own last version passes the :func:`next_version` it
    asked for before reading, so that it can't undo another writer's commit."""
    spark = df.sparkSession
    v = version or next_version(spark, path)
    _commit(spark, path, v, _write_snapshot(df, path, partition_by), note)
    return v


def publish(df: DataFrame, path: str, checks: Callable[[DataFrame], DataFrame],
            partition_by: Sequence[str] = (), note: str = "") -> int:
    """All-or-nothing publish: write a new folder, run ``checks`` on what was
    written (a report with a ``passed`` column), commit only if every check
    passed; otherwise raise QualityError with the old version intact."""
    spark = df.sparkSession
    v = next_version(spark, path)
    folder = _write_snapshot(df, path, partition_by)
    gate(checks(spark.read.schema(df.schema).parquet(f"{path}/{folder}")), what=f"publish of {path} v={v}")
    _commit(spark, path, v, folder, note)
    return v


# ---------------------------------------------------------------- partitioned facts

def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an append-only parquet table, creating it empty if absent."""
    df = _try_read(spark, lambda: spark.read.schema(schema).parquet(path))
    if df is None:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        df = spark.createDataFrame([], schema)
    return df


def upsert_partitions(spark: SparkSession, path: str, schema: T.StructType, source: DataFrame,
                      keys: Sequence[str], partition_col: str, partition_expr: Column,
                      checks: Callable[[DataFrame], DataFrame] | None = None,
                      summary_by: Sequence[str] = (), **upsert_args) -> list:
    """Upsert ``source`` into the day-partitioned table at ``path``.

    Only the partitions the source touches are read and written, to a new
    folder that one commit record makes visible; the list of touched
    partitions is the one small collect (days in a batch). ``checks`` see the
    merged partitions as written, before the commit. The upsert is idempotent
    by key, so a batch may be replayed. ``partition_col`` is the last field of
    ``schema``. With ``summary_by`` the rows of each of its groups in each
    partition are counted beside the commit (:func:`read_summary`)."""
    # The batch is read for the touched days, the duplicate check and the
    # merge: keep it (spillable) for the duration of this call.
    src = source.withColumn(partition_col, partition_expr).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        args = dict(upsert_args)
        if args.get("on_duplicate", "error") == "error":
            # One aggregation gives the touched days and the key check
            # (the partition value is a function of the keys, e.g. ts -> day).
            touched = _touched_and_checked(src, list(keys), partition_col)
            args["on_duplicate"] = "trust"
        else:
            touched = [r[0] for r in src.select(partition_col).distinct().collect()]
        if not touched:
            return []
        for attempt in range(1, COMMIT_ATTEMPTS + 1):
            version = next_version(spark, path)
            target = read_parts(spark, path, schema, only=touched)
            merged = upsert(target, src.select(*[c for c in src.columns if c in schema.fieldNames()]),
                            keys, **args)
            # rebalance: AQE packs each day into a few right-sized files and
            # splits a hot day over several tasks, instead of every join task
            # writing a small file into every touched day. Files are sorted by
            # the keys, so parquet min/max statistics skip row groups for key
            # filters (the role indexes play in a database).
            folder = _new_folder()
            (merged.select(*schema.fieldNames()).hint("rebalance", partition_col)
                   .sortWithinPartitions(partition_col, *keys)
                   .write.mode("errorifexists").partitionBy(partition_col).parquet(f"{path}/{folder}"))
            if checks is not None:
                gate(checks(spark.read.schema(schema).parquet(f"{path}/{folder}")), what=f"upsert into {path}")
            if summary_by:
                written = spark.read.schema(schema).parquet(f"{path}/{folder}")
                written.groupBy(*summary_by, partition_col).agg(F.count(F.lit(1)).alias("rows")).withColumn(
                    "folder", F.lit(folder)).write.parquet(f"{path}/{SUMMARIES}/{folder}")
            try:
                _commit(spark, path, version, folder, parts=sorted(str(v) for v in touched))
                break
            except ConcurrentPublishError:
                _discard(spark, path, folder)
                if attempt == COMMIT_ATTEMPTS:
                    raise
        return touched
    finally:
        src.unpersist()


def _touched_and_checked(src: DataFrame, keys: list, partition_col: str) -> list:
    """Touched partition values of a batch, raising on duplicate or NULL keys
    (one row per touched partition reaches the driver)."""
    return [r[partition_col] for r in check_keys(src, keys, by=[partition_col])]


__all__ = ["with_defaults", "committed_versions", "current_version", "next_version", "read_current", "read_parts", "read_summary", "parts_since",
           "replace_table", "publish", "ensure_table", "upsert_partitions", "ConcurrentPublishError"]
