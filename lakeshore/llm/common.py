"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.plans.joins import sized_broadcast
from lakeshore.session import scratch_dir

_SHIPPED: set[str] = set()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def releasing(f: Callable) -> Callable:
    """``f``, a function of batches; at its end the worker, which later stages
    use again, gives the memory back that Arrow and the C library keep of freed
    objects (about 100 MB after a batch of 27 MB of texts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        _give_back()
    return run


# Of rows in one batch that goes to a Python function, about.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on this session's batches to Python hold about BATCH_BYTES.
    Left alone Spark sends up to 10,000 whole documents at once: the executor's
    JVM holds such a batch, the larger buffer it grows into and the answer
    outside its heap, and keeps part of that memory in later stages. Frames are
    read when they are written, so the setting isn't taken back; a smaller one
    stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < before <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.isdir(root):  # already running from a shipped archive
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="lakeshore-ship-"), "lakeshore_shipped.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and read
    it back: the lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._lakeshore_path = path
    return out


def drop_saved(df: DataFrame) -> None:
    """Delete the files of a frame made by :func:`saved`."""
    path = getattr(df, "_lakeshore_path", None)
    if path:
        spark = df.sparkSession
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def doc_text(docs: DataFrame) -> DataFrame:
    """doc_id (long) and text (string; null: empty) alone, so that no other
    column of ``docs`` can clash with an operator's own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def drawn(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """About ``n`` rows of ``df`` (all, if it has no more), drawn by a hash of
    ``columns``: no task gathers them, and a run again draws the same. Rows
    equal in these columns are drawn together: merge them afterwards."""
    total = df.count()
    if total <= n:
        return df
    place = F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / float(1 << 40)
    return df.where(place < n / total)


def tokenizer_bytes(path: str) -> bytes:
    """A tokenizer file as bytes (a few MB at most), to travel with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def hex64(bits: Column) -> Column:
    """16 lowercase hex digits of a long's 64 bits."""
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


# Stands for a null doc_id inside operators: such documents order last.
NULL_ID = (1 << 63) - 1


def keyed_text(docs: DataFrame) -> DataFrame:
    """text, ``id`` (doc_id, null as NULL_ID), ``copy`` (long): 0, or where one
    doc_id has several different texts, the hash of this row's text; and
    ``row``, a struct of the whole row. Equal (id, copy) means the same document
    repeated."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row"))
    # Two hashes of an id differ if it has two texts; combined in every task.
    text_hash = F.xxhash64("text")
    spans = base.groupBy("id").agg(F.min(text_hash).alias("least"), F.max(text_hash).alias("most"))
    many = saved(spans.where("least < most").select("id"), "repeated-ids")
    if many.isEmpty():
        return base.withColumn("copy", F.lit(0).cast("long"))
    told = sized_broadcast(many.withColumn("several", F.lit(True)))
    return base.join(told, "id", "left").select(
        "id", "text", "row", F.when(F.col("several"), F.xxhash64("text")).otherwise(F.lit(0)).alias("copy"))


def matched(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs``, all columns, joined with ``keys`` (doc_id, text_hash and other
    columns of names that begin with ``__``) on id and text, nulls equal."""
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    renamed = keys.withColumnsRenamed({"doc_id": "__key_id", "text_hash": "__key_hash"})
    on = (F.col("doc_id").cast("long").eqNullSafe(F.col("__key_id"))) & (F.col("__hash") == F.col("__key_hash"))
    out = docs.withColumn("__hash", text_hash).join(renamed, on, how)
    return out.drop("__hash", "__key_id", "__key_hash")


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text; n_chars, where there is one, follows it."""
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns(columns)
