"""Small records in a shared folder, each created whole and by one writer: the
commit log of stored tables and the claims on ranges of ids.

A record is written aside and then given its name in one step that fails if
the name is taken: a hard link on a local (or mounted) file system, elsewhere a
rename without overwriting, which HDFS decides in one place. So a record is
never seen half-written, and a writer that dies leaves at most a hidden file.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the records in ``folder`` (none if it doesn't exist)."""
    path, fs = _file(spark, folder)
    if not fs.exists(path):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(path) if s.isFile())
    return sorted(n for n in found if not n.startswith(("_", ".")))


def next_number(spark: SparkSession, folder: str) -> int:
    """One more than the largest number in use as a record's name, readable or
    not: a number is never used twice."""
    used = [int(n.split(".")[0]) for n in names(spark, folder) if n.split(".")[0].isdigit()]
    return max(used, default=0) + 1


def create(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Make the record; False if there is one of that name already."""
    aside, fs = _file(spark, f"{folder}/_{name}.{uuid.uuid4().hex}")
    target, _ = _file(spark, f"{folder}/{name}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        _name_it(spark, fs, aside, target)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(aside, False)
    return True


def _name_it(spark: SparkSession, fs, aside, target) -> None:
    jvm = spark._jvm
    if target.toUri().getScheme() in (None, "file") and fs.getScheme() == "file":
        jvm.java.nio.file.Files.createLink(fs.pathToFile(target).toPath(), fs.pathToFile(aside).toPath())
        return
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, target, options)


def read(spark: SparkSession, folder: str, name: str) -> dict | None:
    """A record's content; None if it is missing or can't be read."""
    path, fs = _file(spark, f"{folder}/{name}")
    if not fs.exists(path):
        return None
    size = fs.getFileStatus(path).getLen()
    file = fs.open(path)
    try:
        data = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(file) if size else b""
    finally:
        file.close()
    try:
        return json.loads(bytes(data).decode())
    except ValueError:
        return None


def claim_ids(spark: SparkSession, folder: str, n: int, after: int = 0, owner: str | None = None) -> int:
    """The first of ``n`` consecutive ids that no other claim in ``folder``
    holds, all larger than ``after``. An ``owner`` that comes again (a batch
    that runs again) gets the range it got before. A range whose claimer dies
    is never given out again, as with a database's sequence."""
    mine = f"{hashlib.sha256(owner.encode()).hexdigest()}.json" if owner else None
    if mine and (found := read(spark, f"{folder}/owners", mine)) is not None:
        return found["first"]
    while True:
        number = next_number(spark, folder)
        last = next((r["last"] for k in range(number - 1, 0, -1)
                     if (r := read(spark, folder, f"{k:09d}.json")) is not None), 0)
        first = max(last, after) + 1
        record = json.dumps({"first": first, "last": first + n - 1, "owner": owner})
        if not create(spark, folder, f"{number:09d}.json", record):
            continue  # another writer was faster: claim behind it
        if mine and not create(spark, f"{folder}/owners", mine, record):
            return read(spark, f"{folder}/owners", mine)["first"]
        return first


__all__ = ["names", "next_number", "create", "read", "claim_ids"]
