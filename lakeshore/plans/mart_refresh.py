"""The marts kept up to date from the days that changed (M4-M6).

``mart_days`` holds the partials of each (location, day), partitioned by day: a
refresh reads the days of the fact that were committed since the last one and
replaces their partials, nothing else. Averages and totals are read from it.
``mart_top_hours`` holds the windiest hours of each location: a refresh merges
those of the changed days into them, and only locations that may have lost an
hour to a better one of an unchanged day are derived again, from the partials.

Each table's commits say which version of its source they have seen, so a
refresh that dies is made up for by the next one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.operators import marts
from lakeshore.plans import storage
from lakeshore.plans.joins import sized_broadcast
from lakeshore.schemas import MART_DAYS, MART_TOP_HOURS

DAYS, TOP = "mart_days", "mart_top_hours"


def _seen(spark: SparkSession, path: str) -> int:
    """The version of its source that the table's last commit had seen."""
    log = storage.committed_versions(spark, path)
    note = None if log is None else log.agg(F.max_by("note", "version")).first()[0]
    return int(note.split("=")[1]) if note else 0


def _refresh_days(spark: SparkSession, root: str, fact_path: str, fact_schema: T.StructType, n: int) -> list[str]:
    path = f"{root}/{DAYS}"
    version, seen = storage.next_version(spark, path), _seen(spark, path)
    now = storage.current_version(spark, fact_path) or 0
    days = storage.parts_since(spark, fact_path, seen)
    if not days:
        return []
    changed = storage.read_parts(spark, fact_path, fact_schema, only=days)
    folder = storage._new_folder()
    marts.day_partials(changed, n).select(*MART_DAYS.fieldNames()).hint("rebalance", "date") \
        .sortWithinPartitions("date", "location_id").write.partitionBy("date").parquet(f"{path}/{folder}")
    storage._commit(spark, path, version, folder, note=f"fact={now}", parts=days)
    return days


def _refresh_top(spark: SparkSession, root: str, n: int) -> None:
    source, path = f"{root}/{DAYS}", f"{root}/{TOP}"
    version, seen = storage.next_version(spark, path), _seen(spark, path)
    now = storage.current_version(spark, source) or 0
    days = storage.parts_since(spark, source, seen)
    if not days:
        return
    changed = marts.top_hours(storage.read_parts(spark, source, MART_DAYS, only=days), n)
    old = storage.read_current(spark, path, MART_TOP_HOURS)
    if old is None:
        top = changed
    else:
        merged = marts.merge_top_hours(old, changed, [dt.date.fromisoformat(d) for d in days], n).checkpoint(eager=True)
        lost = merged.where("NOT exact").select("location_id")
        top = merged.where("exact").drop("exact")
        if not lost.isEmpty():
            again = storage.read_parts(spark, source, MART_DAYS).join(sized_broadcast(lost), "location_id", "left_semi")
            top = top.unionByName(marts.top_hours(again, n))
    storage.replace_table(top, path, note=f"days={now}", version=version)


def refresh_marts(spark: SparkSession, root: str, fact_path: str, fact_schema: T.StructType, n: int = 5) -> list[str]:
    """Bring the marts below ``root`` up to the fact's last commit; returns the
    days that were read."""
    days = _refresh_days(spark, root, fact_path, fact_schema, n)
    _refresh_top(spark, root, n)
    return days


def read_marts(spark: SparkSession, root: str, dim_location: DataFrame, n: int = 5) -> dict[str, DataFrame]:
    days = storage.read_parts(spark, f"{root}/{DAYS}", MART_DAYS)
    top = storage.read_current(spark, f"{root}/{TOP}", MART_TOP_HOURS)
    if top is None:
        top = spark.createDataFrame([], MART_TOP_HOURS)
    return {"daily_avg": marts.daily_avg_from(days, dim_location), "daily_total": marts.daily_total_from(days, dim_location),
            "windiest": marts.windiest_from(top, dim_location, n)}


__all__ = ["refresh_marts", "read_marts"]
