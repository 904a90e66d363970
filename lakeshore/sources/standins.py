"""Driver tables re-shaped into the reference's raw inputs.

The driver ships TPC-H-like tables plus an ``events`` table; these functions
derive the people, events, hourly-weather, run-log and location inputs the
warehouse operators expect. NULLs and blanks are injected by fixed rules on
the ids so the edge cases of small seed data appear at scale. All of them
grow with the source tables: a person per customer, a location per user, a
run per location and day, an hourly row per location and hour with an event
(96% of the events at every scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.functions.scalar import hour_floor
from lakeshore.operators.keys import desc, latest_per_key
from lakeshore.schemas import DEFAULT_EVENT_SOURCE, MEASURE, MONEY
from lakeshore.sources.tables import driver_table

PIPELINE_NAME = "hourly_incremental"


def _person(k):
    """Every fifth customer is the one before it again, under a new key."""
    return F.when(k % 5 == 0, k - 1).otherwise(k)


def _run_id(ts, user):
    """A run per day and location."""
    return F.datediff(ts, F.lit("2023-12-31")).cast("bigint") * 10_000_000 + user


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_people from ``customer``."""
    c = driver_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("person_id"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("full_name"),
        F.when(k % 11 == 0, F.lit(None)).otherwise((k % 140 - 10).cast("int")).cast("int").alias("age"),
        F.when(k % 13 == 0, F.lit(""))
         .when(k % 17 == 0, F.lit(None))
         .otherwise(F.concat(F.lit(" u"), _person(k).cast("string"), F.lit("@example.com ")))
         .alias("email"),
        F.when(k % 9 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("country"),
        F.concat(F.lit("2024-01-0"), (k % 5 + 1).cast("string")).cast("timestamp_ntz").alias("created_at"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_events from ``events``."""
    e = driver_table(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(
        i.alias("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_ts"),
        F.when(i % 10 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")))
         .alias("email"),
        F.col("event_type"),
        F.when(i % 7 == 0, F.lit(None).cast(MONEY))
         .when(i % 11 == 0, (-F.col("value")).cast(MONEY))
         .otherwise(F.col("value").cast(MONEY)).alias("amount"),
        F.lit(DEFAULT_EVENT_SOURCE).alias("source"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw hourly weather rows from ``events``: one row per (location, hour),
    the highest event_id winning."""
    e = driver_table(spark, sf_dir, "events")
    i = F.col("event_id")
    rows = e.select(
        F.col("user_id").alias("location_id"),
        hour_floor(F.col("ts").cast("timestamp_ntz")).alias("ts"),
        F.when(i % 50 == 0, F.lit(None).cast(MEASURE)).otherwise(F.col("value").cast(MEASURE))
         .alias("temperature_2m"),
        (i % 9).cast(MEASURE).alias("precipitation"),
        F.when(i % 37 == 0, F.lit(None).cast(MEASURE)).otherwise((i * 7 % 101).cast(MEASURE))
         .alias("windspeed_10m"),
        _run_id("ts", F.col("user_id")).alias("run_id"),
        i.alias("event_id"),
    )
    return latest_per_key(rows, ["location_id", "ts"], [desc("event_id")]).drop("event_id")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ingestion_runs: one run per location and day of ``events``."""
    e = driver_table(spark, sf_dir, "events")
    x = e.groupBy(_run_id("ts", F.col("user_id")).alias("run_id")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n"))
    r = F.col("run_id")
    return x.select(
        r, F.lit(PIPELINE_NAME).alias("pipeline_name"),
        F.col("started_at").cast("timestamp_ntz").alias("started_at"),
        F.when(r % 11 == 0, F.lit(None)).otherwise(F.col("last_ts")).cast("timestamp_ntz").alias("finished_at"),
        F.when(r % 7 == 0, "FAILED").when(r % 5 == 0, "SKIPPED").otherwise("SUCCESS").alias("status"),
        F.when(r % 5 == 0, F.lit(0).cast("bigint")).otherwise(F.col("n")).alias("row_count"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only run events: an open event per run, a close event for most."""
    r = runs(spark, sf_dir)
    opened = r.select("run_id", F.lit(1).alias("event_seq"), F.lit("RUNNING").alias("status"),
                      F.col("started_at").alias("at"))
    closed = r.where(F.col("run_id") % 6 != 0).select(
        "run_id", F.lit(2).alias("event_seq"), "status", F.col("finished_at").alias("at"))
    return opened.unionByName(closed)


def coordinates(k):
    """(latitude, longitude) of location ``k``, distinct for each."""
    return ((k % 1000 * F.lit(0.17) - 85).cast("decimal(9,6)").alias("latitude"),
            (F.floor(k / 1000) * F.lit(0.013) - 179).cast("decimal(9,6)").alias("longitude"))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_location: one per user of ``events``, named after a nation."""
    users = driver_table(spark, sf_dir, "events").select(F.col("user_id").cast("bigint").alias("location_id")).distinct()
    n = driver_table(spark, sf_dir, "nation")
    r = driver_table(spark, sf_dir, "region")
    k = F.col("location_id")
    named = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return users.join(named, k % 25 == F.col("n_nationkey"), "left").select(
        "location_id",
        F.concat_ws(", ", F.concat_ws(" ", "n_name", k.cast("string")), "r_name").alias("location_name"),
        *coordinates(k))


def extra_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations that have no weather rows: one per ``region``."""
    r = driver_table(spark, sf_dir, "region")
    return r.select(
        (-1 - F.col("r_regionkey")).cast("bigint").alias("location_id"),
        F.concat(F.col("r_name"), F.lit(" HQ")).alias("location_name"),
        (F.col("r_regionkey") * F.lit(0.5) + 86).cast("decimal(9,6)").alias("latitude"),
        (F.col("r_regionkey") * F.lit(-1.25) + 10).cast("decimal(9,6)").alias("longitude"),
    )


def region_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partial location dimension (labels for some ids only)."""
    r = driver_table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("bigint").alias("location_id"),
                    F.col("r_name").alias("location_name"))


__all__ = ["people", "events", "hourly", "runs", "run_events", "locations", "coordinates", "extra_locations",
           "region_labels", "PIPELINE_NAME"]
