"""Star-schema building blocks: people dimension, event fact with a
known-person flag, staged hourly view, date dimension, hourly fact
(J1, J2, J5, W1, K3d, S9, P12, F6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.scalar import date_key, ntz, ts_date
from lakeshore.operators.keys import desc, latest_per_key
from lakeshore.plans.joins import lookup_join, measured_side

# Key-only sides are narrow; this many keys still broadcast comfortably.
KEY_BROADCAST_ROWS = 1_000_000


def build_dim_people(stg: DataFrame, raw: DataFrame, run_ts) -> DataFrame:
    """Latest staged row per email (created_at DESC, person_id DESC, NULLs
    first as the reference's database sorts DESC), rows without email
    dropped."""
    j = stg.where(F.col("email").isNotNull()).join(
        raw.select("person_id", "created_at"), "person_id")
    latest = latest_per_key(j.select("email", "full_name", "age", "country", "person_id", "created_at"),
                            ["email"], [desc("created_at"), desc("person_id")])
    return latest.select(
        "email", "full_name", "age", "country",
        F.col("person_id").alias("source_person_id"),
        F.col("created_at").alias("source_created_at"),
        ntz(run_ts).alias("updated_at"),
    )


def lookup_flag(fact: DataFrame, dim: DataFrame, key: str, flag: str,
                max_rows: int = KEY_BROADCAST_ROWS) -> DataFrame:
    """fact LEFT JOIN dim ON key, flag = (dim.key IS NOT NULL).

    The dimension key must be unique (checked by ``unique_report``) or the
    join would multiply facts. NULL keys match nothing -> false. A key set of
    checked size is broadcast, so the fact is not shuffled at all. Above the
    bound the join shuffles: a hot key is split by AQE's skew-join handling
    (left outer, fact on the left), and fact rows with a NULL key - which
    would all hash to one task - are spread by a second join column: the
    hash of the key itself for a real key (on both sides, in the fact key's
    type, so it is equal exactly when the keys are) and a hash of the whole
    row for a NULL key. It is no constant, so Catalyst keeps it a shuffle
    key; it is deterministic, so a retried task sends each row to the same
    place."""
    keys = dim.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()) \
        .withColumn(flag, F.lit(True))
    keys, fits = measured_side(keys, max_rows=max_rows)
    if fits:
        j = fact.join(F.broadcast(keys), fact[key] == keys["_k"], "left").drop("_k")
    else:
        key_type = fact.schema[key].dataType
        spread = F.when(F.col(key).isNull(), F.xxhash64(*[F.col(c) for c in fact.columns])) \
            .otherwise(F.xxhash64(F.col(key)))
        f = fact.withColumn("_ns", spread)
        k = keys.withColumn("_nk", F.xxhash64(F.col("_k").cast(key_type)))
        j = f.join(k, (f[key] == k["_k"]) & (f["_ns"] == k["_nk"]), "left").drop("_k", "_ns", "_nk")
    return j.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def build_fact_events(raw_events: DataFrame, dim_people: DataFrame, load_ts) -> DataFrame:
    j = lookup_flag(raw_events, dim_people, "email", "is_known_person")
    return j.select("event_id", "event_ts", "email", "event_type", "amount", "source",
                    "is_known_person", ntz(load_ts).alias("load_ts"))


def stg_hourly(raw: DataFrame, dim_location: DataFrame) -> DataFrame:
    """stg_weather_hourly view: raw rows with their location label (inner)."""
    dim = dim_location.select("location_id", "location_name")
    return lookup_join(raw, dim, "location_id", "inner")


def dim_date_from(df: DataFrame, ts: str = "ts") -> DataFrame:
    """SELECT DISTINCT to_char(ts::date,'YYYYMMDD')::INT, ts::date."""
    d = ts_date(ts)
    return df.select(date_key(d).alias("date_key"), d.alias("date")).distinct()


# A date dimension holds one row per calendar day (date is UNIQUE): whatever
# the data, it cannot exceed the days of the calendar (0001-01-01 ..
# 9999-12-31, ~3.65M rows of two narrow columns, ~60 MB); a real one holds a
# few thousand. That is a proven bound, so it is broadcast without counting.
DATE_DIM_MAX_ROWS = 3_652_059


def build_fact_hourly(stg: DataFrame, dim_date: DataFrame) -> DataFrame:
    """stg JOIN dim_date ON dim_date.date = stg.ts::date (computed key).
    The date dimension is broadcast on its calendar bound, so the fact is
    never shuffled by day."""
    s = stg.withColumn("_d", ts_date("ts"))
    dd = dim_date.select(F.col("date").alias("_d"), "date_key")
    return s.join(F.broadcast(dd), "_d", "inner").select(
        "location_id", "ts", "temperature_2m", "precipitation", "windspeed_10m", "date_key", "run_id")


__all__ = ["build_dim_people", "lookup_flag", "build_fact_events", "stg_hourly", "dim_date_from",
           "build_fact_hourly"]
