"""The hourly model refresh on stored tables.

staged view (raw JOIN dim_location) -> missing dates into dim_date ->
fact_weather_hourly upserted through the date join (touched days only) ->
model checks (staging = fact, no orphan dates or locations, unique grain)
-> marts brought up to date from the days that changed (mart_refresh).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.functions.scalar import ts_date
from lakeshore.operators import keys, model, quality, upsert
from lakeshore.plans import storage
from lakeshore.plans.mart_refresh import read_marts, refresh_marts
from lakeshore.schemas import DIM_DATE, FACT_WEATHER_HOURLY

def _fact_stored_schema() -> T.StructType:
    """fact_weather_hourly as stored: partitioned by day."""
    return T.StructType(FACT_WEATHER_HOURLY.fields + [T.StructField("date", T.DateType(), True)])


def _dim_date_checks(df: DataFrame) -> DataFrame:
    a = quality.unique_report(df, ["date"], "dim_date").select(F.lit("unique_date").alias("check_name"), "passed")
    b = quality.unique_report(df, ["date_key"], "dim_date").select(F.lit("unique_date_key").alias("check_name"),
                                                                  "passed")
    return a.unionByName(b)


def _fact_checks(dim_date: DataFrame, dim_location: DataFrame, runs: DataFrame | None):
    """Every key of the fact has its row: date, location and, given the run
    log, run."""
    def report(fact: DataFrame) -> DataFrame:
        out = None
        for name, dim in (("date_key", dim_date), ("location_id", dim_location), ("run_id", runs)):
            if dim is None:
                continue
            one = quality.orphan_count(fact, dim, name, "observed").select(
                F.lit(f"orphan_{name}").alias("check_name"), "observed", (F.col("observed") == 0).alias("passed"))
            out = one if out is None else out.unionByName(one)
        return out
    return report


def refresh_model(spark: SparkSession, root: str, raw: DataFrame, dim_location: DataFrame,
                  days: list | None = None, runs: DataFrame | None = None) -> dict[str, DataFrame]:
    """Refresh the model below ``root``. ``days`` (e.g. ``storage.parts_since``
    of the raw table) limits it to the days that changed: other days of the
    fact are neither read nor written. The fact is committed only if every
    date, location and (with the run log ``runs``) run key has its row."""
    root = root.rstrip("/")
    if days is not None:
        day = F.col("date") if "date" in raw.columns else ts_date("ts")
        raw = raw.where(day.isin([dt.date.fromisoformat(str(d)) for d in days]))
    stg = model.stg_hourly(raw.drop("date"), dim_location)

    # dim_date: insert the dates that are missing (ON CONFLICT DO NOTHING)
    current = storage.read_current(spark, f"{root}/dim_date", DIM_DATE)
    if current is None:
        current = spark.createDataFrame([], DIM_DATE)
    dim_date = upsert.insert_missing(current, model.dim_date_from(stg), ["date"])
    storage.publish(dim_date, f"{root}/dim_date", _dim_date_checks)
    dim_date = storage.read_current(spark, f"{root}/dim_date", DIM_DATE)

    # fact: upsert through the computed-key join, touched days only; keys are
    # checked before the commit
    fact_path = f"{root}/fact_weather_hourly"
    rows = model.build_fact_hourly(stg, dim_date)
    storage.upsert_partitions(
        spark, fact_path, _fact_stored_schema(), rows, ["location_id", "ts"], "date", ts_date("ts"),
        checks=_fact_checks(dim_date, dim_location, runs),
        update_cols=["temperature_2m", "precipitation", "windspeed_10m", "date_key", "run_id"])
    fact = storage.read_parts(spark, fact_path, _fact_stored_schema(), only=days).drop("date")

    checks = quality.reconcile({"row_count_stg": stg, "row_count_fact": fact})
    # marts: only the days of the fact that changed are read
    refresh_marts(spark, root, fact_path, _fact_stored_schema())
    return {
        "reconciliation": checks,
        "missing_dates": quality.orphan_count(fact, dim_date, "date_key", "missing_dates"),
        "missing_location": quality.orphan_count(fact, dim_location, "location_id", "missing_location"),
        "duplicate_grain": keys.duplicate_keys(fact, ["location_id", "ts"], "duplicate_count"),
        **read_marts(spark, root, dim_location),
    }


__all__ = ["refresh_model"]
