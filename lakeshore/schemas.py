"""Declared table schemas (no inference anywhere in the package)."""

from __future__ import annotations

from pyspark.sql import types as T

from lakeshore.fixed import (DEFAULT_EVENT_SOURCE, DEFAULT_WEATHER_SOURCE, EXPORT_COLUMNS,  # noqa: F401
                             HOURLY_VARS, RUN_STATUSES, UNKNOWN_COUNTRY)

MONEY = T.DecimalType(10, 2)          # NUMERIC(10,2)
COORD = T.DecimalType(9, 6)           # NUMERIC(9,6)
MEASURE = T.DecimalType(18, 6)        # unbounded NUMERIC, scale declared
NTZ = T.TimestampNTZType()


def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_PEOPLE = _s(("person_id", T.LongType(), False), ("full_name", T.StringType(), True),
                ("age", T.IntegerType(), True), ("email", T.StringType(), True),
                ("country", T.StringType(), True), ("created_at", NTZ, True))

STG_PEOPLE = _s(("person_id", T.LongType(), False), ("full_name", T.StringType(), False),
                ("age", T.IntegerType(), True), ("email", T.StringType(), True),
                ("country", T.StringType(), False), ("load_ts", NTZ, True))

DIM_PEOPLE = _s(("email", T.StringType(), False), ("full_name", T.StringType(), False),
                ("age", T.IntegerType(), True), ("country", T.StringType(), False),
                ("source_person_id", T.LongType(), False), ("source_created_at", NTZ, False),
                ("updated_at", NTZ, True))

RAW_EVENTS = _s(("event_id", T.LongType(), False), ("event_ts", NTZ, False),
                ("email", T.StringType(), True), ("event_type", T.StringType(), False),
                ("amount", MONEY, True), ("source", T.StringType(), True),
                ("created_at", NTZ, True))

FACT_EVENTS = _s(("event_id", T.LongType(), False), ("event_ts", NTZ, False),
                 ("email", T.StringType(), True), ("event_type", T.StringType(), False),
                 ("amount", MONEY, True), ("source", T.StringType(), True),
                 ("is_known_person", T.BooleanType(), False), ("load_ts", NTZ, True))

QUARANTINE_EVENTS = _s(("quarantine_id", T.LongType(), False), ("event_id", T.LongType(), True),
                       ("event_ts", NTZ, True), ("email", T.StringType(), True),
                       ("event_type", T.StringType(), True), ("amount", MONEY, True),
                       ("source", T.StringType(), True), ("reject_reason", T.StringType(), False),
                       ("quarantined_at", NTZ, True))

RUN_EVENTS = _s(("run_id", T.LongType(), False), ("event_seq", T.IntegerType(), False),
                ("pipeline_name", T.StringType(), True), ("source_name", T.StringType(), True),
                ("params", T.StringType(), True), ("status", T.StringType(), False),
                ("at", NTZ, True), ("row_count", T.LongType(), True),
                ("error_message", T.StringType(), True))

INGESTION_RUNS = _s(("run_id", T.LongType(), False), ("pipeline_name", T.StringType(), False),
                    ("source_name", T.StringType(), False), ("params", T.StringType(), False),
                    ("started_at", NTZ, True), ("finished_at", NTZ, True),
                    ("status", T.StringType(), True), ("row_count", T.LongType(), True),
                    ("error_message", T.StringType(), True))

DIM_LOCATION = _s(("location_id", T.LongType(), False), ("location_name", T.StringType(), False),
                  ("latitude", COORD, True), ("longitude", COORD, True))

RAW_WEATHER_HOURLY = _s(("location_id", T.LongType(), False), ("ts", NTZ, False),
                        ("temperature_2m", MEASURE, True), ("precipitation", MEASURE, True),
                        ("windspeed_10m", MEASURE, True), ("source", T.StringType(), True),
                        ("ingested_at", NTZ, True), ("run_id", T.LongType(), False))

# raw_weather_hourly as stored: partitioned by day.
RAW_WEATHER_STORED = T.StructType(RAW_WEATHER_HOURLY.fields + [T.StructField("date", T.DateType(), True)])

# The last hour that each load brought, appended by every run; a stream names itself.
WATERMARKS = _s(("location_id", T.LongType(), False), ("ts", NTZ, False), ("loaded_by", T.StringType(), True))

DIM_DATE = _s(("date_key", T.IntegerType(), False), ("date", T.DateType(), False))

FACT_WEATHER_HOURLY = _s(("location_id", T.LongType(), False), ("ts", NTZ, False),
                         ("temperature_2m", MEASURE, True), ("precipitation", MEASURE, True),
                         ("windspeed_10m", MEASURE, True), ("date_key", T.IntegerType(), False),
                         ("run_id", T.LongType(), False))

CLOUD_WEATHER_HOURLY = _s(("location_name", T.StringType(), True), ("location_id", T.LongType(), True),
                          ("ts", NTZ, True), ("temperature_2m", T.DoubleType(), True),
                          ("precipitation", T.DoubleType(), True), ("windspeed_10m", T.DoubleType(), True),
                          ("source", T.StringType(), True), ("ingested_at", NTZ, True),
                          ("run_id", T.LongType(), True))

# The cloud table as stored: with the file of each row, partitioned by day.
CLOUD_STORED = T.StructType(CLOUD_WEATHER_HOURLY.fields + [
    T.StructField("file", T.StringType(), True), T.StructField("date", T.DateType(), True)])

# The ledger of file loads, and the records that were not loaded.
LOAD_LEDGER = _s(("load", T.LongType(), False), ("file", T.StringType(), False), ("length", T.LongType(), True),
                 ("modified", T.TimestampType(), True), ("fingerprint", T.StringType(), True),
                 ("status", T.StringType(), False), ("rows_parsed", T.LongType(), True),
                 ("rows_loaded", T.LongType(), True), ("errors_seen", T.LongType(), True),
                 ("first_error", T.StringType(), True), ("first_error_row", T.LongType(), True),
                 ("first_error_column", T.StringType(), True))
LOAD_REJECTS = _s(("load", T.LongType(), False), ("file", T.StringType(), False), ("row_number", T.LongType(), False),
                  ("column", T.StringType(), True), ("value", T.StringType(), True), ("reason", T.StringType(), False),
                  ("record", T.StringType(), True))

# What the marts keep of each location's day (partitioned by day), and each
# location's windiest hours.
_HOURS = T.ArrayType(T.StructType([T.StructField("known", T.BooleanType()), T.StructField("calm", T.DecimalType(19, 6)),
                                   T.StructField("ts", NTZ)]))
MART_DAYS = _s(("location_id", T.LongType(), False), ("warmth", T.DecimalType(28, 6), True),
               ("measured", T.LongType(), False), ("wet", T.DecimalType(28, 6), True), ("hours", _HOURS, True),
               ("date", T.DateType(), True))
MART_TOP_HOURS = _s(("location_id", T.LongType(), False), ("hours", _HOURS, True))

# Measures are read as text, so that garbage is seen instead of read as NULL.
PAYLOAD = T.StructType([
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("location_name", T.StringType(), True),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()), True)]
        + [T.StructField(v, T.ArrayType(T.StringType()), True) for v in HOURLY_VARS]), True),
    T.StructField("_corrupt_record", T.StringType(), True),
])
