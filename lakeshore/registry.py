"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the driver tables re-shaped by ``lakeshore.sources.standins``;
every query reads whole tables. Fixed run timestamps stand in for NOW(),
which is constant within a run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshore.functions import scalar as S
from lakeshore.operators import clean, incremental, keys, marts, model, quality, upsert
from lakeshore.operators import audit
from lakeshore.plans.joins import lookup_join
from lakeshore.plans.storage import read_parts, replace_table
from lakeshore.schemas import DEFAULT_WEATHER_SOURCE, MEASURE
from lakeshore.sources import standins as SI
from lakeshore.sources.tables import driver_table

RUN_TS = "2026-03-01 05:00:00"
RUN_TS2 = "2026-03-02 05:00:00"
TARGET_BEFORE = "2024-01-16"      # incremental split: target = ts before this day
SOURCE_FROM = "2024-01-14"        # source = ts from this day (two days overlap)
PEOPLE_TARGET_UNTIL = "2024-01-03"
PEOPLE_SOURCE_FROM = "2024-01-03"
WINDOWS_AS_OF = "2024-01-24"
INCR_AS_OF = "2024-01-20"
QC_WINDOW_START = "2024-01-01 00:00:00"
QC_WINDOW_HOURS = 31 * 24
FILTER_LOCATION = "NATION_3 3, EUROPE"
FILTER_DAY = "2024-01-10"


# ---------------------------------------------------------------- people / events

def _raw_people(spark, sf):
    return SI.people(spark, sf)


def _stg(spark, sf):
    return clean.clean_people(_raw_people(spark, sf), RUN_TS)


def _dim_people(spark, sf):
    return model.build_dim_people(_stg(spark, sf), _raw_people(spark, sf), RUN_TS)


def _fact_all(spark, sf):
    return model.build_fact_events(SI.events(spark, sf), _dim_people(spark, sf), RUN_TS)


def _good_bad(spark, sf):
    return quality.quarantine(SI.events(spark, sf), quality.event_rules())


def _fact_good(spark, sf):
    good, _ = _good_bad(spark, sf)
    return model.build_fact_events(good, _dim_people(spark, sf), RUN_TS)


def raw_null_profile(spark, sf):
    return clean.null_profile(_raw_people(spark, sf), ["email", "age", "country"])


def stg_null_profile(spark, sf):
    stg = _stg(spark, sf)
    return stg.agg(F.count(F.lit(1)).alias("stg_count"),
                   F.count_if(F.col("email").isNull()).alias("null_email"),
                   F.count_if(F.col("country") == "UNKNOWN").alias("unknown_country"),
                   F.count_if(F.col("age").isNull()).alias("null_age"))


def raw_age_out_of_range(spark, sf):
    return clean.out_of_range(_raw_people(spark, sf), "age", *clean.AGE_RANGE)


def raw_duplicate_emails(spark, sf):
    return keys.duplicate_keys(_raw_people(spark, sf), ["email"], "cnt_email", skip_null_keys=True)


def stg_people_clean(spark, sf):
    return _stg(spark, sf)


def dim_people_latest(spark, sf):
    return _dim_people(spark, sf)


def dim_people_upsert(spark, sf):
    raw = _raw_people(spark, sf)
    early = raw.where(F.col("created_at") <= S.ntz(PEOPLE_TARGET_UNTIL))
    late = raw.where(F.col("created_at") >= S.ntz(PEOPLE_SOURCE_FROM))
    target = model.build_dim_people(clean.clean_people(early, RUN_TS), early, RUN_TS)
    source = model.build_dim_people(clean.clean_people(late, RUN_TS2), late, RUN_TS2)
    return upsert.upsert(target, source, ["email"],
                         update_cols=["full_name", "age", "country", "source_person_id",
                                      "source_created_at", "updated_at"])


def fact_events_lookup(spark, sf):
    return _fact_all(spark, sf)


def fact_events_good(spark, sf):
    return _fact_good(spark, sf)


def events_quarantine(spark, sf):
    _, bad = _good_bad(spark, sf)
    bad = bad.withColumn("quarantined_at", S.ntz(RUN_TS))
    return keys.assign_keys(bad, None, "quarantine_id", ["event_id"])


def quarantine_summary(spark, sf):
    _, bad = _good_bad(spark, sf)
    return quality.reject_summary(bad)


def split_reconciliation(spark, sf):
    return quality.reconcile_tagged(quality.tag_rejects(SI.events(spark, sf), quality.event_rules()))


def check_constraints_report(spark, sf):
    return quality.check_report(SI.events(spark, sf), quality.event_checks(),
                                not_null=["event_ts", "event_type"])


def unknown_person_counts(spark, sf):
    return marts.unknown_person_counts(_fact_all(spark, sf))


def mart_revenue_by_country(spark, sf):
    return marts.revenue_by_country(_fact_good(spark, sf), _dim_people(spark, sf))


def mart_purchases_per_person(spark, sf):
    return marts.purchases_per_person(_dim_people(spark, sf), _fact_good(spark, sf))


def zero_activity_left(spark, sf):
    return marts.activity_per_person(_dim_people(spark, sf), _fact_good(spark, sf))


def events_by_type(spark, sf):
    ev = SI.events(spark, sf)
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count("amount").alias("n_with_amount"),
        F.count_if(F.col("email").isNull()).alias("n_null_email"),
        F.sum("amount").cast("decimal(20,2)").alias("total_amount"))


def global_counts(spark, sf):
    return quality.counts_row({"raw_events_count": SI.events(spark, sf),
                               "raw_people_count": _raw_people(spark, sf),
                               "hourly_count": SI.hourly(spark, sf)})


# ---------------------------------------------------------------- hourly weather

def _raw_weather(spark, sf, ingested=RUN_TS):
    h = SI.hourly(spark, sf)
    return h.select("location_id", "ts", "temperature_2m", "precipitation", "windspeed_10m",
                    F.lit(DEFAULT_WEATHER_SOURCE).alias("source"), S.ntz(ingested).alias("ingested_at"),
                    "run_id")


def _stg_hourly(spark, sf):
    return model.stg_hourly(_raw_weather(spark, sf), SI.locations(spark, sf))


def _fact_hourly(spark, sf):
    stg = _stg_hourly(spark, sf)
    return model.build_fact_hourly(stg, model.dim_date_from(stg))


def _split(spark, sf):
    raw = _raw_weather(spark, sf)
    target = raw.where(F.col("ts") < S.ntz(TARGET_BEFORE))
    src = SI.hourly(spark, sf).where(F.col("ts") >= S.ntz(SOURCE_FROM)).select(
        "location_id", "ts",
        (F.col("temperature_2m") + F.lit(1.5)).cast(MEASURE).alias("temperature_2m"),
        (F.col("precipitation") + F.lit(0.25)).cast(MEASURE).alias("precipitation"),
        "windspeed_10m",
        (F.col("run_id") + 100).alias("run_id"))
    return target, src


def _upsert_hourly(target, source, run_ts):
    return upsert.upsert(target, source, ["location_id", "ts"],
                         update_cols=["temperature_2m", "precipitation", "windspeed_10m", "run_id"],
                         insert_defaults={"source": DEFAULT_WEATHER_SOURCE, "ingested_at": S.ntz(run_ts)},
                         touch={"ingested_at": S.ntz(run_ts)})


def stg_hourly_labelled(spark, sf):
    return _stg_hourly(spark, sf)


def dim_date_build(spark, sf):
    return model.dim_date_from(_stg_hourly(spark, sf))


def dim_date_insert_missing(spark, sf):
    orders = driver_table(spark, sf, "orders")
    raw = _raw_weather(spark, sf)
    target = model.dim_date_from(orders, "o_orderdate").unionByName(
        model.dim_date_from(raw.where(F.col("ts") < S.ntz(TARGET_BEFORE))))
    source = model.dim_date_from(raw.where(F.col("ts") >= S.ntz(SOURCE_FROM)))
    return upsert.insert_missing(target, source, ["date"])


def location_keys(spark, sf):
    dim = SI.locations(spark, sf)
    c = driver_table(spark, sf, "customer")
    k = F.floor(F.col("c_custkey") / 3)     # three names each; the last one stays
    incoming = c.select(*SI.coordinates(k), F.col("c_custkey").alias("said"),
                        F.concat_ws(" ", F.lit("City"), k.cast("string"), "c_mktsegment").alias("location_name"))
    return upsert.resolve_locations(dim, incoming, order_by="said")


def fact_hourly_load(spark, sf):
    return _fact_hourly(spark, sf)


def fact_hourly_upsert(spark, sf):
    target, src = _split(spark, sf)
    return _upsert_hourly(target, src, RUN_TS2)


def insert_update_counts(spark, sf):
    target, src = _split(spark, sf)
    return upsert.upsert_counts(target, src, ["location_id", "ts"])


def upsert_replay(spark, sf):
    target, src = _split(spark, sf)
    once = _upsert_hourly(target, src, RUN_TS2)
    return _upsert_hourly(once, src, RUN_TS2)


def layer_reconciliation(spark, sf):
    return quality.reconcile({"row_count_stg": _stg_hourly(spark, sf),
                              "row_count_fact": _fact_hourly(spark, sf)})


def orphan_dates(spark, sf):
    raw = _raw_weather(spark, sf)
    dim_early = model.dim_date_from(raw.where(F.col("ts") < S.ntz(TARGET_BEFORE)))
    return quality.orphan_count(_fact_hourly(spark, sf), dim_early, "date_key", "missing_dates")


def orphan_locations(spark, sf):
    return quality.orphan_count(_fact_hourly(spark, sf), SI.region_labels(spark, sf), "location_id",
                                "missing_location")


def duplicate_grain(spark, sf):
    li = driver_table(spark, sf, "lineitem")
    return keys.duplicate_keys(li, ["l_orderkey", "l_linenumber"], "duplicate_count")


def composite_distinct_gap(spark, sf):
    li = driver_table(spark, sf, "lineitem")
    per_key = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum(F.col("_n") - 1).cast("bigint").alias("duplicate_count"))


def mart_daily_avg(spark, sf):
    return marts.daily_avg_temperature(_fact_hourly(spark, sf), SI.locations(spark, sf))


def mart_daily_sum(spark, sf):
    return marts.daily_total_precipitation(_fact_hourly(spark, sf), SI.locations(spark, sf))


def mart_top5_per_location(spark, sf):
    return marts.windiest_hours(_fact_hourly(spark, sf), SI.locations(spark, sf), 5)


def watermark_per_location(spark, sf):
    return keys.watermarks(SI.hourly(spark, sf), "location_id", "ts", "max_ts")


def _all_locations(spark, sf):
    return SI.locations(spark, sf).unionByName(SI.extra_locations(spark, sf))


def fetch_windows(spark, sf):
    return incremental.fetch_windows(_all_locations(spark, sf), SI.hourly(spark, sf), WINDOWS_AS_OF)


def windowed_rows(spark, sf):
    h = SI.hourly(spark, sf)
    w = incremental.fetch_windows(_all_locations(spark, sf), h.where(F.col("ts") < S.ntz(TARGET_BEFORE)),
                                  INCR_AS_OF)
    return incremental.windowed_rows(h, w)


def run_state_latest(spark, sf):
    st = audit.runs_state(SI.run_events(spark, sf))
    return st.select("run_id", "status", "started_at", "finished_at")


def recent_runs(spark, sf):
    return marts.recent_runs(SI.runs(spark, sf), SI.PIPELINE_NAME, 10) \
        .select("run_id", "status", "row_count", "started_at", "finished_at")


def latest_run_rows(spark, sf):
    return marts.latest_run_rows(SI.hourly(spark, sf), SI.runs(spark, sf))


def qc_runs_report(spark, sf):
    return quality.qc_runs(SI.runs(spark, sf), SI.hourly(spark, sf), QC_WINDOW_START,
                           QC_WINDOW_HOURS, pipeline_name=SI.PIPELINE_NAME)


def qc_latest_run(spark, sf):
    """Post-load QC of only the newest run in the window (the reference's
    single-run check)."""
    return quality.qc_runs(SI.runs(spark, sf), SI.hourly(spark, sf), QC_WINDOW_START,
                           QC_WINDOW_HOURS, pipeline_name=SI.PIPELINE_NAME, latest_only=True)


def latest_day_per_location(spark, sf):
    return marts.latest_day_rows(_raw_weather(spark, sf), SI.locations(spark, sf))


def rows_per_run(spark, sf):
    return SI.hourly(spark, sf).groupBy("run_id").agg(F.count(F.lit(1)).alias("row_count"))


def filtered_slice(spark, sf):
    stg = _stg_hourly(spark, sf)
    return stg.where((F.col("location_name") == F.lit(FILTER_LOCATION))
                     & (S.ts_date("ts") == S.date_lit(FILTER_DAY))
                     & (F.col("temperature_2m").isNull() | ~(F.col("windspeed_10m") < 50))) \
        .select("location_name", "location_id", "ts", "temperature_2m", "windspeed_10m")


def unique_keys_report(spark, sf):
    return quality.unique_report(_raw_people(spark, sf).where(F.col("email").isNotNull()),
                                 ["email"], "people") \
        .unionByName(quality.unique_report(SI.hourly(spark, sf), ["location_id", "ts"], "hourly")) \
        .unionByName(quality.unique_report(driver_table(spark, sf, "lineitem"),
                                           ["l_orderkey", "l_linenumber"], "lineitem"))


def load_guard_full(spark, sf):
    return quality.load_guard(SI.hourly(spark, sf), ["location_id", "run_id"], expected_rows=24)


def load_guard_incremental(spark, sf):
    return quality.load_guard(SI.hourly(spark, sf), ["location_id", "run_id"], min_rows=1)


def location_labels(spark, sf):
    loc = SI.locations(spark, sf)
    return loc.select("location_id", "location_name", "latitude", "longitude",
                      S.location_label("latitude", "longitude").alias("default_label"),
                      S.path_slug("location_name").alias("city_slug"))


def run_params_json(spark, sf):
    r = SI.runs(spark, sf)
    return r.select("run_id", S.params_json(pipeline=F.col("pipeline_name"), run_id=F.col("run_id"),
                                            started=S.iso_text("started_at")).alias("params"))


def date_arithmetic(spark, sf):
    h = SI.hourly(spark, sf)
    text = S.iso_minute_text("ts")
    return h.select(
        "location_id", "ts", S.ts_date("ts").alias("date"),
        S.plus_hours("ts", 1).alias("next_hour"),
        S.ts_date(S.plus_hours("ts", 1)).alias("next_hour_date"),
        S.plus_days(S.date_lit(WINDOWS_AS_OF), 6).alias("horizon_end"),
        S.plus_hours(S.ntz(QC_WINDOW_START), 2).alias("qc_window_end"),
        text.alias("ts_text"),
        S.parse_payload_time(text).alias("ts_parsed"),
        S.date_key(S.ts_date("ts")).alias("date_key"),
        S.ntz(RUN_TS).alias("run_ts"))


def label_lookup_left(spark, sf):
    fact = _fact_hourly(spark, sf)
    j = lookup_join(fact, SI.region_labels(spark, sf), "location_id", "left")
    return j.groupBy("location_name").agg(F.count(F.lit(1)).alias("n_rows"),
                                          F.count_distinct("location_id").alias("n_locations"))


def payload_explode(spark, sf):
    from lakeshore.sources import payloads
    h = _raw_weather(spark, sf)
    dim = SI.locations(spark, sf)
    folded = payloads.fold_payloads(h, dim, missing_precipitation_every=5)
    rows = payloads.explode_with_ids(folded, dim)
    return rows.select("location_id", "ts", "temperature_2m", "precipitation", "windspeed_10m")


QUERIES = {
    "raw_null_profile": raw_null_profile,
    "stg_null_profile": stg_null_profile,
    "raw_age_out_of_range": raw_age_out_of_range,
    "raw_duplicate_emails": raw_duplicate_emails,
    "stg_people_clean": stg_people_clean,
    "dim_people_latest": dim_people_latest,
    "dim_people_upsert": dim_people_upsert,
    "fact_events_lookup": fact_events_lookup,
    "fact_events_good": fact_events_good,
    "events_quarantine": events_quarantine,
    "quarantine_summary": quarantine_summary,
    "split_reconciliation": split_reconciliation,
    "check_constraints_report": check_constraints_report,
    "unknown_person_counts": unknown_person_counts,
    "mart_revenue_by_country": mart_revenue_by_country,
    "mart_purchases_per_person": mart_purchases_per_person,
    "zero_activity_left": zero_activity_left,
    "events_by_type": events_by_type,
    "global_counts": global_counts,
    "stg_hourly_labelled": stg_hourly_labelled,
    "dim_date_build": dim_date_build,
    "dim_date_insert_missing": dim_date_insert_missing,
    "location_keys": location_keys,
    "fact_hourly_load": fact_hourly_load,
    "fact_hourly_upsert": fact_hourly_upsert,
    "insert_update_counts": insert_update_counts,
    "upsert_replay": upsert_replay,
    "layer_reconciliation": layer_reconciliation,
    "orphan_dates": orphan_dates,
    "orphan_locations": orphan_locations,
    "duplicate_grain": duplicate_grain,
    "composite_distinct_gap": composite_distinct_gap,
    "mart_daily_avg": mart_daily_avg,
    "mart_daily_sum": mart_daily_sum,
    "mart_top5_per_location": mart_top5_per_location,
    "watermark_per_location": watermark_per_location,
    "fetch_windows": fetch_windows,
    "windowed_rows": windowed_rows,
    "run_state_latest": run_state_latest,
    "recent_runs": recent_runs,
    "latest_run_rows": latest_run_rows,
    "qc_runs_report": qc_runs_report,
    "qc_latest_run": qc_latest_run,
    "latest_day_per_location": latest_day_per_location,
    "rows_per_run": rows_per_run,
    "filtered_slice": filtered_slice,
    "unique_keys_report": unique_keys_report,
    "load_guard_full": load_guard_full,
    "load_guard_incremental": load_guard_incremental,
    "location_labels": location_labels,
    "run_params_json": run_params_json,
    "date_arithmetic": date_arithmetic,
    "label_lookup_left": label_lookup_left,
    "payload_explode": payload_explode,
}


# ---------------------------------------------------------------- storage, export, streams

def _export_dir(spark, sf, dim=None):
    from lakeshore.plans.export import export_latest
    from lakeshore.session import scratch_dir
    d = scratch_dir(spark, "export")
    export_latest(_raw_weather(spark, sf), dim if dim is not None else SI.locations(spark, sf), d)
    return d


def export_roundtrip(spark, sf):
    from lakeshore.sources.landed_csv import read_landed_csv
    return read_landed_csv(spark, _export_dir(spark, sf)).drop("file")


def _loaded(spark, sf):
    from lakeshore.session import scratch_dir
    from lakeshore.streaming.file_load import load_new_files
    src = _export_dir(spark, sf)
    # files that are not CSV land beside the data and must be skipped
    SI.locations(spark, sf).select(F.col("location_name").alias("value")) \
        .write.mode("overwrite").text(f"{src}/notes")
    dst, ck = scratch_dir(spark, "cloud"), scratch_dir(spark, "ckpt")
    load_new_files(spark, src, dst, ck)
    load_new_files(spark, src, dst, ck)     # rerun: no new files, nothing loaded twice
    return spark.read.parquet(dst)


def load_new_files_once(spark, sf):
    return _loaded(spark, sf).drop("file")


def load_report(spark, sf):
    from lakeshore.streaming.file_load import load_report as report
    return report(_loaded(spark, sf)).select("dt", "city", "rows_loaded")


def export_with_empty_location(spark, sf):
    from lakeshore.plans.export import export_report, export_rows
    dim = _all_locations(spark, sf)
    return export_report(export_rows(_raw_weather(spark, sf), dim), dim).drop("location_id")


def full_refresh_with_defaults(spark, sf):
    from lakeshore.plans import storage
    from lakeshore.schemas import STG_PEOPLE
    from lakeshore.session import scratch_dir
    d = scratch_dir(spark, "stg_people")
    raw = _raw_people(spark, sf)
    defaults = {"load_ts": S.ntz(RUN_TS)}
    early = clean.clean_people(raw.where(F.col("created_at") <= S.ntz(PEOPLE_TARGET_UNTIL)), RUN_TS)
    storage.replace_table(storage.with_defaults(early.drop("load_ts"), STG_PEOPLE, defaults), d)
    full = clean.clean_people(raw, RUN_TS)
    storage.replace_table(storage.with_defaults(full.drop("load_ts"), STG_PEOPLE, defaults), d)
    return storage.read_current(spark, d)


def publish_rollback(spark, sf):
    from lakeshore.plans import storage
    from lakeshore.session import scratch_dir
    d = scratch_dir(spark, "raw_weather")
    target, src = _split(spark, sf)

    def checks(df):
        return quality.unique_report(df, ["location_id", "ts"], "raw_weather_hourly")

    storage.publish(target, d, checks)
    again = src.withColumn("source", F.lit(DEFAULT_WEATHER_SOURCE)) \
        .withColumn("ingested_at", S.ntz(RUN_TS2)).select(*target.columns)
    try:
        storage.publish(target.unionByName(again), d, checks)     # duplicate keys: must fail
    except quality.QualityError:
        pass
    else:
        raise AssertionError("publish of duplicate keys was not rejected")
    return storage.read_current(spark, d)


def stream_upsert(spark, sf):
    from lakeshore.schemas import RAW_WEATHER_HOURLY, RAW_WEATHER_STORED
    from lakeshore.session import scratch_dir
    from lakeshore.streaming.upsert_stream import stream_upsert as run
    landing, table, ck = (scratch_dir(spark, n) for n in ("landing", "raw_weather", "ckpt"))
    target, src = _split(spark, sf)
    args = dict(source_schema=RAW_WEATHER_HOURLY, table_schema=RAW_WEATHER_STORED,
                keys=["location_id", "ts"], partition_col="date", partition_expr=S.ts_date("ts"),
                defaults={"source": DEFAULT_WEATHER_SOURCE},
                update_cols=["temperature_2m", "precipitation", "windspeed_10m", "run_id", "ingested_at"],
                on_duplicate="error")
    target.write.mode("append").json(landing)                     # first drop
    run(spark, landing, table, ck, **args)
    src.withColumn("ingested_at", S.ntz(RUN_TS2)).write.mode("append").json(landing)   # second drop
    run(spark, landing, table, ck, **args)
    run(spark, landing, table, ck, **args)                        # nothing new: no change
    return read_parts(spark, table, RAW_WEATHER_STORED).drop("date")


def multi_location_load(spark, sf):
    from lakeshore.sources import payloads
    from lakeshore.session import scratch_dir
    landing = scratch_dir(spark, "payloads")
    dim = SI.locations(spark, sf)
    payloads.fold_payloads(_raw_weather(spark, sf), dim).write.mode("overwrite").json(landing)
    rows = payloads.explode_with_ids(payloads.read_payloads(spark, landing, multiline=False), dim)
    rows = rows.withColumn("day", S.ts_date("ts"))
    guard = quality.load_guard(rows, ["location_id", "day"], min_rows=1)
    runs = audit.allocate_run_ids(guard.select("location_id", "day"), SI.runs(spark, sf),
                                  ["location_id", "day"])
    out = runs.join(guard, ["location_id", "day"])
    return out.select("location_id", "day", "run_id",
                      F.when(F.col("passed"), "SUCCESS").otherwise("FAILED").alias("status"),
                      F.when(F.col("passed"), F.col("row_count")).otherwise(F.lit(0)).cast("bigint")
                      .alias("row_count"))


def _no_nulls(rows):
    """Every row, measures that are missing as 0, so that guards and QC pass."""
    return rows.withColumns({c: F.coalesce(c, F.lit(0).cast(MEASURE)) for c in ("temperature_2m", "windspeed_10m")})


def _flow_root(spark, sf, rows):
    """A new warehouse with ``rows`` landed as payload documents."""
    from lakeshore.session import scratch_dir
    from lakeshore.sources import payloads
    root = scratch_dir(spark, "warehouse")
    payloads.fold_payloads(rows, SI.locations(spark, sf)).write.mode("append").json(f"{root}/landing")
    return root


def _run_flow(spark, root, day, **options):
    from lakeshore.plans.flow import FlowConfig, run_daily_flow
    return run_daily_flow(spark, FlowConfig(root=root, landing=f"{root}/landing", run_ts=f"{day} 05:00:00",
                                            as_of=day, **options))


def daily_flow(spark, sf):
    """One daily run over complete payloads: QC passes, the latest day is
    exported and loaded."""
    return _run_flow(spark, _flow_root(spark, sf, _no_nulls(_raw_weather(spark, sf))), "2024-01-01")


def daily_flow_failing(spark, sf):
    """One daily run over payloads with NULL measures: runs fail and the gate
    stops export and load."""
    root = _flow_root(spark, sf, _raw_weather(spark, sf))
    return _run_flow(spark, root, "2024-01-01", raise_on_qc_failure=False)


def daily_flow_rerun(spark, sf):
    """Two runs on one day: the second has nothing new, and the cloud table
    holds each key once. Rows of the cloud table."""
    from lakeshore.schemas import CLOUD_STORED
    root = _flow_root(spark, sf, _no_nulls(_raw_weather(spark, sf)))
    _run_flow(spark, root, "2024-01-01")
    _run_flow(spark, root, "2024-01-01", raise_on_qc_failure=False)
    return read_parts(spark, f"{root}/cloud_raw_weather_hourly", CLOUD_STORED).select(
        "location_name", "ts", "temperature_2m")


def _land_overlap(spark, sf, landing):
    """Two fetches that overlap: the second changes measures from 01-03 on,
    renames every location and brings one that is new."""
    from lakeshore.sources import payloads
    dim, rows = SI.locations(spark, sf), _no_nulls(_raw_weather(spark, sf))
    payloads.fold_payloads(rows.where(S.ts_date("ts") <= S.date_lit("2024-01-05")), dim) \
        .write.mode("append").json(landing)
    later = rows.where(S.ts_date("ts") >= S.date_lit("2024-01-03")).withColumn(
        "temperature_2m", (F.col("temperature_2m") + 1).cast(MEASURE))
    renamed = dim.withColumn("location_name", F.concat(F.lit("New "), "location_name"))
    unseen = dim.where("location_id = 0").select(
        (F.col("location_id") - 100).alias("location_id"), F.lit("Unseen").alias("location_name"),
        F.lit(89.5).cast("decimal(9,6)").alias("latitude"), F.lit(0.5).cast("decimal(9,6)").alias("longitude"))
    payloads.fold_payloads(later.unionByName(later.where("location_id = 0").withColumn(
        "location_id", F.col("location_id") - 100)), renamed.unionByName(unseen)).write.mode("append").json(landing)


def overlapping_fetches(spark, sf):
    """Overlapping fetches, a rename and an unseen coordinate in one run of
    the flow: the last fetch wins. The raw table with its locations' names."""
    from lakeshore.plans.storage import read_current
    from lakeshore.schemas import RAW_WEATHER_STORED
    from lakeshore.session import scratch_dir
    root = scratch_dir(spark, "warehouse")
    _land_overlap(spark, sf, f"{root}/landing")
    _run_flow(spark, root, "2024-01-01")
    return model.stg_hourly(read_parts(spark, f"{root}/raw_weather_hourly", RAW_WEATHER_STORED),
                            read_current(spark, f"{root}/dim_location")).select(
        "location_name", "ts", "temperature_2m", "precipitation", "windspeed_10m")


def stream_overlapping_fetches(spark, sf):
    """The same in one micro-batch of the streaming loader, inside a window;
    the run's closing event beside each row."""
    from lakeshore.plans.storage import read_current
    from lakeshore.schemas import RAW_WEATHER_STORED, RUN_EVENTS
    from lakeshore.session import scratch_dir
    from lakeshore.streaming.upsert_stream import stream_payload_upsert as run
    root = scratch_dir(spark, "warehouse")
    _land_overlap(spark, sf, f"{root}/landing")
    run(spark, f"{root}/landing", f"{root}/raw", f"{root}/ckpt", f"{root}/dim", RUN_TS, f"{root}/events",
        window=("2024-01-02", "2024-01-06"))
    state = audit.runs_state(spark.read.schema(RUN_EVENTS).parquet(f"{root}/events"))
    rows = model.stg_hourly(read_parts(spark, f"{root}/raw", RAW_WEATHER_STORED), read_current(spark, f"{root}/dim"))
    return lookup_join(rows, state.select("run_id", "status", "row_count"), "run_id", "left").select(
        "location_name", "ts", "temperature_2m", "status", "row_count")


def _stream_windows(spark, sf):
    """Three drops of payloads into the stream of daily loads: first loads; an
    overlap with warmer rows five days later; everything again, warmer still,
    on a day whose windows end before most locations' marks."""
    from lakeshore.plans.flow import FlowConfig
    from lakeshore.session import scratch_dir
    from lakeshore.sources import payloads
    from lakeshore.streaming.window_stream import stream_daily_loads
    root = scratch_dir(spark, "warehouse")
    dim, rows = SI.locations(spark, sf), _raw_weather(spark, sf)
    for warmer, (day, kept) in enumerate((("2024-01-01", F.col("ts") < S.ntz("2024-01-10")),
                                          ("2024-01-06", F.col("ts") >= S.ntz("2024-01-06")),
                                          ("2024-01-02", F.lit(True)))):
        drop = rows.where(kept).withColumn("temperature_2m", (F.col("temperature_2m") + warmer).cast(MEASURE))
        payloads.fold_payloads(drop, dim).write.mode("append").json(f"{root}/landing")
        stream_daily_loads(spark, FlowConfig(root=root, landing=f"{root}/landing", run_ts=f"{day} 05:00:00", as_of=day),
                           f"{root}/_checkpoints/loads")
    return root


def stream_window_runs(spark, sf):
    """The runs of the three drops: window state, outcome and rows of each."""
    from lakeshore.plans.storage import read_current
    from lakeshore.schemas import RUN_EVENTS
    root = _stream_windows(spark, sf)
    params = F.from_json("params", "location_id long, state string, watermark_ts string")
    state = audit.runs_state(spark.read.schema(RUN_EVENTS).parquet(f"{root}/run_events")).withColumn("p", params)
    names = read_current(spark, f"{root}/dim_location").select("location_id", "location_name")
    return state.select("run_id", S.ts_date("started_at").alias("as_of"), "p.location_id", "p.state",
                        F.col("p.watermark_ts").cast("timestamp_ntz").alias("watermark"), "status", "row_count") \
        .join(names, "location_id").drop("location_id")


def stream_window_rows(spark, sf):
    """The rows of the three drops and the day of the run that loaded each."""
    from lakeshore.plans.storage import read_current
    from lakeshore.schemas import RAW_WEATHER_STORED, RUN_EVENTS
    root = _stream_windows(spark, sf)
    state = audit.runs_state(spark.read.schema(RUN_EVENTS).parquet(f"{root}/run_events"))
    rows = model.stg_hourly(read_parts(spark, f"{root}/raw_weather_hourly", RAW_WEATHER_STORED),
                            read_current(spark, f"{root}/dim_location"))
    return lookup_join(rows, state.select("run_id", S.ts_date("started_at").alias("as_of")), "run_id", "inner").select(
        "location_name", "ts", "temperature_2m", "precipitation", "windspeed_10m", "as_of")


def bad_payloads(spark, sf):
    """Payloads with a garbage number (each fifth location) and truncated ones
    (each seventh): they fail their runs, the other rows are loaded. Runs by
    location name (NULL: the payload names none that can be read)."""
    from lakeshore.plans.storage import read_current
    from lakeshore.session import scratch_dir
    from lakeshore.sources import payloads
    root = scratch_dir(spark, "warehouse")
    dim = SI.locations(spark, sf)
    docs = payloads.fold_payloads(_no_nulls(_raw_weather(spark, sf)), dim)
    named = lookup_join(docs, dim.select("location_id", "location_name"), "location_name", "inner")
    text = F.to_json(F.struct("latitude", "longitude", "location_name", "hourly"))
    k, day = F.col("location_id"), F.substring(F.element_at("hourly.time", 1), 9, 2)
    broken = F.when((k % 5 == 0) & (day == "03"), F.regexp_replace(text, r'"temperature_2m":\["[^"]*"', 
                                                                   '"temperature_2m":["n/a"')) \
        .when((k % 7 == 3) & (day == "05"), F.expr("left(__t, instr(__t, '\"time\"') + 12)")).otherwise(text)
    named.withColumn("__t", text).select(broken.alias("value")).write.text(f"{root}/landing")
    runs = _run_flow(spark, root, "2024-01-01", raise_on_qc_failure=False)
    names = read_current(spark, f"{root}/dim_location").select("location_id", "location_name")
    return runs.join(names, "location_id", "left").select("location_name", "status", "row_count")


def reexport_load_by_key(spark, sf):
    from lakeshore.plans.export import export_latest
    from lakeshore.schemas import CLOUD_STORED, CLOUD_WEATHER_HOURLY
    from lakeshore.session import scratch_dir
    from lakeshore.streaming.file_load import load_new_files_by_key
    src = _export_dir(spark, sf)
    dst, ck = scratch_dir(spark, "cloud"), scratch_dir(spark, "ckpt")
    load_new_files_by_key(spark, src, dst, ck)
    export_latest(_raw_weather(spark, sf), SI.locations(spark, sf), src)   # same rows, new file names
    load_new_files_by_key(spark, src, dst, ck)
    return read_parts(spark, dst, CLOUD_STORED).select(*CLOUD_WEATHER_HOURLY.fieldNames())


def people_mart_build(spark, sf):
    """The people / events build on stored tables; revenue read back."""
    from lakeshore.plans.people import build_people_mart
    from lakeshore.session import scratch_dir
    out = build_people_mart(spark, scratch_dir(spark, "people"), _raw_people(spark, sf),
                            SI.events(spark, sf), RUN_TS)
    return out["revenue_by_country"]


def model_refresh_build(spark, sf):
    """The hourly model refresh on stored tables, twice: the second run sees
    only the days that changed in the raw table since the first; daily
    averages read back."""
    from lakeshore.plans import storage
    from lakeshore.plans.model_refresh import refresh_model
    from lakeshore.schemas import RAW_WEATHER_STORED
    from lakeshore.session import scratch_dir
    root = scratch_dir(spark, "model")
    raw, dim = f"{root}/raw", SI.locations(spark, sf)
    target, src = _split(spark, sf)
    seen = 0
    for rows, run_ts in ((target, RUN_TS), (src, RUN_TS2)):
        storage.upsert_partitions(
            spark, raw, RAW_WEATHER_STORED, rows, ["location_id", "ts"], "date", S.ts_date("ts"),
            update_cols=["temperature_2m", "precipitation", "windspeed_10m", "run_id"],
            insert_defaults={"source": DEFAULT_WEATHER_SOURCE, "ingested_at": S.ntz(run_ts)},
            touch={"ingested_at": S.ntz(run_ts)})
        days = storage.parts_since(spark, raw, seen)
        out = refresh_model(spark, root, read_parts(spark, raw, RAW_WEATHER_STORED, only=days), dim, days)
        seen = storage.current_version(spark, raw)
    return out["daily_avg"]


def _refreshed_marts(spark, sf):
    """Three changes of the stored fact, the marts refreshed after each: the
    early rows; the later ones with other measures; calm on 01-10 .. 01-12, which
    takes hours out of many locations' windiest."""
    from lakeshore.plans import storage
    from lakeshore.plans.mart_refresh import read_marts, refresh_marts
    from lakeshore.schemas import RAW_WEATHER_STORED
    from lakeshore.session import scratch_dir
    root = scratch_dir(spark, "marts")
    fact = f"{root}/fact"
    target, src = _split(spark, sf)
    calm = SI.hourly(spark, sf).where(S.ts_date("ts").between(S.date_lit("2024-01-10"), S.date_lit("2024-01-12"))) \
        .withColumn("windspeed_10m", (F.col("windspeed_10m") / 100).cast(MEASURE)).drop("run_id")
    for rows in (target.drop("source", "ingested_at"), src, calm):
        storage.upsert_partitions(
            spark, fact, RAW_WEATHER_STORED, rows, ["location_id", "ts"], "date", S.ts_date("ts"),
            insert_defaults={"source": DEFAULT_WEATHER_SOURCE, "ingested_at": S.ntz(RUN_TS)})
        refresh_marts(spark, root, fact, RAW_WEATHER_STORED)
    return read_marts(spark, root, SI.locations(spark, sf))


def windiest_after_updates(spark, sf):
    """The five windiest hours per location, kept up to date from changed days."""
    return _refreshed_marts(spark, sf)["windiest"]


def daily_total_after_updates(spark, sf):
    """Daily precipitation per location, kept up to date from changed days."""
    return _refreshed_marts(spark, sf)["daily_total"]


def content_differences(spark, sf):
    """A copy of the hourly rows with changed, lost, doubled and added rows
    against the original: exactly these, found down a tree of checksums."""
    rows = SI.hourly(spark, sf).withColumn("date", S.ts_date("ts"))
    k, day = F.col("location_id"), F.dayofmonth("ts")
    copy = rows.where(~((k % 40 == 3) & (day == 6))).withColumn(
        "precipitation", F.when((k % 50 == 7) & (day == 5), F.col("precipitation") + 1).otherwise(F.col("precipitation"))
        .cast(MEASURE))
    copy = copy.unionByName(copy.where((k % 45 == 11) & (day == 9))).unionByName(
        rows.where((k % 60 == 13) & (day == 12)).withColumn("location_id", -k))
    return quality.reconcile_content(rows, copy, [["date"], ["date", "location_id"], ["date", "location_id", "ts"]])


def hour_gaps(spark, sf):
    """Missing hours of every location in January, also of those without rows."""
    return quality.hour_gaps(SI.hourly(spark, sf), _all_locations(spark, sf), "location_id", "2024-01-01 00:00:00",
                             "2024-01-31 23:00:00")


def latest_day_stored(spark, sf):
    """latest_day_per_location of a stored table that two upserts made, read
    by the counts beside its commits."""
    from lakeshore.plans import storage
    from lakeshore.plans.export import stored_latest_rows
    from lakeshore.schemas import RAW_WEATHER_STORED
    from lakeshore.session import scratch_dir
    path = scratch_dir(spark, "raw_weather")
    for rows, run_ts in zip(_split(spark, sf), (RUN_TS, RUN_TS2), strict=True):
        storage.upsert_partitions(
            spark, path, RAW_WEATHER_STORED, rows, ["location_id", "ts"], "date", S.ts_date("ts"),
            summary_by=["location_id"], update_cols=["temperature_2m", "precipitation", "windspeed_10m", "run_id"],
            insert_defaults={"source": DEFAULT_WEATHER_SOURCE, "ingested_at": S.ntz(run_ts)},
            touch={"ingested_at": S.ntz(run_ts)})
    return stored_latest_rows(spark, path, RAW_WEATHER_STORED, SI.locations(spark, sf))


def heavy_key_lookup(spark, sf):
    """A label lookup above the broadcast bound where one location holds a
    third of the rows."""
    fact = SI.hourly(spark, sf).select(
        F.when(F.hour("ts") % 3 == 0, F.lit(7)).when(F.hour("ts") % 23 == 1, F.lit(None)).otherwise(F.col("location_id"))
        .cast("bigint").alias("location_id"), "ts", "precipitation")
    labelled = lookup_join(fact, SI.locations(spark, sf).where("location_id % 10 <> 9"), "location_id", "left", max_rows=0)
    return labelled.groupBy("location_name").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("precipitation").cast(
        "decimal(28,6)").alias("total_precipitation"), F.max("ts").alias("last_ts"))


def stream_payload_upsert(spark, sf):
    """Two drops of landed payload documents (early days, then later days
    with changed measures) streamed into the raw table; run id = batch."""
    from lakeshore.schemas import RAW_WEATHER_STORED
    from lakeshore.session import scratch_dir
    from lakeshore.sources import payloads
    from lakeshore.streaming.upsert_stream import stream_payload_upsert as run
    landing, table, ck = (scratch_dir(spark, n) for n in ("landing", "raw_weather", "ckpt"))
    dim = SI.locations(spark, sf)
    target, src = _split(spark, sf)
    known = scratch_dir(spark, "dim_location")
    replace_table(dim, known)
    payloads.fold_payloads(target, dim).write.mode("append").json(landing)
    run(spark, landing, table, ck, known, RUN_TS, not_null=())
    payloads.fold_payloads(src, dim).write.mode("append").json(landing)
    run(spark, landing, table, ck, known, RUN_TS2, not_null=())
    return read_parts(spark, table, RAW_WEATHER_STORED) \
        .select("location_id", "ts", "temperature_2m", "precipitation", "windspeed_10m", "run_id")


def daily_flow_incremental(spark, sf):
    """Two daily runs a week apart on the same landed payloads: the second
    run's windows start at each location's high-water mark. Summary of the
    second run."""
    root = _flow_root(spark, sf, _no_nulls(_raw_weather(spark, sf)))
    _run_flow(spark, root, "2024-01-01")
    return _run_flow(spark, root, "2024-01-08")


def publish_partitioned_after_failure(spark, sf):
    """A partitioned publish that fails its checks, then a good one: no row of
    the first is read."""
    from lakeshore.plans import storage
    from lakeshore.session import scratch_dir
    d = scratch_dir(spark, "raw_weather")
    target, src = _split(spark, sf)

    def checks(df):
        return quality.unique_report(df, ["location_id", "ts"], "raw_weather_hourly")

    day = S.ts_date("ts").alias("date")
    twice = _raw_weather(spark, sf).unionByName(target).select("*", day)
    try:
        storage.publish(twice, d, checks, partition_by=["date"])
    except quality.QualityError:
        pass
    else:
        raise AssertionError("publish of duplicate keys was not rejected")
    storage.publish(target.select("*", day), d, checks, partition_by=["date"])
    return storage.read_current(spark, d).select(*target.columns)


def load_report_files(spark, sf):
    """Rows and errors per loaded file and in total: (status, rows, errors)."""
    from lakeshore.plans.ledger_load import load_files
    from lakeshore.session import scratch_dir
    src = _export_dir(spark, sf)
    SI.locations(spark, sf).select(F.col("location_name").alias("value")).write.mode("overwrite").text(f"{src}/notes")
    r = load_files(spark, src, scratch_dir(spark, "cloud"))
    return r.rollup("status").agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("errors_seen").alias("errors_seen")) \
        .withColumn("status", F.coalesce("status", F.lit("TOTAL")))


LANDED_PARTS = 12   # landed CSV files hold the locations of equal remainder


def _land_csv(rows, folder, spoiled=False):
    """``rows`` as hand-made CSV, a file for each remainder of location_id;
    ``spoiled``: garbage numbers, short records, open quotes, one kind a file."""
    k, part, day, hour = F.col("location_id"), F.col("location_id") % LANDED_PARTS, F.dayofmonth("ts"), F.hour("ts")
    number = F.when(F.lit(spoiled) & (part == 4), F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string"))
    warmth = F.when(F.lit(spoiled) & (part == 1) & (day == 3), "n/a").otherwise(
        F.coalesce(F.col("temperature_2m").cast("string"), F.lit("NULL")))
    close = F.when(F.lit(spoiled) & (part == 3) & (day == 4) & (hour % 3 == 0), "").otherwise('"')
    tail = F.when(F.lit(spoiled) & (part == 2) & (day == 5), "").otherwise(
        F.concat(F.lit(f",{RUN_TS},"), F.col("run_id").cast("string")))
    line = F.concat(F.lit('"'), "location_name", close, F.lit(","), number, F.lit(","),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(","), warmth, F.lit(","),
                    F.col("precipitation").cast("string"), F.lit(","),
                    F.coalesce(F.col("windspeed_10m").cast("string"), F.lit("")), F.lit(",open-meteo"), tail)
    from lakeshore.fixed import EXPORT_COLUMNS
    lines = rows.select(part.alias("part"), line.alias("value"), "location_id", "ts")
    header = lines.select("part").distinct().select(
        "part", F.lit(",".join(EXPORT_COLUMNS)).alias("value"), F.lit(None).cast("bigint").alias("location_id"),
        F.lit(None).cast("timestamp_ntz").alias("ts"))
    lines.unionByName(header).repartition("part").sortWithinPartitions("part", F.col("location_id").asc_nulls_first(), "ts") \
        .select("part", "value").write.mode("append").partitionBy("part").text(folder)


def _part(file="file"):
    return F.regexp_extract(file, "part=([0-9]+)", 1).cast("int").alias("part")


def _load_spoiled(spark, sf, on_error):
    from lakeshore.plans.ledger_load import load_files
    from lakeshore.session import scratch_dir
    src, root = scratch_dir(spark, "landed"), scratch_dir(spark, "cloud")
    _land_csv(_stg_hourly(spark, sf), src, spoiled=True)
    load_files(spark, src, root, on_error=on_error, glob="*.txt")
    return root


def load_files_continue(spark, sf):
    """Landed files with wrong records, loaded as far as they can be: the
    account of each file."""
    from lakeshore.plans.ledger_load import load_history
    return load_history(spark, _load_spoiled(spark, sf, "continue")).select(
        _part(), "status", "rows_parsed", "rows_loaded", "errors_seen", "first_error", "first_error_row",
        "first_error_column")


def load_rejected_records(spark, sf):
    """The records of the same files that were not loaded, and why."""
    from lakeshore.plans.ledger_load import rejected_records
    return rejected_records(spark, _load_spoiled(spark, sf, "continue")).select(
        _part(), "row_number", "column", "value", "reason", "record")


def load_files_skip_file(spark, sf):
    """The same files, those with an error left out: the rows loaded."""
    from lakeshore.plans.ledger_load import loaded_rows
    return loaded_rows(spark, _load_spoiled(spark, sf, "skip_file")).drop("file")


def load_by_content(spark, sf):
    """Three loads: the early days; then a renamed copy of one file, a file
    rewritten in place and a new one; then nothing new. The ledger, with the
    rows that the table holds of each file."""
    from lakeshore.plans.ledger_load import load_files, load_history, loaded_rows
    from lakeshore.session import scratch_dir
    src, aside, root = (scratch_dir(spark, n) for n in ("landed", "aside", "cloud"))
    rows = _stg_hourly(spark, sf)
    late = rows.where(F.col("ts") >= S.ntz(TARGET_BEFORE))
    part = F.col("location_id") % LANDED_PARTS
    _land_csv(rows.where(F.col("ts") < S.ntz(TARGET_BEFORE)), src)
    load_files(spark, src, root, glob="*.txt")
    _land_csv(late.where(part.isin(2, 3)), aside)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(src).getFileSystem(conf)

    def files(folder):
        return [s.getPath() for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("part-")]
    for old in files(f"{src}/part=1"):
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, old, fs, path(f"{src}/part=101/renamed.txt"), False, conf)
    for old, new in zip(files(f"{src}/part=2"), files(f"{aside}/part=2"), strict=True):
        fs.delete(old, False)
        fs.rename(new, old)
    for new in files(f"{aside}/part=3"):
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, new, fs, path(f"{src}/part=203/new.txt"), False, conf)
    load_files(spark, src, root, glob="*.txt")
    load_files(spark, src, root, glob="*.txt")
    held = loaded_rows(spark, root).groupBy("file").agg(F.count(F.lit(1)).alias("rows_in_table"))
    return load_history(spark, root).join(held, "file", "left").select(
        "load", _part(), "status", "rows_parsed", "rows_loaded", F.coalesce("rows_in_table", F.lit(0)).alias("rows_in_table"))


def export_clashing_names(spark, sf):
    """Pairs of locations whose different names have one slug: a folder each."""
    from lakeshore.plans.export import export_report, export_rows
    k = F.col("location_id")
    dim = SI.locations(spark, sf).withColumn(
        "location_name", F.concat(F.when(k % 2 == 0, "St. Łódź ").otherwise("St Łódź "),
                                  F.floor(k / 2).cast("string")))
    return export_report(export_rows(_raw_weather(spark, sf), dim), dim)


def export_one_day(spark, sf):
    """Export of a fixed day (``export_date``)."""
    from lakeshore.plans.export import export_rows
    return export_rows(_raw_weather(spark, sf), SI.locations(spark, sf), FILTER_DAY).select(
        "location_id", "ts", "temperature_2m", "dt", "city")


def windowed_rows_strict(spark, sf):
    """As windowed_rows, hours already loaded left out (``strict_hour``)."""
    h = SI.hourly(spark, sf)
    w = incremental.fetch_windows(_all_locations(spark, sf), h.where(F.col("ts") < S.ntz(TARGET_BEFORE)), INCR_AS_OF)
    return incremental.windowed_rows(h, w, strict_hour=True)


def load_guard_week(spark, sf):
    """The full-window guard with its 168 hours."""
    from lakeshore.fixed import FULL_WINDOW_HOURS
    return quality.load_guard(SI.hourly(spark, sf), ["location_id"], expected_rows=FULL_WINDOW_HOURS)


def fact_events_lookup_shuffled(spark, sf):
    """fact_events_lookup with the key set above the broadcast bound."""
    flagged = model.lookup_flag(SI.events(spark, sf), _dim_people(spark, sf), "email", "is_known_person", max_rows=0)
    return flagged.select("event_id", "event_ts", "email", "event_type", "amount", "source", "is_known_person",
                          S.ntz(RUN_TS).alias("load_ts"))


def literal_rows(spark, sf):
    """Rows given as literals, inserted before the table's own."""
    from lakeshore.plans.storage import with_defaults
    from lakeshore.schemas import RAW_PEOPLE
    given = spark.createDataFrame([(-1, "Ann Able", 23, None, "India"), (-2, None, None, "bo@example.com", " ")],
                                  "person_id long, full_name string, age int, email string, country string")
    rows = with_defaults(given, RAW_PEOPLE, {"created_at": S.ntz(RUN_TS)})
    return clean.clean_people(rows.unionByName(_raw_people(spark, sf).select(*rows.columns)), RUN_TS)


QUERIES.update({f.__name__: f for f in (
    daily_flow_failing, daily_flow_rerun, overlapping_fetches, stream_overlapping_fetches, bad_payloads,
    publish_partitioned_after_failure, load_report_files, load_files_continue, load_rejected_records,
    load_files_skip_file, load_by_content, stream_window_runs, stream_window_rows,
    windiest_after_updates, daily_total_after_updates, content_differences, hour_gaps, latest_day_stored,
    heavy_key_lookup, export_clashing_names, export_one_day,
    windowed_rows_strict, load_guard_week, fact_events_lookup_shuffled, literal_rows)})
QUERIES.update({
    "daily_flow_incremental": daily_flow_incremental,
    "stream_payload_upsert": stream_payload_upsert,
    "model_refresh_build": model_refresh_build,
    "people_mart_build": people_mart_build,
    "reexport_load_by_key": reexport_load_by_key,
    "export_roundtrip": export_roundtrip,
    "load_new_files": load_new_files_once,
    "load_report": load_report,
    "export_with_empty_location": export_with_empty_location,
    "full_refresh_with_defaults": full_refresh_with_defaults,
    "publish_rollback": publish_rollback,
    "stream_upsert": stream_upsert,
    "multi_location_load": multi_location_load,
    "daily_flow": daily_flow,
})


def stg_view_sql(spark, sf):
    """The staged view, read with SQL."""
    from lakeshore.plans.views import register_staged_view
    register_staged_view(_raw_weather(spark, sf), SI.locations(spark, sf))
    return spark.sql("SELECT * FROM stg_weather_hourly")


def mart_daily_avg_sql(spark, sf):
    """M4 written as Spark SQL over views of the fact and the dimension."""
    from lakeshore.plans.views import DAILY_AVG_SQL, register_views
    register_views(spark, {"fact_weather_hourly": _fact_hourly(spark, sf),
                           "dim_location": SI.locations(spark, sf)})
    return spark.sql(DAILY_AVG_SQL)


QUERIES.update({"stg_view_sql": stg_view_sql, "mart_daily_avg_sql": mart_daily_avg_sql})
