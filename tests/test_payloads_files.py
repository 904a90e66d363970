"""Payload explode edge cases, CSV export/load round trip, snapshots,
publish rollback, streaming replay and the daily flow."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import quality
from lakeshore.plans import storage
from lakeshore.plans.export import export_latest
from lakeshore.session import local_path
from lakeshore.sources import payloads
from lakeshore.sources.landed_csv import read_landed_csv
from lakeshore.streaming.file_load import load_new_files, load_report

TIMES = ["2026-02-23T00:00", "2026-02-23T01:00", "2026-02-23T02:00"]


def _write(path, name, doc):
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), name), "w") as f:
        json.dump(doc, f)


def test_explode_null_short_missing(spark, scratch):
    base = {"latitude": 41.8781, "longitude": -87.6298}
    _write(scratch, "a.json", {**base, "hourly": {"time": TIMES, "temperature_2m": [1.5, None, 1.0],
                                                  "precipitation": [0.0, 0.1], "windspeed_10m": [9, 8, 7, 6]}})
    _write(scratch, "b.json", {"latitude": 40.7128, "longitude": -74.006,
                               "hourly": {"time": TIMES[:2], "temperature_2m": [3.0, 4.0]}})
    rows = payloads.explode_hourly(payloads.read_payloads(spark, scratch)).orderBy("latitude", "ts").collect()
    assert len(rows) == 5                                   # no row lost to a NULL or short array
    got = [(float(r.temperature_2m) if r.temperature_2m is not None else None,
            float(r.precipitation) if r.precipitation is not None else None,
            float(r.windspeed_10m) if r.windspeed_10m is not None else None) for r in rows]
    assert got == [(3.0, None, None), (4.0, None, None),
                   (1.5, 0.0, 9.0), (None, 0.1, 8.0), (1.0, None, 7.0)]
    guard = quality.load_guard(payloads.explode_hourly(payloads.read_payloads(spark, scratch)),
                               ["latitude"], expected_rows=3).collect()
    assert sorted((r.latitude, r.passed) for r in guard) == [(40.7128, False), (41.8781, False)]


def _weather(spark):
    rows = [(1, f"2026-02-2{d} {h:02d}:00:00", 1.0 + h, None if h == 3 else 0.5, 5.0, "open-meteo",
             "2026-03-01 05:00:00", 7) for d in (3, 4) for h in range(24)]
    rows += [(2, f"2026-02-24 {h:02d}:00:00", 2.0, 0.0, 1.0, "open-meteo",
              "2026-03-01 05:00:00", 8) for h in range(24)]
    df = spark.createDataFrame(rows, "location_id long, ts string, temperature_2m double, precipitation double, "
                                     "windspeed_10m double, source string, ingested_at string, run_id long")
    return df.select("location_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                     *[F.col(c).cast("decimal(18,6)").alias(c) for c in
                       ["temperature_2m", "precipitation", "windspeed_10m"]],
                     "source", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), "run_id")


def _dim(spark):
    return spark.createDataFrame([(1, "Chicago, IL"), (2, "New York, NY"), (3, "Los Angeles, CA")],
                                 "location_id long, location_name string")


def test_export_and_load_once(spark, scratch):
    out = f"{scratch}/export"
    export_latest(_weather(spark), _dim(spark), out)
    dirs = sorted(d for d in os.listdir(local_path(out)) if d.startswith("dt="))
    assert dirs == ["dt=2026-02-24"]
    cities = sorted(os.listdir(os.path.join(local_path(out), dirs[0])))
    assert cities == ["city=Chicago_IL", "city=New_York_NY"]
    back = read_landed_csv(spark, out)
    assert back.count() == 48 and back.where("location_name = 'Chicago, IL'").count() == 24
    assert back.where(F.col("precipitation").isNull()).count() == 1
    # a hand-landed file with the text NULL, a quoted comma, and a non-CSV file
    extra = os.path.join(local_path(out), "dt=2026-02-25", "city=Chicago_IL")
    os.makedirs(extra)
    with open(os.path.join(extra, "weather_hourly.csv"), "w") as f:
        f.write("location_name,location_id,ts,temperature_2m,precipitation,windspeed_10m,source,ingested_at,run_id\n")
        f.write('"Chicago, IL",1,2026-02-25 00:00:00,NULL,,3.5,open-meteo,2026-03-01 05:00:00,9\n')
    with open(os.path.join(extra, "notes.txt"), "w") as f:
        f.write("not data\n")
    dst, ck = f"{scratch}/cloud", f"{scratch}/ck"
    load_new_files(spark, out, dst, ck)
    load_new_files(spark, out, dst, ck)                     # rerun loads nothing twice
    loaded = spark.read.parquet(dst)
    assert loaded.count() == 49
    row = loaded.where("run_id = 9").first()
    assert row.location_name == "Chicago, IL" and row.temperature_2m is None and row.precipitation is None
    rep = {(r.dt, r.city): r.rows_loaded for r in load_report(loaded).collect()}
    assert rep == {("2026-02-24", "Chicago_IL"): 24, ("2026-02-24", "New_York_NY"): 24,
                   ("2026-02-25", "Chicago_IL"): 1}


def test_garbage_measure_fails(spark, scratch):
    d = os.path.join(local_path(scratch), "g")
    os.makedirs(d)
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("location_name,location_id,ts,temperature_2m,precipitation,windspeed_10m,source,ingested_at,run_id\n")
        f.write("a,1,2026-02-25 00:00:00,abc,,3.5,s,2026-03-01 05:00:00,9\n")
    with pytest.raises(Exception):
        read_landed_csv(spark, d).collect()


def test_publish_rollback_keeps_previous(spark, scratch):
    df = _weather(spark)

    def checks(x):
        return quality.unique_report(x, ["location_id", "ts"], "raw")

    assert storage.publish(df, scratch, checks) == 1
    with pytest.raises(quality.QualityError):
        storage.publish(df.unionByName(df.limit(3)), scratch, checks)
    assert storage.current_version(spark, scratch) == 1
    assert storage.read_current(spark, scratch).count() == df.count()
    assert storage.replace_table(df.limit(5), scratch) == 2
    assert storage.read_current(spark, scratch).count() == 5


def test_partition_upsert_rewrites_touched_days_only(spark, scratch):
    from lakeshore.functions.scalar import ts_date
    from lakeshore.schemas import RAW_WEATHER_STORED
    df = _weather(spark)
    args = dict(update_cols=["temperature_2m", "run_id"], on_duplicate="error")
    storage.upsert_partitions(spark, scratch, RAW_WEATHER_STORED, df, ["location_id", "ts"], "date",
                              ts_date("ts"), **args)
    first = storage.committed_versions(spark, scratch).collect()
    change = df.where("ts >= '2026-02-24 10:00:00' and location_id = 1") \
        .withColumn("temperature_2m", F.lit(99).cast("decimal(18,6)")).withColumn("run_id", F.lit(10).cast("long"))
    touched = storage.upsert_partitions(spark, scratch, RAW_WEATHER_STORED, change, ["location_id", "ts"],
                                        "date", ts_date("ts"), **args)
    assert [str(t) for t in touched] == ["2026-02-24"]
    second = storage.committed_versions(spark, scratch).orderBy("version").collect()
    assert second[:1] == first and second[1].parts == ["2026-02-24"]
    written = os.listdir(os.path.join(local_path(scratch), second[1].folder))
    assert [d for d in written if d.startswith("date=")] == ["date=2026-02-24"]
    t = storage.read_parts(spark, scratch, RAW_WEATHER_STORED)
    assert t.count() == 72 and t.where("run_id = 10").count() == 14
    assert t.where("temperature_2m = 99").count() == 14


def test_daily_flow_exports_and_loads(spark, scratch):
    from lakeshore.plans.flow import FlowConfig, run_daily_flow
    landing = f"{scratch}/landing"
    cities = [(41.8781, -87.6298, "Chicago, IL"), (40.7128, -74.0060, "New York, NY")]
    times = [f"2026-03-0{1 + h // 24}T{h % 24:02d}:00" for h in range(168)]
    for i, (lat, lon, name) in enumerate(cities):
        _write(landing, f"p{i}.json", {"latitude": lat, "longitude": lon, "location_name": name,
                                       "hourly": {"time": times, "temperature_2m": [1.0] * 168,
                                                  "precipitation": [0.0] * 168, "windspeed_10m": [3.0] * 168}})
    cfg = FlowConfig(root=f"{scratch}/wh", landing=landing, run_ts="2026-03-01 05:00:00", as_of="2026-03-01",
                     multiline_payloads=True, expected_rows=168)
    summary = {r.location_id: r for r in run_daily_flow(spark, cfg).collect()}
    assert {k: (r.status, r.row_count, r.rows_exported, r.rows_loaded) for k, r in summary.items()} == {
        1: ("SUCCESS", 168, 24, 24), 2: ("SUCCESS", 168, 24, 24)}
    # replay of the same landing on the next run: later window, nothing new
    cfg2 = FlowConfig(root=f"{scratch}/wh", landing=landing, run_ts="2026-03-02 05:00:00", as_of="2026-03-02",
                      multiline_payloads=True, raise_on_qc_failure=False)
    again = {r.location_id: r.status for r in run_daily_flow(spark, cfg2).collect()}
    assert again == {1: "FAILED", 2: "FAILED"}        # rows_touched = 0 -> guard fails, data kept
    from lakeshore.schemas import RAW_WEATHER_STORED
    assert storage.read_parts(spark, cfg.path("raw_weather_hourly"), RAW_WEATHER_STORED).count() == 336
    from lakeshore.__main__ import main
    assert main(["qc", "--root", f"{scratch}/wh", "--run-ts", "2026-03-01 05:00:00"]) == 0
    assert main(["qc", "--root", f"{scratch}/wh", "--run-ts", "2026-03-02 05:00:00"]) == 1


def test_stream_upsert_full_replay_is_harmless(spark, scratch):
    from lakeshore.functions.scalar import ts_date
    from lakeshore.schemas import RAW_WEATHER_HOURLY, RAW_WEATHER_STORED
    from lakeshore.streaming.upsert_stream import stream_upsert
    landing, table = f"{scratch}/landing", f"{scratch}/table"
    df = _weather(spark)
    df.where("location_id = 1").write.mode("append").json(landing)
    args = dict(source_schema=RAW_WEATHER_HOURLY, table_schema=RAW_WEATHER_STORED,
                keys=["location_id", "ts"], partition_col="date", partition_expr=ts_date("ts"),
                defaults={"source": "open-meteo"},
                update_cols=["temperature_2m", "precipitation", "windspeed_10m", "run_id", "ingested_at"])
    stream_upsert(spark, landing, table, f"{scratch}/ck1", **args)
    df.where("location_id = 2").withColumn("run_id", F.lit(99).cast("long")).write.mode("append").json(landing)
    stream_upsert(spark, landing, table, f"{scratch}/ck1", **args)
    first = sorted(storage.read_parts(spark, table, RAW_WEATHER_STORED).collect())
    assert len(first) == 72
    stream_upsert(spark, landing, table, f"{scratch}/ck2", **args)     # replay everything
    assert sorted(storage.read_parts(spark, table, RAW_WEATHER_STORED).collect()) == first


def test_keyed_load_absorbs_reexport(spark, scratch):
    from lakeshore.schemas import CLOUD_STORED
    from lakeshore.streaming.file_load import load_new_files_by_key
    out, dst, ck = f"{scratch}/export", f"{scratch}/cloud", f"{scratch}/ck"
    df = _weather(spark)
    export_latest(df, _dim(spark), out)
    load_new_files_by_key(spark, out, dst, ck)
    first = storage.read_parts(spark, dst, CLOUD_STORED)
    assert first.count() == 48
    # re-export the same day with a changed measure: new part-file names
    changed = df.withColumn("temperature_2m", F.col("temperature_2m") + F.lit(1))
    export_latest(changed, _dim(spark), out)
    load_new_files_by_key(spark, out, dst, ck)
    after = storage.read_parts(spark, dst, CLOUD_STORED)
    assert after.count() == 48                                    # replaced, not duplicated
    assert after.where("location_id = 1 and ts = '2026-02-24 05:00:00'").first().temperature_2m == 7.0


def test_refresh_model_checks_and_rerun(spark, scratch):
    from lakeshore.plans.model_refresh import refresh_model
    raw, dim = _weather(spark), _dim(spark)
    out = refresh_model(spark, scratch, raw, dim)
    assert out["reconciliation"].first().reconciled
    assert out["missing_dates"].first().missing_dates == 0
    assert out["missing_location"].first().missing_location == 0
    assert out["duplicate_grain"].count() == 0
    assert out["daily_avg"].count() == 3                     # (Chicago, 23rd/24th), (New York, 24th)
    changed = raw.withColumn("run_id", F.lit(50).cast("long"))
    out2 = refresh_model(spark, scratch, changed, dim)
    from lakeshore.plans.model_refresh import _fact_stored_schema
    fact = storage.read_parts(spark, f"{scratch}/fact_weather_hourly", _fact_stored_schema())
    assert fact.count() == 72 and fact.where("run_id = 50").count() == 72
    assert out2["reconciliation"].first().reconciled
    assert storage.read_current(spark, f"{scratch}/dim_date").count() == 2


def test_partition_upsert_rejects_duplicate_batch(spark, scratch):
    from lakeshore.functions.scalar import ts_date
    from lakeshore.operators.upsert import DuplicateKeyError
    from lakeshore.schemas import RAW_WEATHER_STORED
    df = _weather(spark)
    with pytest.raises(DuplicateKeyError):
        storage.upsert_partitions(spark, scratch, RAW_WEATHER_STORED, df.unionByName(df.limit(1)),
                                  ["location_id", "ts"], "date", ts_date("ts"))


def test_export_spreads_a_hot_city_day_over_tasks(spark, scratch):
    # each city-day here holds half of all rows: it must be handed to several
    # writer tasks, the per-file cap must hold, and no row is lost
    from lakeshore.plans.export import export_rows, write_partitioned_csv
    out = f"{scratch}/export-hot"
    rows = export_rows(_weather(spark), _dim(spark))
    write_partitioned_csv(rows, out, rows_per_task=10, max_records_per_file=5)
    hot = os.path.join(local_path(out), "dt=2026-02-24", "city=Chicago_IL")
    files = [f for f in os.listdir(hot) if f.startswith("part-")]
    tasks = {f.split("-")[1] for f in files}
    assert len(tasks) > 1
    for f in files:
        with open(os.path.join(hot, f)) as fh:
            assert len(fh.read().splitlines()) - 1 <= 5      # minus the header
    assert read_landed_csv(spark, out).count() == 48


def test_folders_are_planned_by_number_and_rows(spark):
    from lakeshore.plans.export import plan_folders
    small = spark.range(3000).select(F.lit("2026-02-24").alias("dt"), (F.col("id") % 300).cast("string").alias("city"))
    hot = spark.range(5000).select(F.lit("2026-02-25").alias("dt"), F.lit("hot").alias("city"))
    plan = plan_folders(small.unionByName(hot), rows_per_task=1000, folders_per_task=20).collect()
    assert sorted(r.rows for r in plan) == [10] * 300 + [5000]
    folders, load = {}, {}
    for r in plan:
        assert len(r.tasks) == -(-r.rows // 1000)
        for t in r.tasks:
            folders[t] = folders.get(t, 0) + 1
            load[t] = load.get(t, 0) + r.rows / len(r.tasks)
    assert sorted(folders) == list(range(max(folders) + 1))
    assert max(folders.values()) <= 21 and max(load.values()) <= 2000


def test_export_manifest_and_reruns(spark, scratch, monkeypatch):
    from lakeshore.plans import export
    out = f"{scratch}/export"
    assert export.export_manifest(spark, out).count() == 0
    export_latest(_weather(spark), _dim(spark), out)
    export_latest(_weather(spark), _dim(spark), out, export_date="2026-02-23")
    first = {(r.dt, r.city): r for r in export.export_manifest(spark, out).collect()}
    assert {k: (r.rows, r.export) for k, r in first.items()} == {
        ("2026-02-24", "Chicago_IL"): (24, 1), ("2026-02-24", "New_York_NY"): (24, 1),
        ("2026-02-23", "Chicago_IL"): (24, 2)}
    # A rerun replaces its folders' files and leaves the other day's.
    export_latest(_weather(spark).where("location_id = 1"), _dim(spark), out)
    again = {(r.dt, r.city): r for r in export.export_manifest(spark, out).collect()}
    assert again["2026-02-24", "Chicago_IL"].export == 3 and again["2026-02-24", "New_York_NY"].export == 1
    there = [(os.path.basename(os.path.dirname(d)), os.path.basename(d), n) for d, _, names in os.walk(local_path(out))
             for n in names if n.endswith(".csv")]
    assert len(there) >= 3 and all(again[d[3:], c[5:]].write in n for d, c, n in there)
    assert read_landed_csv(spark, out).count() == 72
    export.write_partitioned_csv(export.export_rows(_weather(spark).where("false"), _dim(spark)), out)
    assert read_landed_csv(spark, out).count() == 72
    # Of two exports at once the later commit fails and takes its files back.
    commit = storage._commit

    def beaten(spark_, path, *args, **k):
        monkeypatch.setattr(storage, "_commit", commit)
        export_latest(_weather(spark), _dim(spark), out, export_date="2026-02-23")
        commit(spark_, path, *args, **k)
    monkeypatch.setattr(storage, "_commit", beaten)
    with pytest.raises(storage.ConcurrentPublishError):
        export_latest(_weather(spark), _dim(spark), out)
    assert read_landed_csv(spark, out).count() == 72


def test_partition_upsert_splits_a_hot_day_over_tasks(spark, scratch):
    # 2026-02-24 holds two thirds of the batch: AQE splits its rebalance
    # partition over several writer tasks; every row is written once
    from lakeshore.functions.scalar import ts_date
    from lakeshore.schemas import RAW_WEATHER_STORED
    n = spark.range(6000)
    hot = F.col("id") < 4000
    df = n.select((F.col("id") % 500).alias("location_id"),
                  (F.when(hot, F.lit("2026-02-24").cast("timestamp_ntz"))
                    .otherwise(F.lit("2026-02-25").cast("timestamp_ntz"))
                   + F.make_dt_interval(F.lit(0), (F.when(hot, F.col("id")).otherwise(F.col("id") - 4000)
                                                   / 500).cast("int"))).alias("ts"),
                  *[F.lit(1.5).cast("decimal(18,6)").alias(c) for c in
                    ["temperature_2m", "precipitation", "windspeed_10m"]],
                  F.lit("open-meteo").alias("source"),
                  F.lit("2026-03-01 05:00:00").cast("timestamp_ntz").alias("ingested_at"),
                  F.lit(1).cast("long").alias("run_id"))
    # a tiny target size stands in for a day far above it; merging of small
    # partitions is off so the map side keeps several tasks, as at scale
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        touched = storage.upsert_partitions(spark, scratch, RAW_WEATHER_STORED, df, ["location_id", "ts"],
                                            "date", ts_date("ts"), on_duplicate="error")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(str(t) for t in touched) == ["2026-02-24", "2026-02-25"]
    folder = storage.committed_versions(spark, scratch).first().folder
    files = [f for f in os.listdir(os.path.join(local_path(scratch), folder, "date=2026-02-24"))
             if f.startswith("part-")]
    assert len({f.split("-")[1] for f in files}) > 1
    t = storage.read_parts(spark, scratch, RAW_WEATHER_STORED)
    assert t.count() == 6000 and t.where("date = '2026-02-24'").count() == 4000
    assert t.groupBy("location_id", "ts").count().where("count > 1").count() == 0


def _payload(hours=24, day=1, temperature=1.0, **other):
    times = [f"2026-03-{day + h // 24:02d}T{h % 24:02d}:00" for h in range(hours)]
    return {"latitude": 41.8781, "longitude": -87.6298, "location_name": "Chicago, IL",
            "hourly": {"time": times, "temperature_2m": [temperature] * hours, "precipitation": [0.0] * hours,
                       "windspeed_10m": [3.0] * hours}, **other}


def _flow(scratch, **other):
    from lakeshore.plans.flow import FlowConfig
    return FlowConfig(**{**dict(root=f"{scratch}/wh", landing=f"{scratch}/landing", run_ts="2026-03-01 05:00:00",
                                as_of="2026-03-01", multiline_payloads=True), **other})


def test_daily_flow_error_closes_runs_as_failed(spark, scratch, monkeypatch):
    # the write fails: the open run must be closed FAILED with the whole
    # message, and the error re-raised
    from lakeshore.operators.audit import runs_state
    from lakeshore.plans import flow
    from lakeshore.schemas import RUN_EVENTS
    _write(f"{scratch}/landing", "p.json", _payload())
    cfg, message = _flow(scratch), "no room " * 200

    def fail(*args, **kwargs):
        raise OSError(message)

    monkeypatch.setattr(flow.storage, "upsert_partitions", fail)
    with pytest.raises(OSError):
        flow.run_daily_flow(spark, cfg)
    state = runs_state(spark.read.schema(RUN_EVENTS).parquet(cfg.path("run_events"))).collect()
    assert len(state) == 1
    assert state[0].status == "FAILED" and state[0].finished_at is not None
    assert state[0].error_message == f"OSError: {message}"


def test_daily_flow_last_fetch_wins_and_renames(spark, scratch):
    from lakeshore.plans.flow import run_daily_flow
    from lakeshore.schemas import RAW_WEATHER_STORED
    landing = f"{scratch}/landing"
    _write(landing, "a.json", _payload(48, location_name="Z old"))
    _write(landing, "b.json", _payload(48, day=2, temperature=9.0, location_name="A new"))
    os.utime(os.path.join(local_path(landing), "a.json"), (1, 1))
    cfg = _flow(scratch)
    (row,) = run_daily_flow(spark, cfg).collect()
    assert (row.status, row.row_count, row.rows_exported, row.rows_loaded) == ("SUCCESS", 72, 24, 24)
    raw = storage.read_parts(spark, cfg.path("raw_weather_hourly"), RAW_WEATHER_STORED)
    assert raw.where("temperature_2m = 9").count() == 48 and raw.count() == 72
    assert storage.read_current(spark, cfg.path("dim_location")).first().location_name == "A new"
    # a second run of the day has nothing new: no export, no row twice
    (again,) = run_daily_flow(spark, _flow(scratch, raise_on_qc_failure=False)).collect()
    from lakeshore.schemas import CLOUD_STORED
    assert again.rows_exported is None
    assert storage.read_parts(spark, cfg.path("cloud_raw_weather_hourly"), CLOUD_STORED).count() == 24


def test_bad_payloads_fail_their_runs(spark, scratch):
    from lakeshore.operators.audit import runs_state
    from lakeshore.plans.flow import run_daily_flow
    from lakeshore.schemas import RUN_EVENTS
    landing = f"{scratch}/landing"
    _write(landing, "good.json", _payload())
    other = _payload(latitude=1.0)
    other["hourly"]["precipitation"][5] = "garbage"
    _write(landing, "garbage.json", other)
    _write(landing, "fine.json", _payload(latitude=1.0))     # the location is known by another document
    with open(os.path.join(local_path(landing), "cut.json"), "w") as f:
        f.write(json.dumps(_payload(latitude=2.0))[:-30])
    cfg = _flow(scratch, raise_on_qc_failure=False)
    rows = run_daily_flow(spark, cfg).collect()
    assert sorted((r.location_id is None, r.status, r.row_count) for r in rows) == [
        (False, "FAILED", 0), (False, "SUCCESS", 24), (True, "FAILED", 0)]
    errors = [r.error_message or "" for r in runs_state(spark.read.schema(RUN_EVENTS).parquet(
        cfg.path("run_events"))).collect()]
    assert any("cut.json" in e for e in errors) and any("garbage.json" in e for e in errors)


def test_a_writer_that_stops_before_its_commit_changes_nothing(spark, scratch, monkeypatch):
    from lakeshore.functions.scalar import ts_date
    from lakeshore.schemas import RAW_WEATHER_STORED
    df = _weather(spark)
    args = (spark, scratch, RAW_WEATHER_STORED)
    storage.upsert_partitions(*args, df, ["location_id", "ts"], "date", ts_date("ts"))
    before = sorted(storage.read_parts(*args).collect())

    def stop(*a, **k):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(storage, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            storage.upsert_partitions(*args, df.where("location_id = 2").withColumn("run_id", F.lit(99).cast("long")),
                                      ["location_id", "ts"], "date", ts_date("ts"))
    assert sorted(storage.read_parts(*args).collect()) == before
    # the replay goes through
    storage.upsert_partitions(*args, df.where("location_id = 2").withColumn("run_id", F.lit(99).cast("long")),
                              ["location_id", "ts"], "date", ts_date("ts"))
    assert storage.read_parts(*args).where("run_id = 99").count() == 24
    assert storage.read_parts(*args).count() == len(before)


def test_two_writers_of_one_version(spark, scratch):
    df = _weather(spark)
    storage.replace_table(df, scratch)
    folder = storage._write_snapshot(df.limit(1), scratch)
    with pytest.raises(storage.ConcurrentPublishError):
        storage._commit(spark, scratch, 1, folder)
    assert storage.read_current(spark, scratch).count() == df.count()


def test_rejected_partitions_stay_unread(spark, scratch):
    day = F.to_date("ts").alias("date")
    df = _weather(spark).select("*", day)

    def checks(x):
        return quality.unique_report(x, ["location_id", "ts"], "raw")

    odd = df.limit(2).withColumn("date", F.to_date(F.lit("2030-01-01")))
    with pytest.raises(quality.QualityError):
        storage.publish(df.unionByName(odd), scratch, checks, partition_by=["date"])
    storage.publish(df, scratch, checks, partition_by=["date"])
    assert storage.read_current(spark, scratch).where("date = '2030-01-01'").count() == 0
    assert storage.read_current(spark, scratch).count() == df.count()


def test_stored_days_are_pruned(spark, scratch):
    """QC, export and the upsert read only the days they need."""
    from lakeshore.functions.scalar import ts_date
    from lakeshore.plans.views import plan_text
    from lakeshore.schemas import RAW_WEATHER_STORED
    storage.upsert_partitions(spark, scratch, RAW_WEATHER_STORED, _weather(spark), ["location_id", "ts"], "date",
                              ts_date("ts"))
    some = storage.read_parts(spark, scratch, RAW_WEATHER_STORED, only=["2026-02-23"])
    assert len(some.inputFiles()) == 1 and some.count() == 24
    rest = storage.read_parts(spark, scratch, RAW_WEATHER_STORED).where("date = '2026-02-24'")
    assert "PartitionFilters: [isnotnull(date" in plan_text(rest).replace("#", "(").replace("((", "(") or \
        "date" in plan_text(rest).split("PartitionFilters: [")[1].split("]")[0]


def test_folders_of_clashing_city_names(spark):
    from lakeshore.plans.export import city_folders
    dim = spark.createDataFrame([(1, "St. Louis"), (2, "St Louis"), (3, "東京"), (4, "大阪"), (5, "東京")],
                                "location_id long, location_name string")
    got = {r.location_id: r.city for r in city_folders(dim).collect()}
    assert got == {1: "St_Louis_1", 2: "St_Louis_2", 3: "東京", 4: "大阪", 5: "東京"}


def test_refresh_writes_only_changed_days_and_checks_keys_first(spark, scratch):
    from lakeshore.plans.model_refresh import _fact_stored_schema, refresh_model
    raw, dim = _weather(spark), _dim(spark)
    runs = spark.createDataFrame([(7,), (8,)], "run_id long")
    refresh_model(spark, scratch, raw, dim, runs=runs)
    changed = raw.withColumn("temperature_2m", F.lit(3).cast("decimal(18,6)"))
    refresh_model(spark, scratch, changed, dim, days=["2026-02-23"], runs=runs)
    fact_path = f"{scratch}/fact_weather_hourly"
    log = storage.committed_versions(spark, fact_path).orderBy("version").collect()
    assert [r.parts for r in log] == [["2026-02-23", "2026-02-24"], ["2026-02-23"]]
    assert storage.parts_since(spark, fact_path, 1) == ["2026-02-23"]
    before = storage.read_parts(spark, fact_path, _fact_stored_schema())
    assert before.where("temperature_2m = 3").where("date = '2026-02-23'").count() == 24
    # a run that the log does not know keeps the refresh from being published
    with pytest.raises(quality.QualityError, match="orphan_run_id"):
        refresh_model(spark, scratch, raw.withColumn("run_id", F.lit(99).cast("long")), dim, runs=runs)
    assert storage.read_parts(spark, fact_path, _fact_stored_schema()).where("run_id = 99").count() == 0
