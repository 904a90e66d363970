"""Fetch-window truth table (FIXTURES 5), run QC cases (FIXTURES 6), guards."""

import datetime as dt

from pyspark.sql import functions as F

from lakeshore.operators import audit, incremental, quality
from lakeshore.schemas import RUN_EVENTS

AS_OF = "2026-03-01"


def test_fetch_windows_truth_table(spark):
    marks = {1: None, 2: dt.datetime(2026, 2, 20, 23), 3: dt.datetime(2026, 3, 5, 22),
             4: dt.datetime(2026, 3, 5, 23), 5: dt.datetime(2026, 3, 7, 22), 6: dt.datetime(2026, 3, 7, 23)}
    locs = spark.createDataFrame([(k,) for k in marks], "location_id long")
    loaded = spark.createDataFrame([(k, v) for k, v in marks.items() if v is not None],
                                   "location_id long, ts timestamp_ntz")
    w = {r.location_id: r for r in incremental.fetch_windows(locs, loaded, AS_OF).collect()}
    d = dt.date
    expect = {1: (d(2026, 3, 1), "FIRST"), 2: (d(2026, 2, 21), "LOAD"), 3: (d(2026, 3, 5), "LOAD"),
              4: (d(2026, 3, 6), "LOAD"), 5: (d(2026, 3, 7), "LOAD"), 6: (d(2026, 3, 8), "SKIPPED")}
    for k, (start, state) in expect.items():
        assert (w[k].start_date, w[k].end_date, w[k].state) == (start, d(2026, 3, 7), state)
    # hours in window / new hours for a full hourly feed
    rows = [(k, dt.datetime(2026, 2, 20) + dt.timedelta(hours=h)) for k in marks for h in range(24 * 20)]
    feed = spark.createDataFrame(rows, "location_id long, ts timestamp_ntz")
    windows = incremental.fetch_windows(locs, loaded, AS_OF)
    inwin = {r[0]: r[1] for r in incremental.windowed_rows(feed, windows).groupBy("location_id").count().collect()}
    strict = {r[0]: r[1] for r in incremental.windowed_rows(feed, windows, strict_hour=True)
              .groupBy("location_id").count().collect()}
    assert inwin == {1: 168, 2: 360, 3: 72, 4: 48, 5: 24}
    assert strict == {1: 168, 2: 360, 3: 49, 4: 48, 5: 1}


def _runs(spark, rows):
    return spark.createDataFrame(rows, "run_id long, pipeline_name string, started_at timestamp_ntz, "
                                       "finished_at timestamp_ntz, status string, row_count long")


def _raw(spark, rows):
    return spark.createDataFrame(rows, "run_id long, location_id long, ts timestamp_ntz, "
                                       "temperature_2m double, precipitation double, windspeed_10m double")


T = dt.datetime(2026, 3, 1, 5, 0)


def _verdict(spark, runs, raw, latest_only=False):
    rep = quality.qc_runs(_runs(spark, runs), _raw(spark, raw), "2026-03-01 05:00:00", 2,
                          latest_only=latest_only)
    return all(r.passed for r in rep.collect())


def test_qc_cases(spark):
    ok_raw = [(1, 1, T, 1.0, 0.0, 2.0)]
    P = "p"
    assert not _verdict(spark, [(1, P, T - dt.timedelta(hours=1), T, "SUCCESS", 1)], ok_raw)  # none in window
    assert not _verdict(spark, [(1, P, T, None, "RUNNING", 0)], ok_raw)
    assert not _verdict(spark, [(1, P, T, T, "FAILED", 0)], ok_raw)
    assert _verdict(spark, [(1, P, T, T, "SKIPPED", 0)], [(1, 1, T, None, None, None)])
    assert not _verdict(spark, [(1, P, T, None, "SUCCESS", 1)], ok_raw)
    assert not _verdict(spark, [(1, P, T, T, "SUCCESS", None)], ok_raw)
    assert not _verdict(spark, [(1, P, T, T, "SUCCESS", 0)], ok_raw)
    assert not _verdict(spark, [(1, P, T, T, "SUCCESS", 1)], [(1, 1, T, 1.0, None, 2.0)])
    assert not _verdict(spark, [(1, P, T, T, "SUCCESS", 2)], ok_raw + ok_raw)
    assert _verdict(spark, [(1, P, T, T, "SUCCESS", 1)], ok_raw)
    assert _verdict(spark, [(1, P, T + dt.timedelta(hours=2), T, "SUCCESS", 1)], ok_raw)   # closed end
    three = [(1, P, T, T, "FAILED", 0), (2, P, T, T, "SUCCESS", 1), (3, P, T, T, "SUCCESS", 1)]
    raw3 = [(2, 1, T, 1.0, 0.0, 2.0), (3, 2, T, 1.0, 0.0, 2.0)]
    assert _verdict(spark, three, raw3, latest_only=True)
    assert not _verdict(spark, three, raw3)


def test_load_guards(spark):
    rows = [(1, T + dt.timedelta(hours=h), 1.0) for h in range(168)] + \
           [(2, T + dt.timedelta(hours=h), 1.0) for h in range(167)] + \
           [(3, T + dt.timedelta(hours=h), None if h == 5 else 1.0) for h in range(168)]
    df = spark.createDataFrame(rows, "location_id long, ts timestamp_ntz, temperature_2m double")
    full = {r.location_id: (r.passed, r.failure) for r in quality.load_guard(df, ["location_id"], 168).collect()}
    assert full == {1: (True, None), 2: (False, "row_count"), 3: (False, "null_values")}
    inc = {r.location_id: r.passed for r in quality.load_guard(df, ["location_id"], min_rows=1).collect()}
    assert inc == {1: True, 2: True, 3: False}


def test_gate_raises(spark):
    rep = spark.createDataFrame([("a", True), ("b", False)], "check_name string, passed boolean")
    try:
        quality.gate(rep)
    except quality.QualityError as e:
        assert "'b'" in str(e)
    else:
        raise AssertionError("gate must raise")
    quality.gate(rep.where("passed"))


def test_quarantine_is_a_partition(spark):
    rows = [(i, None if i % 4 == 0 else "e", "purchase" if i % 3 == 0 else "login",
             None if i % 5 == 0 else float(i % 7 - 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, email string, event_type string, amount double")
    good, bad = quality.quarantine(df, quality.event_rules())
    g, b = {r.event_id for r in good.collect()}, {r.event_id for r in bad.collect()}
    assert not (g & b) and len(g | b) == 200
    assert quality.reconcile_split(df, good, bad).first().reconciled


def test_runs_state_by_sequence(spark):
    at = dt.datetime(2026, 3, 1, 5)
    ev = spark.createDataFrame([(1, 1, "RUNNING", at), (1, 2, "SUCCESS", at), (2, 1, "RUNNING", at)],
                               "run_id long, event_seq int, status string, at timestamp_ntz")
    st = {r.run_id: (r.status, r.finished_at) for r in audit.runs_state(ev).collect()}
    assert st == {1: ("SUCCESS", at), 2: ("RUNNING", None)}
    assert set(RUN_EVENTS.fieldNames()) <= set(audit.open_runs(ev.select("run_id"), at).columns)
