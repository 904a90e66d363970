"""The stream of daily loads against the batch flow, drop by drop."""

import datetime as dt
import json
import os
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeshore.operators.audit import runs_state
from lakeshore.operators.incremental import fetch_windows
from lakeshore.plans import flow, storage
from lakeshore.plans.flow import FlowConfig, run_daily_flow
from lakeshore.schemas import DIM_LOCATION, RAW_WEATHER_STORED, RUN_EVENTS, WATERMARKS
from lakeshore.session import local_path
from lakeshore.streaming import window_stream
from lakeshore.streaming.window_stream import stream_daily_loads

PLACES = {"Chicago, IL": (41.8781, -87.6298), "New York, NY": (40.7128, -74.006), "Oslo": (59.91, 10.75)}


def doc(name, first_day, hours, temperature=1.0, null_at=None, label=None, **other):
    lat, lon = PLACES[name]
    start = dt.datetime(2026, 3, first_day)
    times = [(start + dt.timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in range(hours)]
    warm = [None if h == null_at else temperature + h for h in range(hours)]
    return {"latitude": lat, "longitude": lon, "location_name": label or name,
            "hourly": {"time": times, "temperature_2m": warm, "precipitation": [0.5] * hours,
                       "windspeed_10m": [3.0] * hours}, **other}


# as_of and documents of each drop: first loads (one with a NULL, one broken);
# an overlap with other values, a rename and a mended location; a drop whose
# windows lie beyond the horizon for two locations.
DROPS = [
    ("2026-03-01", {"a": doc("Chicago, IL", 1, 60), "b": doc("New York, NY", 1, 30, null_at=4), "c": "{broken",
                    "d": doc("Oslo", 1, 40), "e": {**doc("Oslo", 3, 5), "hourly": {"time": ["x"], "temperature_2m": [1]}}}),
    ("2026-03-02", {"a": doc("Chicago, IL", 2, 100, 50.0, label="Chicago"), "b": doc("New York, NY", 1, 48, 7.0),
                    "b2": doc("New York, NY", 2, 10, 9.0), "d": doc("Oslo", 2, 20)}),
    ("2026-02-20", {"a": doc("Chicago, IL", 2, 300, 70.0), "b": doc("New York, NY", 2, 24), "d": doc("Oslo", 1, 500)}),
]


def land(folder, documents, drop):
    os.makedirs(local_path(folder), exist_ok=True)
    for name, d in documents.items():
        path = os.path.join(local_path(folder), f"{drop}-{name}.json")
        with open(path, "w") as f:
            f.write(d if isinstance(d, str) else json.dumps(d))
        when = 1_770_000_000 + 100 * drop + len(name)
        os.utime(path, (when, when))


def config(root, landing, as_of, **other):
    return FlowConfig(**{**dict(root=root, landing=landing, run_ts=f"{as_of} 05:00:00", as_of=as_of,
                                multiline_payloads=True, raise_on_qc_failure=False), **other})


def contents(spark, root):
    """Rows, runs and locations of a warehouse, files by their names alone."""
    rows = storage.read_parts(spark, f"{root}/raw_weather_hourly", RAW_WEATHER_STORED).collect()
    runs = runs_state(spark.read.schema(RUN_EVENTS).parquet(f"{root}/run_events")).collect()
    dim = storage.read_current(spark, f"{root}/dim_location", DIM_LOCATION).collect()

    def short(text):
        return None if text is None else " ".join(os.path.basename(w.rstrip('",}')) if "/" in w else w
                                                  for w in text.replace('"payload_file":"', "/").split())
    return (sorted(map(tuple, rows)), sorted((r.run_id, short(r.params), r.status, r.row_count, short(r.error_message),
                                              r.started_at, r.finished_at) for r in runs), sorted(map(tuple, dim)))


def test_the_stream_equals_the_batch_flow(spark, scratch, monkeypatch):
    batch, stream = f"{scratch}/batch", f"{scratch}/stream"
    # The flow alone: nothing is exported, as in the stream.
    monkeypatch.setattr(flow, "gate", lambda *a, **k: (_ for _ in ()).throw(flow.QualityError("not here")))
    for drop, (as_of, documents) in enumerate(DROPS):
        land(f"{scratch}/landing-{drop}", documents, drop)
        run_daily_flow(spark, config(batch, f"{scratch}/landing-{drop}", as_of))
        land(f"{scratch}/landing", documents, drop)
        assert stream_daily_loads(spark, config(stream, f"{scratch}/landing", as_of), f"{scratch}/ckpt") == 1
        assert contents(spark, stream) == contents(spark, batch)
    states = [json.loads(r.params)["state"] for r in runs_state(
        spark.read.schema(RUN_EVENTS).parquet(f"{stream}/run_events")).orderBy("run_id").collect()]
    assert {"FIRST", "LOAD", "SKIPPED", "BAD_PAYLOAD"} <= set(states)
    # Nothing new has landed: no batch, no change.
    before = contents(spark, stream)
    assert stream_daily_loads(spark, config(stream, f"{scratch}/landing", "2026-03-09"), f"{scratch}/ckpt") == 0
    assert contents(spark, stream) == before


def test_a_batch_that_dies_is_run_again_from_the_same_marks(spark, scratch, monkeypatch):
    whole, broken = f"{scratch}/whole", f"{scratch}/broken"
    for drop, (as_of, documents) in enumerate(DROPS[:2]):
        land(f"{scratch}/landing", documents, drop)
        stream_daily_loads(spark, config(whole, f"{scratch}/landing", as_of), f"{scratch}/ckpt-a")
        for name in ("run_outcomes", "claim_run_ids"):  # after the rows, before the ids are used
            with monkeypatch.context() as m:
                m.setattr(window_stream, name, lambda *a, **k: (_ for _ in ()).throw(OSError("no room")))
                with pytest.raises(Exception, match="no room"):
                    stream_daily_loads(spark, config(broken, f"{scratch}/landing", as_of), f"{scratch}/ckpt-b")
        stream_daily_loads(spark, config(broken, f"{scratch}/landing", as_of), f"{scratch}/ckpt-b")
    assert contents(spark, broken) == contents(spark, whole)


def test_batch_loads_seed_the_stream_and_the_other_way(spark, scratch, monkeypatch):
    monkeypatch.setattr(flow, "gate", lambda *a, **k: (_ for _ in ()).throw(flow.QualityError("not here")))
    root, other = f"{scratch}/mixed", f"{scratch}/batch"
    for drop, (as_of, documents) in enumerate(DROPS):
        land(f"{scratch}/landing-{drop}", documents, drop)
        cfg = config(root, f"{scratch}/landing-{drop}", as_of)
        if drop == 1:
            stream_daily_loads(spark, cfg, f"{scratch}/ckpt")
        else:
            run_daily_flow(spark, cfg)
        run_daily_flow(spark, config(other, f"{scratch}/landing-{drop}", as_of))
    assert contents(spark, root) == contents(spark, other)


def test_windows_are_those_of_the_batch(spark):
    marks = [None, dt.datetime(2026, 3, 1, 22), dt.datetime(2026, 3, 1, 23), dt.datetime(2026, 3, 7, 22),
             dt.datetime(2026, 3, 7, 23), dt.datetime(2026, 4, 1)]
    locations = spark.createDataFrame([(i,) for i in range(len(marks))], "location_id long")
    loaded = spark.createDataFrame([(i, m, None) for i, m in enumerate(marks) if m], WATERMARKS)
    got = fetch_windows(locations, loaded, "2026-03-01").collect()
    assert {r.location_id: (r.start_date, r.end_date, r.state) for r in got} == {
        i: window_stream.window_of(m, dt.date(2026, 3, 1), 6) for i, m in enumerate(marks)}


def test_a_full_window_is_asked_for(spark, scratch):
    land(f"{scratch}/landing", {"a": doc("Oslo", 1, 168), "b": doc("Chicago, IL", 1, 167)}, 0)
    cfg = config(f"{scratch}/wh", f"{scratch}/landing", "2026-03-01", expected_rows=168)
    stream_daily_loads(spark, cfg, f"{scratch}/ckpt")
    runs = runs_state(spark.read.schema(RUN_EVENTS).parquet(f"{scratch}/wh/run_events")).collect()
    assert sorted((r.status, r.row_count, r.error_message) for r in runs) == [
        ("FAILED", 0, "QC failed: row_count rows_touched=167"), ("SUCCESS", 168, None)]


def test_flows_at_once_take_different_run_ids(spark, scratch, monkeypatch):
    """The second flow starts and ends between the first one's claim and its
    first event."""
    monkeypatch.setattr(flow, "gate", lambda *a, **k: (_ for _ in ()).throw(flow.QualityError("not here")))
    root = f"{scratch}/wh"
    land(f"{scratch}/one", {"a": doc("Chicago, IL", 1, 48), "b": doc("Oslo", 1, 24)}, 0)
    land(f"{scratch}/two", {"a": doc("New York, NY", 1, 30)}, 1)
    opening, other = flow.run_openings, []

    def interrupted(*args):
        if not other:
            other.append(None)
            other[0] = run_daily_flow(spark, config(root, f"{scratch}/two", "2026-03-01")).collect()
        return opening(*args)
    monkeypatch.setattr(flow, "run_openings", interrupted)
    first = run_daily_flow(spark, config(root, f"{scratch}/one", "2026-03-01")).collect()
    assert sorted(r.run_id for r in first) == [1, 2] and [r.run_id for r in other[0]] == [3]
    runs = runs_state(spark.read.schema(RUN_EVENTS).parquet(f"{root}/run_events")).collect()
    assert sorted((r.run_id, r.status, r.row_count) for r in runs) == [(1, "SUCCESS", 48), (2, "SUCCESS", 24),
                                                                       (3, "SUCCESS", 30)] or len(runs) == 3
    rows = storage.read_parts(spark, f"{root}/raw_weather_hourly", RAW_WEATHER_STORED)
    assert {r.run_id: r["count"] for r in rows.groupBy("run_id").count().collect()} == {
        r.run_id: r.row_count for r in runs}
    assert rows.agg(F.count_distinct("location_id")).first()[0] == 3


def test_a_location_gives_one_frame_with_the_last_fetch_of_each_hour():
    class Fresh:
        exists, kept = False, None

        def update(self, value):
            self.kept = value
    start, rows = dt.datetime(2026, 3, 1), []
    for fetch in range(3):
        rows.append(("doc", "Chicago", pd.Timestamp(start), f"f{fetch}", 0, pd.NaT, None, None, None))
        rows += [("row", "Chicago", pd.Timestamp(start), f"f{fetch}", h + 1, pd.Timestamp(start + dt.timedelta(hours=h)),
                  Decimal(fetch), None if fetch == 1 else Decimal(1), None) for h in range(-24, 48)]
    chunk = pd.DataFrame(rows, columns=["kind", "location_name", "fetched_at", "payload_file", "position", "ts",
                                        "temperature_2m", "precipitation", "windspeed_10m"])
    chunk["seed"] = pd.NaT
    state = Fresh()
    frames = list(window_stream.load_step(start.date(), 6, None)(("1.0", "2.0"), iter([chunk[:100], chunk[100:]]), state))
    assert len(frames) == 1 and state.kept == (int((start + dt.timedelta(hours=47) - dt.datetime(1970, 1, 1))
                                                   / dt.timedelta(microseconds=1)),)
    out = frames[0]
    loaded, run = out[out["kind"] == "row"], out[out["kind"] == "run"].iloc[0]
    assert loaded["ts"].tolist() == [start + dt.timedelta(hours=h) for h in range(48)]
    assert set(loaded["temperature_2m"]) == {Decimal(2)} and set(loaded["precipitation"]) == {Decimal(1)}
    assert (run["row_count"], run["null_values"], run["state"], run["passed"]) == (48, 0, "FIRST", True)
