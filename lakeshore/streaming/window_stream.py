"""The daily loads as a stream with its windows in the state store (I8, I1-I5).

Landed payload documents are keyed by their coordinates. The state of a key is
its high-water mark, an event time: with each drop it gives the location's
window (FIRST, LOAD, or SKIPPED beyond the horizon), rows outside are dropped,
the last fetch of each hour is kept, the load guard is applied, and only a load
that passes moves the mark. State and sink go together: a batch that fails is
run again from the mark it began with, and its run ids, rows and events come
out the same (ids are claimed in the batch's name, rows are upserted by key).

The state function sees a location's rows chunk by chunk and holds at most the
hours of its window. A table that batch flows loaded before gives the first
mark of each location, and marks go on to the same table, so stream and batch
flow can follow each other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakeshore.fixed import DEFAULT_WEATHER_SOURCE, HOURLY_VARS
from lakeshore.functions.scalar import location_label, ntz, parse_payload_time, to_coord, ts_date
from lakeshore.operators.audit import claim_run_ids, close_runs
from lakeshore.plans import storage
from lakeshore.plans.flow import FlowConfig, resolve_incoming, run_openings, run_outcomes
from lakeshore.plans.joins import kept_so_far, lookup_join, release_checked
from lakeshore.schemas import DIM_LOCATION, MEASURE, PAYLOAD, RAW_WEATHER_STORED, RUN_EVENTS, WATERMARKS
from lakeshore.sources.payloads import with_source

_MEASURES = ", ".join(f"{v} decimal({MEASURE.precision},{MEASURE.scale})" for v in HOURLY_VARS)
# kind: ``run`` (a location's load: window, guard), ``row`` (an hour of a load
# that passed), ``bad`` (a document that can't be trusted), ``name`` (a location
# whose documents hold no hours).
OUT_SCHEMA = ("kind string, lat string, lon string, location_name string, fetched_at timestamp, payload_file string, "
              f"ts timestamp_ntz, {_MEASURES}, state string, last_ts timestamp_ntz, row_count long, "
              "null_values long, failure string, passed boolean")
_OUT = [c.split()[0] for c in OUT_SCHEMA.split(", ")]
STATE_SCHEMA = "last_us long"
_COUNTS = {"row_count", "null_values"}
_TEMPERATURE = list(HOURLY_VARS).index("temperature_2m")


def keyed_elements(payloads: DataFrame) -> DataFrame:
    """Documents as the state function takes them: one ``doc`` (or ``bad``)
    element for each, one ``row`` element for each of its hours."""
    hours = F.concat(F.array(F.lit(None).cast("string")),
                     F.when(~F.col("bad"), F.coalesce("hourly.time", F.array().cast("array<string>"))).otherwise(
                         F.array().cast("array<string>")))
    d = payloads.select(
        to_coord("latitude").cast("string").alias("lat"), to_coord("longitude").cast("string").alias("lon"),
        F.coalesce("location_name", location_label("latitude", "longitude")).alias("location_name"),
        "fetched_at", "payload_file", "bad", "hourly", F.posexplode(hours).alias("position", "_t"))
    hour = F.col("position") > 0
    measures = [F.when(hour, F.get(F.col(f"hourly.{v}"), F.col("position") - 1).cast(MEASURE)).alias(v) for v in HOURLY_VARS]
    return d.select(F.when(F.col("bad"), "bad").when(hour, "row").otherwise("doc").alias("kind"), "lat", "lon",
                    "location_name", "fetched_at", "payload_file", "position",
                    F.when(hour, parse_payload_time("_t")).alias("ts"), *measures)


def window_of(mark: dt.datetime | None, as_of: dt.date, horizon_days: int) -> tuple[dt.date, dt.date, str]:
    """(first day, last day, state) as incremental.fetch_windows gives them."""
    end = as_of + dt.timedelta(days=horizon_days)
    if mark is None:
        return as_of, end, "FIRST"
    start = (mark + dt.timedelta(hours=1)).date()
    return start, end, "SKIPPED" if start > end else "LOAD"


def _frame(rows: dict, n: int = 1) -> pd.DataFrame:
    # Counts as objects: beside NULLs pandas would make them floats.
    return pd.DataFrame({c: pd.Series(rows[c], dtype=object) if c in _COUNTS and c in rows
                         else rows[c] if c in rows else [None] * n for c in _OUT})


def _rank(*values) -> tuple:
    """What orders the fetches of one hour: NULLs order last, as the largest value."""
    return tuple((True, 0) if v is None or v != v else (False, v) for v in values)


def load_step(as_of: dt.date, horizon_days: int, expected_rows: int | None):
    """The state function of one drop: (key, chunks of elements, state) -> output.
    Most keys have a few dozen elements, so these are walked in plain Python:
    a pandas operation a key costs more than all of them."""
    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        lat, lon = key
        mark, window = None, None
        kept: dict = {}     # hour -> (rank, measures): at most the window's hours
        best_name, first_bad, n_rows = None, None, 0
        for chunk in chunks:
            if window is None:
                seed = chunk["seed"].iloc[0]
                if state.exists:
                    mark = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=state.get[0])
                elif not pd.isna(seed):
                    mark = pd.Timestamp(seed).to_pydatetime()
                window = window_of(mark, as_of, horizon_days)
                first, after = np.datetime64(window[0]), np.datetime64(window[1] + dt.timedelta(days=1))
            kind = chunk["kind"].to_numpy()
            fetched, file = chunk["fetched_at"].tolist(), chunk["payload_file"].tolist()
            bad = [file[i] for i in np.flatnonzero(kind == "bad")]
            if bad:
                first_bad = min(bad) if first_bad is None else min(first_bad, *bad)
                yield _frame({"kind": ["bad"] * len(bad), "lat": [lat] * len(bad), "lon": [lon] * len(bad),
                              "payload_file": bad}, len(bad))
            docs = np.flatnonzero(kind == "doc")
            if len(docs):
                name = chunk["location_name"].tolist()
                told = max((fetched[i], file[i], name[i]) for i in docs)
                best_name = told if best_name is None else max(best_name, told)
            is_row = kind == "row"
            n_rows += int(is_row.sum())
            if window[2] == "SKIPPED":
                continue
            hours = chunk["ts"].to_numpy()
            inside = np.flatnonzero(is_row & (hours >= first) & (hours < after))
            if not len(inside):
                continue
            ts, position = chunk["ts"].tolist(), chunk["position"].tolist()
            columns = [chunk[v].tolist() for v in HOURLY_VARS]
            for i in inside:
                measures = [c[i] for c in columns]
                rank = _rank(fetched[i], file[i], position[i], *measures)
                held = kept.get(ts[i])
                if held is None or rank > held[0]:
                    kept[ts[i]] = (rank, measures)
        if lat is None or lon is None:
            return
        name = dict(zip(("fetched_at", "payload_file", "location_name"), ([x] for x in best_name), strict=True)) \
            if best_name else {}
        base = {"lat": [lat], "lon": [lon], **name}
        if not n_rows and first_bad is None:
            yield _frame({"kind": ["name"], **base})
            return
        n, nulls = len(kept), sum(m[_TEMPERATURE] is None for _, m in kept.values())
        failure = None
        if n:
            wrong = n < 1 if expected_rows is None else n != expected_rows
            failure = f"bad payload {first_bad}" if first_bad else "row_count" if wrong else "null_values" if nulls else None
        passed = n > 0 and failure is None
        run = {"kind": ["run"], **base, "state": [window[2]], "last_ts": [mark], "row_count": [n if n else None],
               "null_values": [nulls], "failure": [failure], "passed": [passed if n else None]}
        if passed:
            hours = sorted(kept)
            newest = hours[-1].to_pydatetime()
            newest = newest if mark is None else max(newest, mark)
            state.update((int((newest - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)),))
            rows = {"kind": ["row"] * n, "lat": [lat] * n, "lon": [lon] * n, "ts": hours}
            rows |= {v: [kept[h][1][k] for h in hours] for k, v in enumerate(HOURLY_VARS)}
            # One frame of the rows and the run.
            yield _frame({c: rows.get(c, [None] * n) + run.get(c, [None]) for c in rows | run}, n + 1)
            return
        if mark is not None and not state.exists:
            state.update((int((mark - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)),))
        yield _frame(run)
    return step


def _seeds(spark: SparkSession, cfg: FlowConfig, checkpoint: str) -> DataFrame:
    """(lat, lon, seed): the marks that others' loads left. This stream's own
    marks are in its state, which a batch that runs again gets as it was."""
    dim = storage.read_current(spark, cfg.path("dim_location"), DIM_LOCATION)
    marks = storage.ensure_table(spark, cfg.path("watermarks"), WATERMARKS)
    if dim is None:
        dim = spark.createDataFrame([], DIM_LOCATION)
    others = marks.where(~F.col("loaded_by").eqNullSafe(F.lit(checkpoint)))
    newest = others.groupBy("location_id").agg(F.max("ts").alias("seed"))
    return dim.join(newest, "location_id").select(F.col("latitude").cast("string").alias("lat"),
                                                  F.col("longitude").cast("string").alias("lon"), "seed")


def _apply(spark: SparkSession, cfg: FlowConfig, checkpoint: str, batch_id: int, out: DataFrame) -> None:
    """The sink of one batch: locations, run ids, RUNNING, rows, outcomes."""
    owner = f"{checkpoint}#{batch_id}"
    out = out.withColumns({"latitude": F.col("lat").cast("decimal(9,6)"), "longitude": F.col("lon").cast("decimal(9,6)")}) \
        .checkpoint(eager=True)
    named = out.where("location_name IS NOT NULL").select(
        "latitude", "longitude", F.struct("fetched_at", "payload_file").alias("fetch"), "location_name")
    dim = resolve_incoming(spark, named, cfg.path("dim_location"), owner).select("location_id", "latitude", "longitude")
    at = ["latitude", "longitude"]
    loads = lookup_join(out.where("kind = 'run'"), dim, at, "inner")
    lost = lookup_join(out.where("kind = 'bad'"), dim, at, "left").where("location_id IS NULL").select(
        "location_id", F.lit("BAD_PAYLOAD").alias("state"), F.lit(None).cast("timestamp_ntz").alias("last_ts"),
        "payload_file")
    wanted = loads.select("location_id", "state", "last_ts", F.lit(None).cast("string").alias("payload_file")) \
        .unionByName(lost).checkpoint(eager=True)
    log = cfg.path("run_events")
    runs = claim_run_ids(wanted, storage.ensure_table(spark, log, RUN_EVENTS), cfg.path("_claims/run_id"),
                         ["location_id", "payload_file"], owner=owner).checkpoint(eager=True)
    run_openings(runs, cfg.run_ts).write.mode("append").parquet(log)
    guard = loads.where("passed IS NOT NULL").select("location_id", "row_count", "passed", "failure")
    rows = lookup_join(out.where("kind = 'row'"), dim, at, "inner").select("location_id", "ts", *HOURLY_VARS)
    rows = lookup_join(rows, runs.where("location_id IS NOT NULL").select("location_id", "run_id"), "location_id", "inner")
    run_ts = ntz(cfg.run_ts)
    storage.upsert_partitions(
        spark, cfg.path("raw_weather_hourly"), RAW_WEATHER_STORED, rows, ["location_id", "ts"], "date", ts_date("ts"),
        update_cols=[*HOURLY_VARS, "run_id"],
        insert_defaults={"source": DEFAULT_WEATHER_SOURCE, "ingested_at": run_ts}, touch={"ingested_at": run_ts})
    rows.groupBy("location_id").agg(F.max("ts").alias("ts")).withColumn("loaded_by", F.lit(checkpoint)) \
        .write.mode("append").parquet(cfg.path("watermarks"))
    close_runs(run_outcomes(runs, guard), cfg.run_ts).write.mode("append").parquet(log)


def stream_daily_loads(spark: SparkSession, cfg: FlowConfig, checkpoint: str,
                       max_files_per_trigger: int | None = None) -> int:
    """Load what has landed since the last call and stop; returns the number
    of batches. Tables are those of the batch flow below ``cfg.root``; ``as_of``
    and ``run_ts`` are those of this call, the marks come from the state that
    ``checkpoint`` holds."""
    reader = spark.readStream.schema(PAYLOAD).option("multiLine", cfg.multiline_payloads)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elements = keyed_elements(with_source(reader.json(cfg.landing)))
    seeded = elements.join(_seeds(spark, cfg, checkpoint), ["lat", "lon"], "left")
    as_of = dt.date.fromisoformat(str(cfg.as_of))
    loads = seeded.groupBy("lat", "lon").applyInPandasWithState(
        load_step(as_of, cfg.horizon_days, cfg.expected_rows), OUT_SCHEMA, STATE_SCHEMA, "append",
        GroupStateTimeout.NoTimeout)

    def sink(out: DataFrame, batch_id: int) -> None:
        mark = kept_so_far()
        try:
            _apply(spark, cfg, checkpoint, batch_id, out)
        finally:
            release_checked(mark)

    q = (loads.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p["numInputRows"])


__all__ = ["keyed_elements", "window_of", "load_step", "stream_daily_loads", "OUT_SCHEMA", "STATE_SCHEMA"]
