"""Command line: run the daily flow or the post-load QC on a warehouse folder.

  python -m lakeshore flow --root R --landing L [--run-ts TS] [--as-of D]
  python -m lakeshore qc   --root R --run-ts TS [--window-hours 2] [--latest-only]
  python -m lakeshore people --root R --people P --events E [--run-ts TS]
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from lakeshore.fixed import QC_WINDOW_HOURS


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="lakeshore")
    sub = p.add_subparsers(dest="cmd", required=True)
    f = sub.add_parser("flow", help="ingest landed payloads -> QC gate -> export -> load")
    f.add_argument("--root", required=True, help="warehouse folder on the shared file system")
    f.add_argument("--landing", required=True, help="folder of landed payload JSON files")
    f.add_argument("--run-ts", default=None, help="NOW() of the run (default: current time)")
    f.add_argument("--as-of", default=None, help="today of the run (default: current date)")
    f.add_argument("--multiline", action="store_true", help="one JSON document per file")
    q = sub.add_parser("qc", help="post-load QC of the runs started in [run-ts, run-ts + window]")
    q.add_argument("--root", required=True)
    q.add_argument("--run-ts", required=True)
    q.add_argument("--window-hours", type=int, default=QC_WINDOW_HOURS)
    q.add_argument("--latest-only", action="store_true")
    pe = sub.add_parser("people", help="people / events build: staging, dimension, quarantine, fact, marts")
    pe.add_argument("--root", required=True)
    pe.add_argument("--people", required=True, help="parquet of raw_people")
    pe.add_argument("--events", required=True, help="parquet of raw_events")
    pe.add_argument("--run-ts", default=None)
    args = p.parse_args(argv)

    from lakeshore.session import get_session
    spark = get_session()
    now = dt.datetime.now().replace(microsecond=0)
    if args.cmd == "people":
        from lakeshore.plans.people import build_people_mart
        from lakeshore.schemas import RAW_EVENTS, RAW_PEOPLE
        from lakeshore.sources.tables import read_table
        out = build_people_mart(spark, args.root, read_table(spark, args.people, RAW_PEOPLE),
                                read_table(spark, args.events, RAW_EVENTS).drop("created_at"),
                                args.run_ts or now.strftime("%Y-%m-%d %H:%M:%S"))
        for name, df in out.items():
            print(f"== {name}")
            df.show(20, truncate=False)
        return 0
    if args.cmd == "flow":
        from lakeshore.plans.flow import FlowConfig, run_daily_flow
        cfg = FlowConfig(root=args.root, landing=args.landing,
                         run_ts=args.run_ts or now.strftime("%Y-%m-%d %H:%M:%S"),
                         as_of=args.as_of or now.date().isoformat(),
                         multiline_payloads=args.multiline)
        run_daily_flow(spark, cfg).show(truncate=False)
        return 0
    from lakeshore.operators.audit import runs_state
    from lakeshore.operators.quality import QualityError, gate, qc_runs
    from lakeshore.plans import storage
    from lakeshore.plans.flow import FlowConfig, PIPELINE
    from lakeshore.schemas import RAW_WEATHER_STORED
    cfg = FlowConfig(root=args.root, landing="", run_ts=args.run_ts, as_of="")
    state = runs_state(spark.read.parquet(cfg.path("run_events")))
    raw = storage.read_parts(spark, cfg.path("raw_weather_hourly"), RAW_WEATHER_STORED)
    report = qc_runs(state, raw, args.run_ts, args.window_hours, pipeline_name=PIPELINE,
                     latest_only=args.latest_only)
    report.show(100, truncate=False)
    try:
        gate(report, what="post-load QC")
    except QualityError as e:
        print(f"QC FAILED: {e}")
        return 1
    print("QC PASSED")
    return 0


if __name__ == "__main__":
    sys.exit(main())
