"""Marts from changed days, content reconciliation, hour gaps, the latest day
from stored counts, and the join of heavy keys."""

import datetime as dt
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeshore.functions.scalar import ts_date
from lakeshore.operators import marts, quality
from lakeshore.plans import export, mart_refresh, storage
from lakeshore.plans.joins import heavy_join
from lakeshore.schemas import MART_DAYS, MEASURE, RAW_WEATHER_STORED

LABELS = "location_id long, location_name string"


def weather(spark, rows):
    """rows: (location, day of March, hour, temperature, precipitation, wind)."""
    out = [(k, dt.datetime(2026, 3, d, h), t, p, w, 1) for k, d, h, t, p, w in rows]
    df = spark.createDataFrame(out, "location_id long, ts timestamp_ntz, temperature_2m double, precipitation double, "
                                    "windspeed_10m double, run_id long")
    return df.select("location_id", "ts", *[F.col(c).cast(MEASURE).alias(c) for c in (
        "temperature_2m", "precipitation", "windspeed_10m")], "run_id")


def load(spark, path, rows, **args):
    storage.upsert_partitions(spark, path, RAW_WEATHER_STORED, weather(spark, rows), ["location_id", "ts"], "date",
                              ts_date("ts"), **args)


def labels(spark):
    # Locations 1 and 2 share a name; 4 has none.
    return spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (5, "C")], LABELS)


def some(r, locations, days, low=0):
    return [(k, d, h, r.choice([None, round(r.uniform(-5, 30), 2)]), r.choice([None, 0.5]),
             r.choice([None, r.randint(low, 100) / 4])) for k in locations for d in days for h in r.sample(range(24), 4)]


def test_refreshed_marts_equal_a_full_build(spark, scratch, monkeypatch):
    r = random.Random(8)
    fact, dim = f"{scratch}/fact", labels(spark)
    read, asked = storage.read_parts, []

    def noted(spark_, path, schema, only=None):
        asked.append((path.rsplit("/", 1)[1], only))
        return read(spark_, path, schema, only=only)
    batches = [some(r, [1, 2, 3, 4], range(1, 7)), some(r, [1, 3, 5], [2, 7]),
               # everything on three days falls calm: hours of other days come in again
               [(k, d, h, 1.0, 0.0, 0.0) for k in (1, 2, 3) for d in (2, 3, 4) for h in range(24)],
               some(r, [2, 4], [1, 6], low=90)]
    for i, rows in enumerate(batches):
        load(spark, fact, rows)
        with monkeypatch.context() as m:
            m.setattr(storage, "read_parts", noted)
            if i == 2:  # dies between its two tables: the next refresh makes up for it
                m.setattr(storage, "replace_table", lambda *a, **k: (_ for _ in ()).throw(OSError("no room")))
                with pytest.raises(OSError):
                    mart_refresh.refresh_marts(spark, scratch, fact, RAW_WEATHER_STORED)
                assert mart_refresh._seen(spark, f"{scratch}/mart_days") == 3
                continue
            mart_refresh.refresh_marts(spark, scratch, fact, RAW_WEATHER_STORED)
        whole = storage.read_parts(spark, fact, RAW_WEATHER_STORED)
        got = mart_refresh.read_marts(spark, scratch, dim)
        for name, full in (("daily_avg", marts.daily_avg_temperature), ("daily_total", marts.daily_total_precipitation),
                           ("windiest", marts.windiest_hours)):
            assert Counter(map(tuple, got[name].collect())) == Counter(map(tuple, full(whole, dim).collect())), (i, name)
    days = {p: [set(o) for q, o in asked if q == p and o is not None] for p in ("fact", "mart_days")}
    assert [sorted(d) for d in days["fact"]] == [
        [f"2026-03-0{d}" for d in sorted({x[1] for x in rows})] for rows in batches]
    assert mart_refresh.refresh_marts(spark, scratch, fact, RAW_WEATHER_STORED) == []


def test_a_merge_says_when_it_is_not_exact(spark):
    def top(hours):  # {location: [(day, wind)]}, in order
        rows = [(k, [(True, -float(w), dt.datetime(2026, 3, d)) for d, w in own]) for k, own in hours.items()]
        frame = spark.createDataFrame(rows, "location_id long, hours array<struct<known:boolean,calm:double,ts:timestamp_ntz>>")
        return frame.select("location_id", F.col("hours").cast(MART_DAYS["hours"].dataType).alias("hours"))
    old = top({1: [(1, 9), (2, 8)], 2: [(1, 9), (2, 8)], 3: [(2, 9)], 4: [(2, 9), (3, 8)]})
    new = top({1: [(1, 5)], 2: [(1, 8.5)], 3: [(1, 1)], 5: [(1, 1)]})
    got = {r.location_id: ([h.ts.day for h in r.hours], r.exact) for r in marts.merge_top_hours(
        old, new, [dt.date(2026, 3, 1)], 2).collect()}
    # 1: its hour of day 1 fell behind the old last one: another day's may be better.
    assert got == {1: ([2, 1], False), 2: ([1, 2], True), 3: ([2, 1], True), 4: ([2, 3], True), 5: ([1], True)}


LEVELS = [["day"], ["day", "k"], ["day", "k", "n"]]


def test_content_differences_equal_brute_force(spark):
    r = random.Random(3)
    rows = [(r.choice([1, 2, 3, None]), r.randrange(6), i, r.choice([None, 1.5, 2.0])) for i in range(400)]
    copy = [x for i, x in enumerate(rows) if i % 37 != 5] + [rows[11], rows[12], rows[12], (9, 9, 9, None)]
    copy = [(*x[:3], 7.0) if x[2] % 41 == 1 else x for x in copy]
    schema = "day int, k int, n int, v double"
    a, b = (spark.createDataFrame(x, schema).repartition(3) for x in (rows, copy))
    left, right = Counter(rows), Counter(copy)
    by = {x[:3] for x in (left - right) + (right - left)}
    want = {}
    for key in by:
        n, m = (sum(c for x, c in side.items() if x[:3] == key) for side in (left, right))
        want[key] = (n, m, "lost" if not m else "added" if not n else "doubled" if m > n else "thinned" if m < n else "changed")
    got = {(x.day, x.k, x.n): (x.left_rows, x.right_rows, x.kind) for x in quality.reconcile_content(a, b, LEVELS).collect()}
    assert got == want and {w[2] for w in want.values()} >= {"lost", "added", "doubled", "changed"}
    back = {k: v[2] for k, v in {(x.day, x.k, x.n): tuple(x[3:]) for x in quality.reconcile_content(b, a, LEVELS).collect()}.items()}
    swap = {"lost": "added", "added": "lost", "doubled": "thinned", "thinned": "doubled", "changed": "changed"}
    assert back == {k: swap[v[2]] for k, v in want.items()}
    same = quality.reconcile_content(a, a.repartition(5), LEVELS)
    assert same.collect() == [] and same.columns == ["day", "k", "n", "left_rows", "right_rows", "kind"]
    assert quality.reconcile_content(a.limit(0), b.limit(0), LEVELS).count() == 0
    assert quality.reconcile_content(a, a.limit(0), LEVELS).where("kind = 'lost'").count() == len(set(x[:3] for x in rows))


def test_lost_against_doubled_in_one_group(spark):
    # Counts agree in all, by day and by key group; only the contents differ.
    a = spark.createDataFrame([(1, 1, 1, 1.0), (1, 1, 2, 2.0)], "day int, k int, n int, v double")
    b = spark.createDataFrame([(1, 1, 1, 1.0), (1, 1, 1, 1.0)], "day int, k int, n int, v double")
    assert {(x.n, x.kind) for x in quality.reconcile_content(a, b, LEVELS).collect()} == {(1, "doubled"), (2, "lost")}


def test_hour_gaps(spark):
    def at(d, h):
        return dt.datetime(2026, 3, d, h)
    rows = [(1, at(1, h)) for h in range(24)] + [(2, at(1, 0)), (2, at(1, 0)), (2, at(1, 5)), (2, at(1, 23)), (2, at(2, 3)),
                                                 (3, None), (4, at(1, 1)), (4, dt.datetime(2026, 3, 1, 2, 30)), (9, at(1, 1))]
    frame = spark.createDataFrame(rows, "location_id long, ts timestamp_ntz")
    groups = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,)], "location_id long")
    got = {tuple(r) for r in quality.hour_gaps(frame, groups, "location_id", "2026-03-01 00:00:00",
                                               "2026-03-01 23:00:00").collect()}
    assert got == {(2, at(1, 1), at(1, 4), 4), (2, at(1, 6), at(1, 22), 17), (3, at(1, 0), at(1, 23), 24),
                   (4, at(1, 0), at(1, 0), 1), (4, at(1, 3), at(1, 23), 21)}


def test_the_latest_day_is_read_alone(spark, scratch):
    dim = labels(spark)
    first = [(k, d, 5, 1.0, 0.0, 2.0) for k in (1, 2, 3) for d in range(1, 6)]
    load(spark, scratch, first, summary_by=["location_id"])
    load(spark, scratch, [(2, 7, h, 1.0, 0.0, 2.0) for h in range(3)] + [(4, 9, 1, 1.0, 0.0, 1.0)], summary_by=["location_id"])
    load(spark, scratch, [(1, 3, 6, 9.0, 0.0, 2.0)], summary_by=["location_id"])
    summary = storage.read_summary(spark, scratch, RAW_WEATHER_STORED, ["location_id"])
    whole = storage.read_parts(spark, scratch, RAW_WEATHER_STORED)
    counts = whole.groupBy("location_id", "date").count()
    assert Counter(map(tuple, summary.collect())) == Counter(map(tuple, counts.collect()))
    got = export.stored_latest_rows(spark, scratch, RAW_WEATHER_STORED, dim)
    want = marts.latest_day_rows(whole, dim)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select(*got.columns).collect()))
    assert {f.split("date=")[1].split("/")[0] for f in got.inputFiles() if "date=" in f} == {"2026-03-05", "2026-03-07"}
    load(spark, scratch, [(3, 8, 1, 1.0, 0.0, 1.0)])  # without counts: taken from the rows
    again = storage.read_summary(spark, scratch, RAW_WEATHER_STORED, ["location_id"])
    assert again.where("date = '2026-03-08'").count() == 1
    assert storage.read_summary(spark, f"{scratch}/none", RAW_WEATHER_STORED, ["location_id"]).count() == 0


def test_heavy_keys_stay_where_they_are(spark):
    n = 60_000
    big = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(
        F.xxhash64("id") % 20_000).cast("long").alias("k"), "id").repartition(6)
    small = spark.range(-15_000, 15_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        got, want = heavy_join(big, small, "k", how), big.join(small, "k", how)
        assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == want.count()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        spread = heavy_join(big, small, "k", "left").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    sizes = [r["count"] for r in spread]
    assert max(sizes) <= 2 * statistics.median(sizes)
    two = big.withColumn("j", F.col("k") % 2)
    pairs = small.withColumn("j", F.col("k") % 2)
    assert heavy_join(two, pairs, ["k", "j"], "left").count() == n
    with pytest.raises(ValueError, match="left or inner"):
        heavy_join(big, small, "k", "right")
    assert heavy_join(big.limit(0), small, "k", "left").count() == 0
