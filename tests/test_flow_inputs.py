"""The flow queries land whole tables; the flow's window chooses the days."""

from pyspark.sql import functions as F

from lakeshore import registry
from lakeshore.session import scratch_dir

SF = "/root/testdata/sf0.001"


def test_a_location_without_early_rows_fails_its_run(spark, monkeypatch):
    raw = registry._no_nulls(registry._raw_weather(spark, SF))
    late = raw.where("ts >= '2024-01-10' AND location_id % 5 <> 0 AND location_id % 7 <> 3").agg(
        F.min("location_id")).first()[0]
    name = registry.SI.locations(spark, SF).where(F.col("location_id") == late).first()["location_name"]
    monkeypatch.setattr(registry, "_raw_weather", lambda *_: raw.where(
        (F.col("location_id") != late) | (F.col("ts") >= "2024-01-10")))
    runs = registry.bad_payloads(spark, SF).where(F.col("location_name") == name).collect()
    assert [(r["status"], r["row_count"]) for r in runs] == [("FAILED", 0)]


def test_overlapping_fetches_land_every_day(spark):
    landing = scratch_dir(spark, "landing")
    registry._land_overlap(spark, SF, landing)
    days = spark.read.json(landing).select(F.explode("hourly.time").alias("t")).select(F.substring("t", 1, 10)).distinct()
    raw = registry._no_nulls(registry._raw_weather(spark, SF)).select(F.to_date("ts").cast("string")).distinct()
    assert {r[0] for r in days.collect()} == {r[0] for r in raw.collect()}


def test_the_rerun_lands_every_row(spark, monkeypatch):
    landed, make = [], registry._flow_root
    monkeypatch.setattr(registry, "_flow_root", lambda s, sf, rows: landed.append(rows.count()) or make(s, sf, rows))
    registry.daily_flow_rerun(spark, SF)
    assert landed == [registry._no_nulls(registry._raw_weather(spark, SF)).count()]
