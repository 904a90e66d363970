"""Plan shape checks: what must hold at 100 TB, checked on small data."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _indent(line):
    return len(line) - len(line.lstrip(" :+-"))


def single_partition_parents(p):
    """Operators fed by an Exchange SinglePartition. A global aggregate's
    final step (one partial row per task) is fine; a Window or Sort over all
    rows in one task is not."""
    lines = p.split("\n")
    parents = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            for j in range(i - 1, -1, -1):
                if _indent(lines[j]) < _indent(line):
                    parents.append(lines[j].strip(" :+-"))
                    break
    return parents


def test_no_single_task_window_or_sort(spark):
    for name in ["dim_people_latest", "mart_revenue_by_country", "mart_top5_per_location",
                 "fact_hourly_upsert", "qc_runs_report", "latest_day_per_location", "mart_daily_avg",
                 "events_quarantine", "location_keys", "multi_location_load"]:
        p = plan(E.queries()[name](spark, SF))
        for parent in single_partition_parents(p):
            assert parent.startswith(("HashAggregate", "ObjectHashAggregate", "SortAggregate")), (name, parent)


def test_top5_uses_group_limit_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(E.queries()["mart_top5_per_location"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p
    assert "Partial" in p


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F
    df = E.queries()["watermark_per_location"](spark, SF)
    p = plan(df)
    # the dedup under max(ts) is redundant: only the two columns are read
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p
    from lakeshore.sources.tables import driver_table
    li = driver_table(spark, SF, "lineitem").where(F.col("l_orderkey") < 10).select("l_orderkey")
    assert "PushedFilters: [IsNotNull(l_orderkey), LessThan(l_orderkey,10)]" in plan(li)


@pytest.mark.parametrize("name", ["mart_revenue_by_country", "mart_purchases_per_person"])
def test_marts_aggregate_before_join(spark, name):
    p = plan(E.queries()[name](spark, SF))
    # partial aggregation of the fact happens below the join
    assert p.count("HashAggregate") >= 2


def test_day_filter_is_a_pushed_range(spark, scratch):
    from pyspark.sql import functions as F

    from lakeshore.functions.scalar import date_lit, ts_date
    spark.range(48).select(F.col("id").alias("location_id"),
                           (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                            + F.make_dt_interval(F.lit(0), F.col("id").cast("int"), F.lit(0), F.lit(0)))
                           .alias("ts")).write.parquet(scratch)
    df = spark.read.parquet(scratch).where(ts_date("ts") == date_lit("2024-01-02"))
    p = plan(df)
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in p and "LessThan(ts,2024-01-03T00:00)" in p
    assert df.count() == 24


def test_stored_fact_files_are_sorted_by_key(spark, scratch):
    import pyarrow.parquet as pq
    import glob as g
    from lakeshore.functions.scalar import ts_date
    from lakeshore.plans import storage
    from lakeshore.schemas import RAW_WEATHER_STORED
    from lakeshore.session import local_path
    raw = E.queries()["fact_hourly_upsert"](spark, SF)
    storage.upsert_partitions(spark, scratch, RAW_WEATHER_STORED, raw, ["location_id", "ts"], "date",
                              ts_date("ts"), update_cols=["temperature_2m"])
    for f in g.glob(local_path(scratch) + "/date=*/*.parquet"):
        ids = pq.read_table(f, columns=["location_id"]).column(0).to_pylist()
        assert ids == sorted(ids)


def test_explain_analyze_counts_rows(spark):
    from lakeshore.plans.views import explain_analyze
    res = explain_analyze(E.queries()["duplicate_grain"](spark, SF))
    want = E.queries()["duplicate_grain"](spark, SF).count()
    assert res["rows"] == want and res["seconds"] >= 0
    assert "HashAggregate" in res["plan"]
