"""Dedup, top-N, surrogate keys and upsert: brute-force and property checks."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeshore.operators import keys, upsert


def test_latest_per_key_matches_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randrange(20), rnd.choice([None, rnd.randrange(5)]), i, rnd.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t int, id int, v double")
    got = keys.latest_per_key(df, ["k"], [keys.desc("t"), keys.desc("id")])
    w = Window.partitionBy("k").orderBy(F.col("t").desc_nulls_first(), F.col("id").desc_nulls_first())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(got.collect()) == sorted(want.collect())
    got_asc = keys.latest_per_key(df, ["k"], [keys.asc("t"), keys.asc("id")])
    w2 = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last())
    want2 = df.withColumn("rn", F.row_number().over(w2)).where("rn = 1").drop("rn")
    assert sorted(got_asc.collect()) == sorted(want2.collect())


def test_latest_per_key_plan_is_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = keys.latest_per_key(df, ["k"], [keys.desc("t")])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan


def test_top_n_per_group(spark):
    rows = [(g, i, float((i * 37) % 11)) for g in range(3) for i in range(30)]
    df = spark.createDataFrame(rows, "g int, i int, v double")
    got = keys.top_n_per_group(df, ["g"], [keys.desc("v"), keys.asc("i")], 4)
    for g in range(3):
        mine = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:4]
        assert sorted((r.g, r.i, r.v) for r in got.where(F.col("g") == g).collect()) == sorted(mine)


def test_assign_keys_dense_and_ordered(spark):
    existing = spark.createDataFrame([(5, "a"), (9, "b")], "id long, name string")
    new = spark.createDataFrame([(n,) for n in ["z", "c", "m", "d"]], "name string").repartition(3)
    out = keys.assign_keys(new, existing, "id", ["name"]).orderBy("id").collect()
    assert [(r.id, r.name) for r in out] == [(10, "c"), (11, "d"), (12, "m"), (13, "z")]


KEYS = st.integers(min_value=0, max_value=15)


@settings(max_examples=8, deadline=None)
@given(target=st.dictionaries(KEYS, st.integers(0, 99), max_size=12),
       source=st.dictionaries(KEYS, st.one_of(st.none(), st.integers(0, 99)), max_size=12))
def test_upsert_properties(spark, target, source):
    t = spark.createDataFrame([(k, v, "old") for k, v in target.items()] or [], "k int, v int, tag string")
    s = spark.createDataFrame([(k, v) for k, v in source.items()] or [], "k int, v int")
    out = upsert.upsert(t, s, ["k"], update_cols=["v"], insert_defaults={"tag": "new"})
    got = {r.k: (r.v, r.tag) for r in out.collect()}
    want = {k: (v, "old") for k, v in target.items()}
    for k, v in source.items():
        want[k] = (v, want[k][1] if k in want else "new")
    assert got == want                                   # NULL from the source overwrites
    assert out.count() == len(got)                       # keys stay unique
    again = upsert.upsert(out, s, ["k"], update_cols=["v"], insert_defaults={"tag": "new"})
    assert sorted(again.collect()) == sorted(out.collect())   # idempotent


def test_upsert_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, 1)], "k int, v int")
    s = spark.createDataFrame([(2, 5, 1), (2, 6, 2)], "k int, v int, seq int")
    try:
        upsert.upsert(t, s.drop("seq"), ["k"])
    except upsert.DuplicateKeyError:
        pass
    else:
        raise AssertionError("duplicate source keys must fail by default")
    out = upsert.upsert(t, s, ["k"], update_cols=["v"], on_duplicate="last", order_by=[keys.desc("seq")])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, 1), (2, 6)]


def test_insert_missing(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (2, "b"), (2, "b")], "k int, v string")
    assert sorted(tuple(r) for r in upsert.insert_missing(t, s, ["k"]).collect()) == [(1, "a"), (2, "b")]


def test_resolve_locations_keeps_ids(spark):
    dim = spark.createDataFrame([(1, "Chicago, IL", 41.8781, -87.6298)],
                                "location_id long, location_name string, latitude double, longitude double") \
        .select("location_id", "location_name", F.col("latitude").cast("decimal(9,6)").alias("latitude"),
                F.col("longitude").cast("decimal(9,6)").alias("longitude"))
    inc = spark.createDataFrame([(41.8781, -87.6298, "Chicago"), (40.7128, -74.0060, "New York, NY")],
                                "latitude double, longitude double, location_name string") \
        .select(F.col("latitude").cast("decimal(9,6)").alias("latitude"),
                F.col("longitude").cast("decimal(9,6)").alias("longitude"), "location_name")
    out = {r.location_name: r.location_id for r in upsert.resolve_locations(dim, inc).collect()}
    assert out == {"Chicago": 1, "New York, NY": 2}


def test_sized_broadcast_falls_back_to_shuffle(spark):
    from lakeshore.plans.joins import sized_broadcast
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(1000).select((F.col("id") % 10).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ok = big.join(sized_broadcast(small, max_rows=100), "k")._jdf.queryExecution().executedPlan().toString()
        over = big.join(sized_broadcast(small, max_rows=5), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in ok
    assert "SortMergeJoin" in over


def test_sized_broadcast_checks_bytes(spark):
    # few rows but wide values: the byte bound, not the row bound, decides
    from lakeshore.plans.joins import _row_bytes, sized_broadcast
    small = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("label"))
    size = small.agg(F.sum(_row_bytes(small.schema))).first()[0]
    assert 10 * 1000 < size < 10 * 1100
    big = spark.range(1000).select((F.col("id") % 10).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ok = big.join(sized_broadcast(small, max_rows=100, max_bytes=1 << 20), "k") \
            ._jdf.queryExecution().executedPlan().toString()
        over = big.join(sized_broadcast(small, max_rows=100, max_bytes=5000), "k") \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in ok
    assert "SortMergeJoin" in over


def test_hot_key_is_combined_before_shuffle(spark):
    # one key holds a third of all rows: the partial aggregate must reduce it
    # to one row per task before the exchange
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("t")).repartition(6)
    out = keys.latest_per_key(df, ["k"], [keys.desc("t")])
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in p
    assert out.where("k = 0").first().t == 2997


def test_latest_per_key_mixed_directions(spark):
    import datetime as dt
    rnd = random.Random(11)
    rows = [(rnd.randrange(15), rnd.choice([None, rnd.randrange(4)]),
             rnd.choice([None, dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(5))]),
             rnd.choice(["a", "b", None]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, d date, s string, id int")
    cases = [
        [keys.desc("t"), keys.asc("d"), keys.asc("id")],
        [keys.asc("t", nulls_first=True), keys.desc("d"), keys.desc("id")],
        [keys.desc("s"), keys.asc("id")],              # string against the majority -> window form
    ]
    for order in cases:
        got = keys.latest_per_key(df, ["k"], order)
        w = Window.partitionBy("k").orderBy(*[o.sort_col() for o in order])
        want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
        assert sorted(got.collect()) == sorted(want.collect()), order


def test_load_report_by_file(spark):
    from lakeshore.streaming.file_load import load_report
    loaded = spark.createDataFrame([("s3://b/raw/dt=2026-02-24/city=Chicago_IL/part-0.csv",)] * 3 +
                                   [("s3://b/raw/dt=2026-02-24/city=New_York_NY/part-1.csv",)], "file string")
    report = load_report(loaded, by_file=True)
    assert [(r.status, r.rows_loaded) for r in report.where("file IS NULL").collect()] == [("TOTAL", 4)]
    per_file = {r.file.split("/")[-2]: (r.status, r.rows_loaded) for r in report.where("file IS NOT NULL").collect()}
    assert per_file == {"city=Chicago_IL": ("LOADED", 3), "city=New_York_NY": ("LOADED", 1)}
    per_part = {(r.dt, r.city): (r.files, r.rows_loaded) for r in load_report(loaded).collect()}
    assert per_part == {("2026-02-24", "Chicago_IL"): (1, 3), ("2026-02-24", "New_York_NY"): (1, 1)}


@settings(max_examples=6, deadline=None)
@given(batches=st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 48)), max_size=10),
                        min_size=1, max_size=3))
def test_watermark_never_goes_back(spark, batches):
    import datetime as dt
    t0 = dt.datetime(2026, 3, 1)
    table = spark.createDataFrame([], "location_id int, ts timestamp_ntz, v int")
    marks = {}
    for i, batch in enumerate(batches):
        rows = {(loc, t0 + dt.timedelta(hours=h)): i for loc, h in batch}
        src = spark.createDataFrame([(k[0], k[1], v) for k, v in rows.items()] or [],
                                    "location_id int, ts timestamp_ntz, v int")
        table = spark.createDataFrame(
            upsert.upsert(table, src, ["location_id", "ts"], update_cols=["v"]).collect(), table.schema)
        now = {r.location_id: r.max_ts for r in keys.watermarks(table).collect()}
        for loc, m in marks.items():
            assert now[loc] >= m
        marks = now


def test_upsert_rejects_null_keys(spark):
    import pytest
    t = spark.createDataFrame([(1, 1)], "k int, v int")
    s = spark.createDataFrame([(None, 5)], "k int, v int")
    with pytest.raises(upsert.NullKeyError):
        upsert.upsert(t, s, ["k"])


def test_lookup_flag_spreads_null_keys_over_the_bound(spark):
    # a third of the fact has a NULL key; above the broadcast bound the join
    # shuffles, and the NULL rows must not all land in one task
    from lakeshore.operators.model import lookup_flag
    fact = spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 50).cast("string")).alias("email"))
    dim = spark.range(0, 50, 2).select(F.col("id").cast("string").alias("email"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shuffled = lookup_flag(fact, dim, "email", "known", max_rows=5)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        nulls = shuffled.where(F.col("email").isNull()) \
            .select(F.spark_partition_id().alias("p")).distinct().count()
        got = sorted((r.event_id, r.known) for r in shuffled.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = sorted((r.event_id, r.known) for r in lookup_flag(fact, dim, "email", "known").collect())
    assert "SortMergeJoin" in plan
    assert nulls > 1
    assert got == want and len(got) == 3000
    assert sum(k for _, k in got) == sum(1 for i in range(3000) if i % 3 and (i % 50) % 2 == 0)
