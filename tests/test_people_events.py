"""Golden values of the five-people / five-events seed (FIXTURES 4.1)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import clean, marts, model, quality
from lakeshore.schemas import RAW_EVENTS, RAW_PEOPLE

T0 = dt.datetime(2026, 2, 6, 9, 0, 0)
RUN_TS = "2026-02-06 12:00:00"


@pytest.fixture()
def raw_people(spark):
    rows = [(1, "Ann Able", 23, "ann@example.com", "India", T0),
            (2, "Bo Birch", None, "bo@example.com", "USA", T0),
            (3, "Cy Cole", 26, None, "UK", T0),
            (4, "Di Drew", 43, "di@example.com", "USA", T0),
            (5, "Ed East", 45, "ed@example.com", "UK", T0)]
    return spark.createDataFrame(rows, RAW_PEOPLE)


@pytest.fixture()
def raw_events(spark):
    def ev(i, minute, email, etype, amount, source):
        return (i, T0.replace(hour=10, minute=minute), email, etype,
                None if amount is None else Decimal(amount), source, T0)
    rows = [ev(1, 0, "ann@example.com", "login", None, "web"),
            ev(2, 5, "di@example.com", "purchase", "29.99", "web"),
            ev(3, 7, "ed@example.com", "purchase", "199.00", "store"),
            ev(4, 10, None, "login", None, "web"),
            ev(5, 12, "nobody@example.com", "purchase", "10.00", "web")]
    return spark.createDataFrame(rows, RAW_EVENTS)


@pytest.fixture()
def dim(raw_people):
    return model.build_dim_people(clean.clean_people(raw_people, RUN_TS), raw_people, RUN_TS)


def test_null_profile(raw_people):
    r = clean.null_profile(raw_people, ["email", "age", "country"]).first()
    assert (r.total_rows, r.null_email, r.null_age, r.null_country) == (5, 1, 1, 0)


def test_dim_people_rows(dim):
    assert dim.count() == 4
    assert dim.where(F.col("email").isNull()).count() == 0


def test_fact_before_quarantine(raw_events, dim):
    fact = model.build_fact_events(raw_events.drop("created_at"), dim, RUN_TS)
    r = marts.unknown_person_counts(fact).first()
    assert fact.count() == 5
    assert (r.null_email_events, r.unknown_person_events) == (1, 2)


def test_quarantine_and_marts(raw_events, dim):
    good, bad = quality.quarantine(raw_events, quality.event_rules())
    assert {tuple(r) for r in quality.reject_summary(bad).collect()} == {("missing_email", 1)}
    fact = model.build_fact_events(good, dim, RUN_TS)
    assert fact.count() == 4
    rev = {r.country: r.total_revenue for r in marts.revenue_by_country(fact, dim).collect()}
    assert rev == {"UK": Decimal("199.00"), "USA": Decimal("29.99")}
    per = {r.email: (r.purchase_count, r.purchase_revenue)
           for r in marts.purchases_per_person(dim, fact).collect()}
    assert per == {"ed@example.com": (1, Decimal("199.00")), "di@example.com": (1, Decimal("29.99")),
                   "ann@example.com": (0, Decimal("0.00")), "bo@example.com": (0, Decimal("0.00"))}


def test_clean_rules(spark):
    rows = [(1, "  Ann  ", 130, "  ", "  ", T0), (2, "Bo", -1, " b@x ", None, T0),
            (3, "Cy", None, None, "\tUK", T0)]
    stg = clean.clean_people(spark.createDataFrame(rows, RAW_PEOPLE), RUN_TS).orderBy("person_id").collect()
    assert [(r.full_name, r.age, r.email, r.country) for r in stg] == [
        ("Ann", None, None, "UNKNOWN"), ("Bo", None, "b@x", "UNKNOWN"), ("Cy", None, None, "\tUK")]


def test_check_constraints_blank_type(spark, raw_events):
    extra = raw_events.limit(1).withColumn("event_type", F.lit("  ")).withColumn("event_id", F.lit(9).cast("long"))
    rep = {r.check_name: r.failed_rows for r in
           quality.check_report(raw_events.unionByName(extra), quality.event_checks()).collect()}
    assert rep["chk_event_type_not_blank"] == 1
    assert rep["chk_purchase_amount"] == 0
    assert rep["chk_amount_non_negative"] == 0


def test_build_people_mart_on_storage(spark, raw_people, raw_events, scratch):
    from lakeshore.plans.people import build_people_mart
    out = build_people_mart(spark, scratch, raw_people, raw_events.drop("created_at"), RUN_TS)
    rev = {r.country: r.total_revenue for r in out["revenue_by_country"].collect()}
    assert rev == {"UK": Decimal("199.00"), "USA": Decimal("29.99")}
    assert out["split_reconciliation"].first().reconciled
    assert {tuple(r) for r in out["quarantine_summary"].collect()} == {("missing_email", 1)}
    # second run with a changed person: the kept dimension is upserted, not rebuilt
    changed = raw_people.withColumn("country", F.when(F.col("person_id") == 5, "India").otherwise(F.col("country")))
    out2 = build_people_mart(spark, scratch, changed, raw_events.drop("created_at"), "2026-02-07 12:00:00")
    rev2 = {r.country: r.total_revenue for r in out2["revenue_by_country"].collect()}
    assert rev2 == {"India": Decimal("199.00"), "USA": Decimal("29.99")}
    from lakeshore.plans import storage
    assert storage.current_version(spark, f"{scratch}/dim_people") == 2
    assert storage.read_current(spark, f"{scratch}/dim_people").count() == 4


def test_people_command_line(spark, raw_people, raw_events, scratch):
    from lakeshore.__main__ import main
    raw_people.write.parquet(f"{scratch}/people")
    raw_events.write.parquet(f"{scratch}/events")
    assert main(["people", "--root", f"{scratch}/wh", "--people", f"{scratch}/people",
                 "--events", f"{scratch}/events", "--run-ts", RUN_TS]) == 0
    from lakeshore.plans import storage
    assert storage.read_current(spark, f"{scratch}/wh/fact_events").count() == 4
