"""Stand-in golden values at sf0.01 (FIXTURES 4.2)."""

import os
from decimal import Decimal

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def q(spark, name):
    return E.queries()[name](spark, SF)


def test_golden_counts(spark):
    assert q(spark, "dim_people_latest").count() == 1079
    assert q(spark, "fact_events_good").count() == 8039
    assert q(spark, "mart_purchases_per_person").count() == 1079
    assert q(spark, "mart_top5_per_location").count() == 150 * 5
    assert q(spark, "fact_hourly_upsert").count() == 9567


def test_golden_values(spark):
    rev = {r.country: r.total_revenue for r in q(spark, "mart_revenue_by_country").collect()}
    assert rev == {"HOUSEHOLD": Decimal("10492.81"), "FURNITURE": Decimal("9592.14"),
                   "MACHINERY": Decimal("8635.78"), "AUTOMOBILE": Decimal("8530.14"),
                   "BUILDING": Decimal("7290.34"), "UNKNOWN": Decimal("4326.95")}
    summary = {r.reject_reason: r.rejected_count for r in q(spark, "quarantine_summary").collect()}
    assert summary == {"missing_email": 1000, "negative_amount": 702, "purchase_missing_amount": 259}
    counts = q(spark, "insert_update_counts").first()
    assert (counts.updated, counts.final_rows) == (619, 9567)


def test_inputs_grow_with_the_tables(spark):
    small = "/root/testdata/sf0.001"
    for name in ("fact_hourly_load", "run_state_latest", "location_labels", "dim_people_latest"):
        assert E.queries()[name](spark, SF).count() > 7 * E.queries()[name](spark, small).count()
    assert q(spark, "fact_hourly_load").count() >= 0.9 * 10_000
