"""The people / events warehouse build, on stored tables.

raw -> profile -> stg_people (full refresh) -> dim_people (upsert into the
kept table) -> quarantine split -> quarantine_events (fresh ids) +
fact_events (published only if its CHECK, NOT NULL and key checks pass) ->
marts read back from storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.functions.scalar import ntz
from lakeshore.operators import clean, keys, marts, model, quality, upsert
from lakeshore.plans import storage
from lakeshore.schemas import DIM_PEOPLE, STG_PEOPLE

DIM_UPDATE_COLS = ["full_name", "age", "country", "source_person_id", "source_created_at", "updated_at"]


def _fact_checks(df: DataFrame) -> DataFrame:
    checks = quality.check_report(df, quality.event_checks(),
                                  not_null=["event_ts", "event_type", "is_known_person"])
    uniq = quality.unique_report(df, ["event_id"], "fact_events")
    return checks.select("check_name", "passed").unionByName(
        uniq.select(F.lit("unique_event_id").alias("check_name"), "passed"))


def _dim_checks(df: DataFrame) -> DataFrame:
    checks = quality.check_report(df, {}, not_null=["email", "full_name", "country", "source_person_id",
                                                    "source_created_at"])
    uniq = quality.unique_report(df, ["email"], "dim_people")
    return checks.select("check_name", "passed").unionByName(
        uniq.select(F.lit("unique_email").alias("check_name"), "passed"))


def build_people_mart(spark: SparkSession, root: str, raw_people: DataFrame, raw_events: DataFrame,
                      run_ts: str) -> dict[str, DataFrame]:
    root = root.rstrip("/")
    out: dict[str, DataFrame] = {
        "raw_profile": clean.null_profile(raw_people, ["email", "age", "country"]),
        "raw_age_out_of_range": clean.out_of_range(raw_people, "age", *clean.AGE_RANGE),
        "raw_duplicate_emails": keys.duplicate_keys(raw_people, ["email"], "cnt_email", skip_null_keys=True),
    }
    # staging: full refresh with defaults
    stg = storage.with_defaults(clean.clean_people(raw_people, run_ts).drop("load_ts"), STG_PEOPLE,
                                {"load_ts": ntz(run_ts)})
    storage.replace_table(stg, f"{root}/stg_people", note=run_ts)
    stg = storage.read_current(spark, f"{root}/stg_people", STG_PEOPLE)

    # dimension: a real upsert into the kept table
    latest = model.build_dim_people(stg, raw_people, run_ts)
    current = storage.read_current(spark, f"{root}/dim_people", DIM_PEOPLE)
    if current is None:
        current = spark.createDataFrame([], DIM_PEOPLE)
    dim = upsert.upsert(current, latest, ["email"], update_cols=DIM_UPDATE_COLS)
    storage.publish(dim, f"{root}/dim_people", _dim_checks, note=run_ts)
    dim = storage.read_current(spark, f"{root}/dim_people", DIM_PEOPLE)

    # quarantine split; both sides replace their tables (TRUNCATE + INSERT)
    good, bad = quality.quarantine(raw_events, quality.event_rules())
    bad = keys.assign_keys(bad.withColumn("quarantined_at", ntz(run_ts)), None, "quarantine_id", ["event_id"])
    storage.replace_table(bad, f"{root}/quarantine_events", note=run_ts)
    fact = model.build_fact_events(good, dim, run_ts)
    storage.publish(fact, f"{root}/fact_events", _fact_checks, note=run_ts)
    fact = storage.read_current(spark, f"{root}/fact_events")
    bad = storage.read_current(spark, f"{root}/quarantine_events")

    out.update({
        "stg_profile": stg.agg(F.count(F.lit(1)).alias("stg_count"),
                               F.count_if(F.col("email").isNull()).alias("null_email"),
                               F.count_if(F.col("country") == "UNKNOWN").alias("unknown_country"),
                               F.count_if(F.col("age").isNull()).alias("null_age")),
        "quarantine_summary": quality.reject_summary(bad),
        "split_reconciliation": quality.reconcile_split(raw_events, fact, bad),
        "unknown_person_counts": marts.unknown_person_counts(fact),
        "revenue_by_country": marts.revenue_by_country(fact, dim),
        "purchases_per_person": marts.purchases_per_person(dim, fact),
    })
    return out


__all__ = ["build_people_mart"]
