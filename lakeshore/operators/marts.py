"""End queries over the marts (M1-M10), sorted as the reference sorts them
(with a unique tail so the order is stable).

Where a mart joins a large fact to a dimension and then groups, the fact is
aggregated to the join key first: the join and the final grouping then see
one row per key instead of every event, and a hot key is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.fixed import PURCHASE
from lakeshore.functions.scalar import ts_date
from lakeshore.operators.keys import asc, desc, top_n_per_group
from lakeshore.plans.joins import lookup_join



def revenue_by_country(fact: DataFrame, dim_people: DataFrame) -> DataFrame:
    """SUM(amount) of purchases by country, known persons only."""
    per_email = fact.where(F.col("event_type") == PURCHASE).groupBy("email").agg(
        F.sum("amount").alias("_rev"))
    j = per_email.join(dim_people.select("email", "country"), "email")
    out = j.groupBy("country").agg(F.sum("_rev").cast("decimal(20,2)").alias("total_revenue"))
    return out.orderBy(F.col("total_revenue").desc_nulls_first(), "country")


def purchases_per_person(dim_people: DataFrame, fact: DataFrame) -> DataFrame:
    """Every person, with purchase count and revenue (0 when none)."""
    is_p = F.col("event_type") == PURCHASE
    per_email = fact.groupBy("email").agg(
        F.count_if(is_p).alias("_cnt"), F.sum(F.when(is_p, F.col("amount"))).alias("_rev"))
    j = dim_people.select("email", "full_name").join(per_email, "email", "left")
    out = j.select("email", "full_name",
                   F.coalesce("_cnt", F.lit(0)).cast("bigint").alias("purchase_count"),
                   F.coalesce("_rev", F.lit(0)).cast("decimal(20,2)").alias("purchase_revenue"))
    return out.orderBy(F.col("purchase_revenue").desc(), "email")


def activity_per_person(dim_people: DataFrame, fact: DataFrame) -> DataFrame:
    """Left join keeping zero-activity people: events and purchases per person."""
    is_p = F.col("event_type") == PURCHASE
    per_email = fact.groupBy("email").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(is_p).alias("_p"),
        F.sum(F.when(is_p, F.col("amount"))).alias("_rev"))
    j = dim_people.select("email").join(per_email, "email", "left")
    return j.select("email",
                    F.coalesce("_n", F.lit(0)).cast("bigint").alias("event_count"),
                    F.coalesce("_p", F.lit(0)).cast("bigint").alias("purchase_count"),
                    F.coalesce("_rev", F.lit(0)).cast("decimal(20,2)").alias("purchase_revenue"),
                    F.col("_n").isNull().alias("no_activity"))


def unknown_person_counts(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_if(F.col("email").isNull()).alias("null_email_events"),
                    F.count_if(~F.col("is_known_person")).alias("unknown_person_events"))


def _daily(fact: DataFrame, dim_location: DataFrame, measure: str):
    """Per (location_id, day) partial sums, then labelled (LEFT JOIN)."""
    per_loc = fact.groupBy("location_id", ts_date("ts").alias("date")).agg(
        F.sum(measure).alias("_sum"), F.count(measure).alias("_cnt"))
    return lookup_join(per_loc, dim_location.select("location_id", "location_name"),
                       "location_id", "left")


def daily_avg_temperature(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """AVG(temperature_2m) by (location_name, ts::date); exact decimal sum
    divided by the count, so partial sums combine without rounding."""
    j = _daily(fact, dim_location, "temperature_2m")
    g = j.groupBy("location_name", "date").agg(F.sum("_sum").alias("_s"), F.sum("_cnt").alias("_c"))
    out = g.select("location_name", "date",
                   (F.col("_s").cast("double") / F.col("_c")).alias("average_temperature_city"))
    return out.orderBy(F.col("date").desc(), "location_name")


def daily_total_precipitation(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    j = _daily(fact, dim_location, "precipitation")
    out = j.groupBy("location_name", "date").agg(
        F.sum("_sum").cast("decimal(28,6)").alias("total_precipitation_city"))
    return out.orderBy(F.col("date").desc(), "location_name")


def windiest_hours(fact: DataFrame, dim_location: DataFrame, n: int = 5) -> DataFrame:
    """Top-n hours by wind speed per location_name (NULL speed first, as the
    reference's database sorts DESC; ties by ts, location_id).

    Names can merge several ids, so the top n per id is taken first (a
    WindowGroupLimit before any shuffle), labelled, then ranked per name."""
    order = [desc("windspeed_10m", nulls_first=True), asc("ts"), asc("location_id")]
    per_id = top_n_per_group(fact.select("location_id", "ts", "windspeed_10m"),
                             ["location_id"], order, n).drop("rn")
    labelled = lookup_join(per_id, dim_location.select("location_id", "location_name"),
                           "location_id", "left")
    ranked = top_n_per_group(labelled, ["location_name"], order, n)
    return ranked.select("location_name", "ts", "windspeed_10m", "rn") \
        .orderBy("location_name", F.col("windspeed_10m").desc_nulls_first(), "rn")


# ---------------------------------------------------------------- marts from stored partials

# An hour in the order of the windiest: NULL speed first, then falling speed,
# then time. Hours of one location compare as structs, the smallest first.
HOUR = "struct<known:boolean,calm:decimal(19,6),ts:timestamp_ntz>"


def _hour():
    return F.struct(F.col("windspeed_10m").isNotNull().alias("known"),
                    (-F.col("windspeed_10m")).cast("decimal(19,6)").alias("calm"), F.col("ts").alias("ts"))


def day_partials(fact: DataFrame, n: int = 5) -> DataFrame:
    """What the marts need of each (location_id, day): exact sums and counts,
    and its ``n`` windiest hours. Parts of a day can be added up, days merged."""
    return fact.groupBy("location_id", ts_date("ts").alias("date")).agg(
        F.sum("temperature_2m").cast("decimal(28,6)").alias("warmth"), F.count("temperature_2m").alias("measured"),
        F.sum("precipitation").cast("decimal(28,6)").alias("wet"),
        # A location's day has at most 24 hours.
        F.slice(F.sort_array(F.collect_list(_hour())), 1, n).cast(f"array<{HOUR}>").alias("hours"))


def _named_days(partials: DataFrame, dim_location: DataFrame) -> DataFrame:
    return lookup_join(partials, dim_location.select("location_id", "location_name"), "location_id", "left") \
        .groupBy("location_name", "date")


def daily_avg_from(partials: DataFrame, dim_location: DataFrame) -> DataFrame:
    """:func:`daily_avg_temperature` without its fact."""
    out = _named_days(partials, dim_location).agg(F.sum("warmth").alias("_s"), F.sum("measured").alias("_c"))
    return out.select("location_name", "date", F.when(F.col("_c") > 0, F.col("_s").cast("double") / F.col("_c")).alias(
        "average_temperature_city")).orderBy(F.col("date").desc(), "location_name")


def daily_total_from(partials: DataFrame, dim_location: DataFrame) -> DataFrame:
    """:func:`daily_total_precipitation` without its fact."""
    out = _named_days(partials, dim_location).agg(F.sum("wet").cast("decimal(28,6)").alias("total_precipitation_city"))
    return out.orderBy(F.col("date").desc(), "location_name")


def top_hours(partials: DataFrame, n: int = 5) -> DataFrame:
    """(location_id, hours): the ``n`` windiest hours over the days given."""
    hours = partials.select("location_id", F.explode("hours").alias("h")).select("location_id", "h", "h.*")
    best = top_n_per_group(hours, ["location_id"], [asc("known"), asc("calm", nulls_first=True), asc("ts")], n)
    return best.groupBy("location_id").agg(F.sort_array(F.collect_list("h")).alias("hours"))


def merge_top_hours(old: DataFrame, changed: DataFrame, days: list, n: int = 5) -> DataFrame:
    """``old`` top hours after the ``days`` were replaced by what ``changed``
    (top hours of those days alone) says: (location_id, hours, exact). Hours
    of other days that never made it into ``old`` all rank behind its last one,
    so the merge is exact unless its own last one ranks behind that too."""
    stays = F.filter("old_hours", lambda h: ~h["ts"].cast("date").isin(days)) if days else F.col("old_hours")
    none = F.array().cast(f"array<{HOUR}>")
    both = old.withColumnRenamed("hours", "old_hours").join(changed.withColumnRenamed("hours", "new_hours"),
                                                            "location_id", "full_outer")
    merged = F.slice(F.sort_array(F.concat(F.coalesce(stays, none), F.coalesce("new_hours", none))), 1, n)
    exact = (F.coalesce(F.size("old_hours"), F.lit(0)) < n) | (
        (F.size("hours") == n) & (F.element_at("hours", -1) <= F.element_at("old_hours", -1)))
    return both.withColumn("hours", merged).select("location_id", "hours", F.coalesce(exact, F.lit(True)).alias("exact"))


def windiest_from(top: DataFrame, dim_location: DataFrame, n: int = 5) -> DataFrame:
    """:func:`windiest_hours` from each location's top hours."""
    hours = top.select("location_id", F.explode("hours").alias("h")).select(
        "location_id", "h.ts", (-F.col("h.calm")).cast("decimal(18,6)").alias("windspeed_10m"))
    order = [desc("windspeed_10m", nulls_first=True), asc("ts"), asc("location_id")]
    labelled = lookup_join(hours, dim_location.select("location_id", "location_name"), "location_id", "left")
    return top_n_per_group(labelled, ["location_name"], order, n).select("location_name", "ts", "windspeed_10m", "rn") \
        .orderBy("location_name", F.col("windspeed_10m").desc_nulls_first(), "rn")


def recent_runs(runs: DataFrame, pipeline_name: str | None = None, k: int = 10) -> DataFrame:
    """ORDER BY run_id DESC LIMIT k (TakeOrderedAndProject: top-k per task)."""
    if pipeline_name is not None:
        runs = runs.where(F.col("pipeline_name") == pipeline_name)
    return runs.orderBy(F.col("run_id").desc()).limit(k)


def latest_run_rows(raw: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of the latest run: WHERE run_id = (SELECT MAX(run_id) ...)."""
    return raw.where(F.col("run_id") == runs.select(F.max("run_id")).scalar())


def latest_days(days: DataFrame, dim_location: DataFrame) -> DataFrame:
    """(location_name, location_id, date): the last day that any location of
    its name has, from (location_id, date)."""
    dim = dim_location.select("location_id", "location_name")
    per_id = days.groupBy("location_id").agg(F.max("date").alias("_d"))
    per_name = lookup_join(per_id, dim, "location_id", "inner") \
        .groupBy("location_name").agg(F.max("_d").alias("date"))
    return dim.join(per_name, "location_name").select("location_id", "location_name", "date")


def latest_day_rows(raw: DataFrame, dim_location: DataFrame, of_id: DataFrame | None = None) -> DataFrame:
    """Per location_name, every row of its latest day, with the label. A
    stored day column ``date`` is used as it is, so that its partitions prune;
    otherwise the day comes from ts. ``of_id`` gives what :func:`latest_days`
    says where that is known without reading the rows."""
    dated = raw if "date" in raw.columns else raw.withColumn("date", ts_date("ts"))
    if of_id is None:
        of_id = latest_days(dated, dim_location)
    return lookup_join(dated, of_id, ["location_id", "date"], "inner").select(
        "location_name", "location_id", "ts", "temperature_2m", "precipitation", "windspeed_10m", "source",
        "ingested_at", "run_id", "date")


__all__ = ["revenue_by_country", "purchases_per_person", "activity_per_person",
           "unknown_person_counts", "daily_avg_temperature", "daily_total_precipitation",
           "windiest_hours", "day_partials", "daily_avg_from", "daily_total_from", "top_hours", "merge_top_hours",
           "windiest_from", "HOUR", "recent_runs", "latest_run_rows", "latest_days",
           "latest_day_rows"]
