"""Cleaning and profiling (P2, P6, A2, Q13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.scalar import blank_to_null, default_if_blank, ntz, null_outside
from lakeshore.fixed import AGE_MAX, AGE_MIN, UNKNOWN_COUNTRY

AGE_RANGE = (AGE_MIN, AGE_MAX)


def clean_people(raw: DataFrame, run_ts) -> DataFrame:
    """raw_people -> stg_people: trim name, out-of-range age -> NULL,
    blank email -> NULL, blank country -> 'UNKNOWN', load_ts = run_ts."""
    lo, hi = AGE_RANGE
    return raw.select(
        "person_id",
        F.trim("full_name").alias("full_name"),
        null_outside("age", lo, hi).alias("age"),
        blank_to_null("email").alias("email"),
        default_if_blank("country", UNKNOWN_COUNTRY).alias("country"),
        ntz(run_ts).alias("load_ts"),
    )


def out_of_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """Rows whose value is present and outside [lo, hi]."""
    c = F.col(column)
    return df.where(c.isNotNull() & ((c < lo) | (c > hi)))


def null_profile(df: DataFrame, columns: Sequence[str], total: str = "total_rows",
                 extra: dict | None = None) -> DataFrame:
    """One pass: COUNT(*) and COUNT(*) FILTER (WHERE c IS NULL) per column,
    plus any extra named conditions."""
    aggs = [F.count(F.lit(1)).alias(total)]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    aggs += [F.count_if(cond).alias(name) for name, cond in (extra or {}).items()]
    return df.agg(*aggs)


__all__ = ["clean_people", "out_of_range", "null_profile", "AGE_RANGE"]
