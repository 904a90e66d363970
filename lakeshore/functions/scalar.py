"""Scalar column helpers (F1-F16). All are built-in Spark expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeshore.schemas import COORD


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """NULLIF(TRIM(x), '') - TRIM removes spaces only, as in SQL."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def default_if_blank(c, default: str) -> Column:
    """COALESCE(NULLIF(TRIM(x), ''), default)."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def null_outside(c, lo, hi) -> Column:
    """CASE WHEN x < lo OR x > hi THEN NULL ELSE x END (NULL stays NULL)."""
    c = col(c)
    return F.when((c >= lo) & (c <= hi), c)


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal that does not depend on the session zone."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.lit(str(value)).cast("date")


def hour_floor(c) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour without passing through a zone."""
    c = col(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))


def ts_date(c) -> Column:
    """ts::date"""
    return F.to_date(col(c))


def date_key(c) -> Column:
    """to_char(date, 'YYYYMMDD')::INT - smart date key."""
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def plus_hours(c, hours: int) -> Column:
    return col(c) + F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0))


def plus_days(c, days: int) -> Column:
    return F.date_add(col(c), days)


def iso_minute_text(c) -> Column:
    """Payload time text, e.g. 2026-02-23T00:00."""
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm")


def iso_text(c) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss")


def parse_payload_time(c) -> Column:
    """'YYYY-MM-DDTHH:MM' text -> TIMESTAMP_NTZ (ANSI: bad text raises)."""
    return col(c).cast("timestamp_ntz")


def to_coord(c) -> Column:
    """float -> NUMERIC(9,6); done before coordinates are used as keys."""
    return col(c).cast(COORD)


def location_label(lat, lon) -> Column:
    """Default location label "{lat:.4f},{lon:.4f}"."""
    return F.format_string("%.4f,%.4f", col(lat).cast("double"), col(lon).cast("double"))


def path_slug(c) -> Column:
    """City label -> path slug: runs of anything but letters and digits (of
    any script) become one '_'."""
    return F.regexp_replace(F.trim(col(c)), r"[^\p{L}\p{N}]+", "_")


def any_null(*cols) -> Column:
    out = None
    for c in cols:
        term = col(c).isNull()
        out = term if out is None else (out | term)
    return out


def params_json(**fields) -> Column:
    """object -> JSON text (to_json over a struct of named columns)."""
    return F.to_json(F.struct(*[col(v).alias(k) for k, v in fields.items()]))


__all__ = [
    "col", "blank_to_null", "default_if_blank", "null_outside", "ntz", "date_lit",
    "hour_floor", "ts_date", "date_key", "plus_hours", "plus_days", "iso_minute_text",
    "iso_text", "parse_payload_time", "to_coord", "location_label", "path_slug", "any_null",
    "params_json",
]
