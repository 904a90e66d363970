"""Views and SQL over the warehouse tables (K7, S9).

``register_views`` publishes DataFrames as temporary views so the marts can
also be written as plain Spark SQL; Catalyst plans the SQL and the DataFrame
forms identically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeshore.operators.model import stg_hourly
from lakeshore.schemas import RAW_WEATHER_HOURLY

# The daily average over the registered views of the fact and the dimension.
DAILY_AVG_SQL = """
WITH per_day AS (
  SELECT location_id, DATE(ts) AS date, SUM(temperature_2m) AS total, COUNT(temperature_2m) AS n
  FROM fact_weather_hourly GROUP BY location_id, DATE(ts))
SELECT location_name, date, CAST(SUM(total) AS DOUBLE) / SUM(n) AS average_temperature_city
FROM per_day LEFT JOIN dim_location USING (location_id)
GROUP BY location_name, date
"""


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_staged_view(raw: DataFrame, dim_location: DataFrame, name: str = "stg_weather_hourly") -> None:
    """The staged hourly view: its columns in the declared order, with the
    location's label."""
    staged = stg_hourly(raw, dim_location)
    staged.select(*RAW_WEATHER_HOURLY.fieldNames(), "location_name").createOrReplaceTempView(name)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """EXPLAIN counterpart: the plan as text (formatted, cost, codegen...)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def explain_analyze(df: DataFrame, name: str = "analyze") -> dict:
    """EXPLAIN ANALYZE counterpart: run the query in full (no-op sink, no
    collect) with an ``Observation`` counting its output rows, and return the
    executed plan, the row count and the elapsed seconds."""
    import time

    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    t0 = time.perf_counter()
    observed.write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    return {"rows": obs.get["rows"], "seconds": round(elapsed, 3),
            "plan": plan_text(observed, "formatted")}


__all__ = ["DAILY_AVG_SQL", "register_views", "register_staged_view", "plan_text", "explain_analyze"]
