"""Streaming upsert of landed rows into the day-partitioned raw table (I8).

Each micro-batch is upserted by key: its touched days are written to a new
folder that one commit record makes visible. Replaying a batch after a failure
applies the same rows again, which changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshore.plans.storage import upsert_partitions


def stream_upsert(spark: SparkSession, src: str, table_path: str, checkpoint: str,
                  source_schema: T.StructType, table_schema: T.StructType, keys: Sequence[str],
                  partition_col: str, partition_expr: Column, fmt: str = "json",
                  defaults: dict | None = None, max_files_per_trigger: int | None = None,
                  **upsert_args) -> int:
    """Run ``availableNow`` over the landed files in ``src``; returns batches."""
    defaults = defaults or {}

    def apply(batch: DataFrame, batch_id: int) -> None:
        for c, v in defaults.items():
            if c in batch.columns:
                batch = batch.withColumn(c, F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)))
        upsert_partitions(spark, table_path, table_schema, batch, keys, partition_col,
                          partition_expr, **upsert_args)

    reader = spark.readStream.schema(source_schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(src)
    q = (stream.writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return len(q.recentProgress)


def stream_payload_upsert(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                          dim_path: str, run_ts, events_path: str | None = None, run_id_base: int = 0,
                          multiline: bool = False, min_rows: int = 1, not_null=("temperature_2m",),
                          window: tuple | None = None,
                          max_files_per_trigger: int | None = None) -> int:
    """The incremental loader as a stream over landed payload documents.

    Each micro-batch resolves its locations (new coordinates get ids in the
    dimension at ``dim_path``, the last fetched name stays), keeps the last
    fetch of each hour (inside ``window``, a pair of dates, if given), guards
    each location (rows, no NULL among ``not_null``) and
    upserts the passing ones by (location_id, ts) with run id ``run_id_base +
    batch_id + 1``. With ``events_path`` it appends the run's opening and
    closing events: SUCCESS with the rows, or FAILED with the locations and
    files that did not pass. Replaying a batch rewrites the same rows with
    the same run id."""
    from lakeshore.fixed import DEFAULT_WEATHER_SOURCE, HOURLY_VARS
    from lakeshore.functions.scalar import date_lit, ntz, ts_date
    from lakeshore.operators.audit import close_runs, open_runs
    from lakeshore.operators.quality import load_guard
    from lakeshore.plans.flow import PIPELINE, resolve_payload_locations
    from lakeshore.plans.joins import lookup_join
    from lakeshore.schemas import PAYLOAD, RAW_WEATHER_STORED
    from lakeshore.sources.payloads import explode_with_ids, last_fetch

    def log(events: DataFrame) -> None:
        if events_path:
            events.write.mode("append").parquet(events_path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        run_id = F.lit(run_id_base + batch_id + 1).cast("bigint")
        run = spark.range(1).select(run_id.alias("run_id"), F.lit(PIPELINE).alias("pipeline_name"),
                                    F.lit(DEFAULT_WEATHER_SOURCE).alias("source_name"))
        log(open_runs(run, run_ts))
        batch = batch.checkpoint(eager=True)
        dim = resolve_payload_locations(spark, batch, dim_path, f"batch {batch_id}")
        rows = last_fetch(explode_with_ids(batch, dim)).select("location_id", "ts", *HOURLY_VARS,
                                                               run_id.alias("run_id"))
        if window:
            rows = rows.where(ts_date("ts").between(date_lit(window[0]), date_lit(window[1])))
        rows = rows.checkpoint(eager=True)
        spoiled = batch.where("bad").select("payload_file")
        guard = load_guard(rows, ["location_id"], min_rows=min_rows, not_null=not_null).checkpoint(eager=True)
        good = lookup_join(rows, guard.where("passed").select("location_id"), "location_id", "inner")
        upsert_partitions(spark, table_path, RAW_WEATHER_STORED, good, ["location_id", "ts"], "date",
                          ts_date("ts"), update_cols=[*HOURLY_VARS, "run_id"],
                          insert_defaults={"source": DEFAULT_WEATHER_SOURCE, "ingested_at": ntz(run_ts)},
                          touch={"ingested_at": ntz(run_ts)})
        counts = guard.agg(
            F.coalesce(F.sum(F.when(F.col("passed"), F.col("row_count"))), F.lit(0)).alias("row_count"),
            F.count_if(~F.col("passed")).alias("_failed")).withColumn("_bad", F.lit(spoiled.count()))
        wrong = (F.col("_failed") > 0) | (F.col("_bad") > 0)
        log(close_runs(counts.select(
            run_id.alias("run_id"), F.when(wrong, "FAILED").otherwise("SUCCESS").alias("status"), "row_count",
            F.when(wrong, F.format_string("QC failed: %d locations, %d bad payloads", "_failed", "_bad"))
            .alias("error_message")), run_ts))

    reader = spark.readStream.schema(PAYLOAD).option("multiLine", multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    from lakeshore.sources.payloads import with_source
    q = (with_source(reader.json(landing)).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return len(q.recentProgress)


__all__ = ["stream_upsert", "stream_payload_upsert"]
