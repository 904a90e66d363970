"""S4: warehouse table scans with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a parquet table; with a schema, no inference and a fixed column order."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if schema is not None:
        df = df.select(*schema.fieldNames())
    return df


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver-provided parquet tables (region ... conversations)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
