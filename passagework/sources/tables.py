"""Plain tables as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table, read where it lies; a plan that needs its rows spread says so itself."""
    return spark.read.parquet(path)
