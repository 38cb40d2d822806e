"""Named parquet tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table as stored: a parquet file or folder called ``<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
