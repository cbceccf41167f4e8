"""Reading the tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a directory of Parquet files or folders."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
