"""Reading input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """The table as its files are laid out: no exchange is put in front of it."""
    return spark.read.parquet(path)
