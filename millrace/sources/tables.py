"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; only the columns and row groups that a plan needs are read from it."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
