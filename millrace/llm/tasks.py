"""The task plan, cleaned: one row per task, categories in one spelling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import strip


def category(x: str):
    """One spelling of a category: stripped, lower case, blanks and hyphens inside as underscores; blank to null."""
    t = F.regexp_replace(F.lower(strip(x)), r"[\s\-]+", "_")
    return F.when(t != "", t)


def latest(df: DataFrame, key: str, at: str, *then) -> DataFrame:
    """One row per non-null key: that of the latest `at` (null first), ties by the given expressions, descending."""
    w = Window.partitionBy(key).orderBy(F.col(at).desc_nulls_last(), *[x.desc_nulls_last() for x in then])
    return df.filter(F.col(key).isNotNull()).withColumn("_latest", F.row_number().over(w)).filter("_latest = 1").drop("_latest")
