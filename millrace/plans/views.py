"""The project's tables, cleaned, as the queries use them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import blank_to_null, model_key
from millrace.operators import srcparse
from millrace.operators.normalize import normalize
from millrace.operators.profiles import derive_profiles
from millrace.sources.tables import table


def desc(*names: str) -> list:
    return [F.col(n).desc_nulls_last() for n in names]


def first_row(df: DataFrame, key: str, order: list) -> DataFrame:
    """One row per non-null key, the first by order. The rank filter cuts every group before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.filter(F.col(key).isNotNull()).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def normal(spark: SparkSession, d: str) -> DataFrame:
    return normalize(table(spark, d, "records"))


def records(spark: SparkSession, d: str) -> DataFrame:
    """One row per record_id, the last ingested."""
    cols = ("ingested_at", "source", "source_id", "model_name", "question", "answer", "seed_id", "class_id", "level", "tier", "global_id")
    return first_row(normal(spark, d), "record_id", desc(*cols))


def seeds(spark: SparkSession, d: str) -> DataFrame:
    """One row per seed_id; seed_q and seed_a where they are, else question and answer."""
    r = table(spark, d, "routed_seeds").withColumn("seed_id", blank_to_null("seed_id"))
    r = first_row(r, "seed_id", desc("route_mode", "extension_family", "model_name", "class_id", "level", "tier", "question", "answer"))
    return r.select(
        "seed_id", model_key("model_name").alias("model_name"), "class_id", blank_to_null("level").alias("level"), F.upper(blank_to_null("tier")).alias("tier"), "route_mode", blank_to_null("extension_family").alias("extension_family"),
        F.coalesce(blank_to_null("seed_q"), blank_to_null("question")).alias("question"), F.coalesce(blank_to_null("seed_a"), blank_to_null("answer")).alias("answer"),
    )


def tasks(spark: SparkSession, d: str) -> DataFrame:
    """One row per task_key, the last planned; a NaN priority counts as none."""
    t = table(spark, d, "planned_tasks")
    number = F.when(~F.isnan("priority"), F.col("priority"))
    return first_row(t, "task_key", [F.col("planned_at").desc_nulls_last(), number.desc_nulls_last(), *desc("seed_id", "route_mode", "provider_hint", "tier", "model_name", "level", "transform_type", "extension_family", "support_record_id")])


def profiles(spark: SparkSession, d: str) -> DataFrame:
    return derive_profiles(records(spark, d))


def source_hints(spark: SparkSession, d: str) -> DataFrame:
    """(model_name, term, kind): what the parse of a model's documents leaves unresolved, and the literals and widgets it tells of."""
    t = table(spark, d, "documents").select(model_key("model_name").alias("model_name"), "text").filter("model_name is not null and text is not null")
    return srcparse.source_terms(t, "model_name", "text").distinct()
