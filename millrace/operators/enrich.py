"""Metadata joined to records by the first of several ids that fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import tier_of
from millrace.functions.text import blank_to_null


def first_present(df: DataFrame, names: list[str]) -> str | None:
    """The first of names that df has as a column."""
    return next((n for n in names if n in df.columns), None)


def candidate_ids() -> Column:
    """A record's ids in order of preference, each once: source_id, seed_id, global_id, record_id and its part after the first ::."""
    tail = F.when(F.contains("record_id", F.lit("::")), F.expr("substr(record_id, instr(record_id, '::') + 2)"))
    ids = [blank_to_null(c) for c in ("source_id", "seed_id", "global_id", "record_id")]
    return F.array_distinct(F.array_compact(F.array(*ids, blank_to_null(tail))))


def join_first_id(records: DataFrame, lookup: DataFrame, key: str, row: str = "record_id") -> DataFrame:
    """Every record with the lookup row of its first id that the lookup knows, as struct `found` (null if none) and `found_at`, that id's place.

    lookup must have each key once. Only ids are shuffled to the lookup; a null row id is matched to nothing.
    """
    ids = records.select(F.col(row).alias("_row"), F.posexplode(candidate_ids()).alias("_at", "_id")).filter("_row is not null").distinct()
    hits = ids.join(lookup.select(F.col(key).alias("_id"), F.struct(*[c for c in lookup.columns if c != key]).alias("_found")), "_id")
    first = hits.groupBy("_row").agg(F.min(F.struct("_at", "_found")).alias("_m"))
    x = records.join(first, records[row] == first["_row"], "left")
    return x.select(*[records[c] for c in records.columns], F.col("_m._found").alias("found"), F.col("_m._at").alias("found_at"))


def fill_only(df: DataFrame, columns: list[str], watch: str) -> DataFrame:
    """Missing values taken from `found`, existing ones kept; `conflict` where both sides have different values of watch."""
    own = F.col(watch)
    conflict = own.isNotNull() & F.col(f"found.{watch}").isNotNull() & (own != F.col(f"found.{watch}"))
    kept = {c: F.coalesce(F.col(c), F.col(f"found.{c}")) for c in columns}
    return df.select(*[kept.get(c, F.col(c)).alias(c) for c in df.columns if c not in ("found", "found_at")], F.col("found").isNotNull().alias("matched"), F.coalesce(conflict, F.lit(False)).alias("conflict"))


def report(enriched: DataFrame, row: str = "record_id", debug: int = 25) -> tuple[DataFrame, DataFrame]:
    """(one row with matched, unmatched and conflicts; the first `debug` rows in conflict by id)."""
    n = enriched.agg(F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("unmatched"), F.count_if("conflict").alias("conflicts"))
    return n, enriched.filter("conflict").orderBy(row).limit(debug)


def with_class_tier(examples: DataFrame, classes: DataFrame) -> DataFrame:
    """examples with `tier` of their class: the given one in upper case, else computed from p10; unknown classes give null.

    classes: class_id (each once), tier, p10. Spark broadcasts them while they are small.
    """
    side = classes.select("class_id", F.coalesce(F.upper(blank_to_null("tier")), tier_of("p10")).alias("_tier"))
    x = examples.join(side, "class_id", "left")
    own = F.coalesce(F.upper(blank_to_null("tier")), F.col("_tier")) if "tier" in examples.columns else F.col("_tier")
    return x.withColumn("tier", own).drop("_tier")
