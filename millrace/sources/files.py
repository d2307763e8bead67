"""JSON lines, JSON documents, source files and the sinks for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import model_key


def read_jsonl(spark: SparkSession, path: str, schema: str, tolerant: bool = False) -> DataFrame:
    """Rows of JSON lines; blank lines are skipped. A corrupt line is an error, or with tolerant a row left out.

    With tolerant, corrupt_lines() of the same file counts what was left out.
    """
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path).filter("_corrupt is null").drop("_corrupt")


def read_words(spark: SparkSession, path: str, most: int = 100_000) -> list[str]:
    """A list of words, one a line, in lower case, each once in its order: allow-lists and reserved words that a session brings. More than `most` are an error."""
    got = spark.read.text(path).select(F.trim(F.lower("value")).alias("w")).filter("w <> ''").limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} words")
    return list(dict.fromkeys(r["w"] for r in got))


def corrupt_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, text) of the non-blank lines that are no JSON object."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.filter(F.try_parse_json("value").isNull()).select(F.col("value").alias("text"))


def read_document(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """(key, value) of one JSON object whose values have a common schema."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{value_schema}>")).alias("key", "value"))


def read_sources(spark: SparkSession, folder: str, pattern: str = "*.nlogo") -> DataFrame:
    """(model_name, path, text) of all files below a folder, named by their stem; of files of one name the last by path counts."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
    x = raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    stem = F.regexp_extract(F.url_decode("path"), r"([^/]+?)(?:\.[^./]*)?$", 1)
    last = Window.partitionBy("model_name").orderBy(F.desc("path"))
    return x.withColumn("model_name", model_key(stem)).withColumn("_r", F.row_number().over(last)).filter("_r = 1").select("model_name", "path", "text")


def write_jsonl(df: DataFrame, path: str, append: bool = False, fresh: bool = False) -> None:
    """JSON lines, explicit nulls kept; a folder of part files. fresh: what is there already is an error and stays as it is."""
    df.write.mode("append" if append else "errorifexists" if fresh else "overwrite").option("ignoreNullFields", "false").json(path)


def write_document(df: DataFrame, path: str, key: str, most: int = 100_000) -> None:
    """One JSON object on one line: key to the row's other columns, of rows of one key the least. Rows of a null key are left out.

    More than `most` keys are refused, since a document is one row.
    """
    rest = F.struct(*[c for c in df.columns if c != key])
    rows = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("k")).agg(F.min(rest).alias("v"))
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows are no document")
    entries = F.array_sort(F.collect_list(F.struct("k", "v")))
    rows.groupBy().agg(F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """A text file of one column, for services that take request files."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_by(df: DataFrame, path: str, column: str) -> None:
    """One folder per value of a column, JSON lines inside."""
    df.withColumn("_part", safe_name(F.coalesce(F.col(column).cast("string"), F.lit("unknown")))).write.mode("overwrite").partitionBy("_part").option("ignoreNullFields", "false").json(path)


def safe_name(x):
    """A file name: all but letters, digits, dot, hyphen and underscore become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(x, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits a pattern, by the file system that holds it; its failures are raised."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def tranche_folder(base: str, number: int) -> str:
    return f"{base}/tranche_{number:03d}"


def all_tranches(spark: SparkSession, base: str, kind: str, schema: str) -> DataFrame:
    """Rows of one kind of log over all tranches, with the tranche's number."""
    x = spark.read.schema(schema).json(f"{base}/tranche_*/{kind}")
    return x.withColumn("tranche", F.regexp_extract(F.col("_metadata.file_path"), r"tranche_(\d+)", 1).cast("int"))


def with_position(df: DataFrame, *order) -> DataFrame:
    """df with `pos`, the place of each row in a total order, without gathering all rows in one task.

    Rows are range-partitioned, counted per partition, and numbered from each partition's start.
    """
    from millrace.session import durable

    part = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    part = durable(part)
    starts, at = {}, 0
    for r in part.groupBy("_p").agg(F.max("_i").alias("m")).orderBy("_p").collect():  # one row per partition
        starts[r["_p"]] = at
        at += r["m"] + 1
    table = F.create_map(*[F.lit(v) for kv in starts.items() for v in kv]) if starts else F.create_map().cast("map<int,int>")
    return part.withColumn("pos", (table[F.col("_p")] + F.col("_i")).cast("long")).drop("_p", "_i")


