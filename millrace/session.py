"""Session helpers: a local session for tests, and durable intermediate results."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "millrace") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    Only where neither the session nor the context has one (tests on one machine) is a
    temporary folder of this machine set.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="millrace-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The rows of df written to the shared folder, so that lineage ends here and a lost executor loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Has every executor fetch this package, once per application, so that workers import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.writestr(str(f.relative_to(root.parent)), f.read_bytes())
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{root.name}.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(buffer.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    _shipped.add(sc.applicationId)
