"""Session settings and the folder that every executor can reach."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", app: str = "tempera") -> SparkSession:
    """Small session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder, because there the
    driver and the executors are one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tempera-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{_own_folder(spark, root)}/{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession, root: str) -> str:
    return f"{root.rstrip('/')}/tempera/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete every table that this application wrote to the shared folder. Results read from them are gone too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark, root))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, *partitions: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and
    every later pass sees the same rows with column pruning. ``partitions`` name columns that
    get folders of their own.
    """
    path = shared_folder(df.sparkSession)
    df.write.partitionBy(*partitions).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table.select(df.columns) if partitions else table


def measured(df: DataFrame) -> tuple[DataFrame, int, int]:
    """``materialise``, with the number of rows and the bytes of their text form, taken while they are written."""
    seen = Observation()
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint"))
    table = materialise(df.observe(seen, F.count(F.lit(1)).alias("rows"), size.alias("bytes")))
    return table, seen.get["rows"], seen.get["bytes"] or 0
