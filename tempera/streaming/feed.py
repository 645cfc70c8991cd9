"""Feed a table through a stream in time order, and run a stream to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tempera.functions.clock import micros
from tempera.session import materialise, shared_folder

ROWS_PER_SLICE = 50_000_000
ROWS_PER_KEY = 10_000_000
ROWS_PER_FILE = 100_000  # a file is at least one task of every step before a shuffle
ROWS_PER_RANGE = 1_000_000
LEAST_SLICES = 4


def stage_slices(
    df: DataFrame,
    ts: str = "ts",
    key: str | None = None,
    slices: int = LEAST_SLICES,
    rows: int = ROWS_PER_SLICE,
    key_rows: int = ROWS_PER_KEY,
    rows_per_file: int = ROWS_PER_FILE,
    edges: list[str] | None = None,
) -> tuple[str, int]:
    """Write ``df`` as files in time order, one slice of time after the other.

    Returns the folder and the number of files of a slice. A stream reads files by age, so it sees the
    slices in order. With ``edges`` (ascending times) a slice ends before each of them; else a range shuffle
    cuts the table into as many slices as keep each at about ``rows``, and those of its largest key at about
    ``key_rows``, and at least ``slices``. Rows of one
    time stay together, and rows without a time are in the first slice. Every slice has the same number of files,
    some of them empty if need be: the order of its files does not matter.
    """
    if key:
        sizes = df.groupBy(key).count().agg(F.sum("count"), F.max("count")).first()
    else:
        sizes = df.agg(F.count(F.lit(1)), F.lit(0)).first()
    total, largest = sizes[0] or 0, sizes[1] or 0
    if edges is None:
        count = max(slices, -(-total // rows), -(-largest // key_rows))
        # A slice is several ranges, so that several tasks write it.
        ranges = max(1, -(-total // (count * ROWS_PER_RANGE)))
        cut = df.withColumn("_at", micros(ts)).repartitionByRange(count * ranges, "_at").drop("_at")
        cut = cut.withColumn("_slice", F.floor(F.spark_partition_id() / ranges).cast("int"))
    else:
        count = len(edges) + 1
        cut = df.withColumn("_slice", _edges_passed(F.col(ts), edges))
    files = max(1, -(-total // (count * rows_per_file)))
    # One folder per slice: writing a slice reads no other.
    timed = materialise(cut, "_slice")
    spark, folder, written = df.sparkSession, shared_folder(df.sparkSession), 0
    for k in range(count):
        piece = timed.filter(F.col("_slice") == k).drop("_slice")
        piece.repartition(files).write.mode("append").parquet(folder)
        # A partition without rows may have written no file; a reader that takes files by number must find them all.
        written += files
        while (files > 1 or edges) and (missing := written - len(spark.read.schema(df.schema).parquet(folder).inputFiles())) > 0:
            _add_empty_files(spark, folder, df.schema, missing)
    return folder, files


def _add_empty_files(spark: SparkSession, folder: str, schema: T.StructType, n: int) -> None:
    """Copies of one file without rows: a job for each would take longer than the rows do."""
    source = shared_folder(spark)
    spark.createDataFrame([], schema).coalesce(1).write.parquet(source)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    system = hadoop.Path(source).getFileSystem(conf)
    empty = next(f.getPath() for f in system.listStatus(hadoop.Path(source)) if f.getPath().getName().startswith("part-"))
    for _ in range(n):
        hadoop.FileUtil.copy(system, empty, system, hadoop.Path(f"{folder}/part-{uuid.uuid4().hex}.parquet"), False, conf)


def _edges_passed(at: Column, edges: list[str]) -> Column:
    passed = F.lit(0)
    for edge in edges:
        passed = passed + F.coalesce(at >= F.lit(edge).cast("timestamp_ntz"), F.lit(False)).cast("int")
    return passed


def finish(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for a bounded stream. With ``seconds`` it is stopped and fails if it does not end in time."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream still active after {seconds} s")
