"""Staged slices: enough files to keep a cluster busy, the same number for slices without rows."""

from pyspark.sql import functions as F

from tempera.streaming import feed
from tempera.streaming.feed import stage_slices


def timed(spark, n):
    return spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_micros("id").cast("timestamp_ntz").alias("ts"))


def test_a_slice_of_many_rows_is_many_files(spark):
    """A file is one task of every step before a shuffle: half a million rows were four of them."""
    table = timed(spark, 500_000)
    folder, files = stage_slices(table)
    staged = spark.read.schema(table.schema).parquet(folder)
    assert files == 2 and len(staged.inputFiles()) == 8 and staged.count() == 500_000
    sizes = [r["count"] for r in staged.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 100_000


def test_empty_slices_start_no_job_per_file(spark, monkeypatch):
    table = timed(spark, 60).cache()
    first, last = "1960-01-01 00:00:00", "2100-01-01 00:00:00"
    jobs, frame = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: jobs.append(1) or frame(*a, **k))
    folder, files = stage_slices(table, edges=[first, last], rows_per_file=1)
    staged = spark.read.schema(table.schema).parquet(folder)
    assert files == 20 and len(staged.inputFiles()) == 60 and len(jobs) <= 3
    assert sorted(r.event_id for r in staged.collect()) == list(range(60))


def test_a_slice_is_written_in_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(feed, "ROWS_PER_RANGE", 10)
    table = timed(spark, 400)
    folder, files = stage_slices(table, rows_per_file=1000)
    assert files == 1
    pieces = [r for r in spark.read.schema(table.schema).parquet(folder).groupBy(F.input_file_name().alias("f")).agg(
        F.min("event_id").alias("low"), F.max("event_id").alias("high"), F.count("*").alias("n")).collect()]
    pieces.sort(key=lambda r: r.low)
    assert len(pieces) == 4 and sum(r.n for r in pieces) == 400
    assert all(a.high < b.low for a, b in zip(pieces, pieces[1:], strict=False))
