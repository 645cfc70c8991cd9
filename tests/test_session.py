"""Scratch tables and texts."""

import os

from pyspark.sql import functions as F

from tempera.functions.labels import detection_text, mood_label
from tempera.session import materialise, measured, shared_folder


def test_measured_counts_what_it_writes(spark):
    table, rows, size = measured(spark.range(3).select(F.lit("abc").alias("t")))
    assert (rows, size) == (3, 3 * len('{"t":"abc"}')) and table.count() == 3
    assert measured(spark.range(0))[1:] == (0, 0)


def test_materialised_by_partition(spark):
    table = materialise(spark.range(10).selectExpr("id % 3 as part", "id"), "part")
    assert table.columns == ["part", "id"] and table.filter("part = 1").count() == 3


def test_scratch_is_in_the_named_folder(spark):
    materialise(spark.range(1))
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(f"{root}/tempera/{spark.sparkContext.applicationId}/")
    assert os.path.isdir(f"{root}/tempera/{spark.sparkContext.applicationId}")


def test_labels(spark):
    rows = spark.createDataFrame([("happy", 2.5), ("odd", 3.5), (None, 1.0)], "m string, c double")
    out = rows.select(mood_label(F.col("m")).alias("l"), detection_text(F.col("m"), F.col("c")).alias("t")).collect()
    assert [r.l for r in out][:1] == ["😊 HAPPY"] and out[2].l is None and out[1].l.endswith(" ODD")
    assert [r.t for r in out] == ["Detected: happy (2% confidence)", "Detected: odd (4% confidence)", None]
