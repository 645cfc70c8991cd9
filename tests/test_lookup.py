"""The lookup join gives the same rows whether it broadcasts or shuffles with salts."""

import pytest
from pyspark.sql import functions as F

from tempera.operators.lookup import Lookup


def tables(spark):
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 40).cast("string")).alias("k"),
        (F.col("id") % 2).alias("j"),
    )
    names = [("hot", 0, "h0"), ("hot", 1, "h1")] + [(str(i), i % 2, f"n{i}") for i in range(30)]
    left = left.withColumn("m", F.create_map(F.lit("id"), "id"))
    return left, spark.createDataFrame(names, "k string, j bigint, name string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_salted_equals_broadcast(spark, how):
    left, right = tables(spark)
    keys = {"k": "k", "j": "j"}
    taken = {} if how == "left_semi" else {"name": "found"}
    small, large = Lookup(right), Lookup(right, max_rows=3, rows_per_task=100)
    assert small.small and not large.small
    a = small.join(left, keys, taken, how)
    b = large.join(left, keys, taken, how)
    assert a.columns == b.columns == left.columns + list(taken.values())
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    if how == "left":
        assert a.count() == 3000


def test_hot_key_is_spread(spark):
    left, right = tables(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = Lookup(right, max_rows=3, rows_per_task=60).join(left, {"k": "k", "j": "j"}, {"name": "found"})
        parts = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) > 4 and max(r["count"] for r in parts) < 500


def test_size_check_counts_bytes_too(spark):
    wide = spark.range(10).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("t"))
    assert Lookup(wide).small and not Lookup(wide, max_bytes=5000).small and not Lookup(wide, max_rows=9).small
    assert Lookup(wide.limit(0)).small
