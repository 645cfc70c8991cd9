"""Times without a zone do not depend on the session's zone, not even where its clock jumps."""

import pytest

from tempera.functions.clock import elapsed_seconds, epoch_seconds, from_epoch_seconds, micros


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_zone_does_not_matter(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-07-01 12:00:00.123457", "2024-03-10 02:30:00", "1969-12-31 23:59:59.5"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "cast(t as timestamp_ntz) ts")
        df = df.withColumn("s", epoch_seconds("ts"))
        out = df.select(
            "t",
            micros("ts").alias("m"),
            from_epoch_seconds("s").cast("string").alias("b"),
            elapsed_seconds("ts", "timestamp_ntz'2024-07-02 00:00:00'").alias("e"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r.t: (r.m, r.b, r.e) for r in out} == {
        texts[0]: (1719835200123457, texts[0], 43199),
        texts[1]: (1710037800000000, texts[1], 9840600),
        texts[2]: (-500000, texts[2], 1719878400),
    }
