"""Action messages: JSON to rows, defaults, and rows back to JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempera import dims
from tempera.functions.clock import epoch_seconds, from_epoch_seconds
from tempera.functions.defaults import or_default, present


def action_schema(integer_confidence: bool = False) -> T.StructType:
    """Message schema. With ``integer_confidence`` a fractional reading parses to NULL."""
    data = T.StructType(
        [
            T.StructField("song", T.StringType()),
            T.StructField("mood", T.StringType()),
            T.StructField("confidence", T.IntegerType() if integer_confidence else T.DoubleType()),
            T.StructField("timestamp", T.DoubleType()),
            T.StructField("language", T.StringType()),
            T.StructField("language_name", T.StringType()),
            T.StructField("genre", T.StringType()),
            T.StructField("manual", T.BooleanType()),
        ]
    )
    return T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("action", T.StringType()),
            T.StructField("data", data),
        ]
    )


def parse_actions(messages: DataFrame, value: str = "value", integer_confidence: bool = False) -> DataFrame:
    """Flat action rows from message bytes or text; other columns of ``messages`` are kept."""
    rest = [c for c in messages.columns if c != value]
    payload = F.from_json(F.col(value).cast("string"), action_schema(integer_confidence))
    return (
        messages.select(*rest, payload.alias("_payload"))
        .select(*rest, "_payload.user_id", "_payload.action", "_payload.data.*")
        .withColumn("action_time", from_epoch_seconds("timestamp"))
        .drop("timestamp")
    )


def rejection() -> Column:
    """Why a parsed action will not be served; NULL for one that will."""
    return (
        F.when(F.col("user_id").isNull() & F.col("action").isNull(), "unreadable message")
        .when(F.col("action").isNull() | (F.col("action") != dims.MOOD_UPDATE), "not a mood update")
        .when(~present(F.col("mood")), "no mood")
    )


def rejected_actions(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that will not be served, with the reason."""
    parsed = parse_actions(messages.withColumn("_text", F.col(value).cast("string")), value)
    kept = [c for c in messages.columns if c != value]
    return parsed.withColumn("reason", rejection()).filter("reason is not null").select(
        *kept, F.col("_text").alias(value), "reason"
    )


def clean_requests(actions: DataFrame) -> DataFrame:
    """Mood updates with a mood, missing preferences replaced by the defaults."""
    return (
        actions.filter((F.col("action") == dims.MOOD_UPDATE) & present(F.col("mood")))
        .withColumn("language", or_default(F.col("language"), dims.DEFAULT_LANGUAGE))
        .withColumn("language_name", or_default(F.col("language_name"), dims.DEFAULT_LANGUAGE_NAME))
        .withColumn("genre", or_default(F.col("genre"), dims.ANY_GENRE))
        .withColumn("confidence", F.coalesce("confidence", F.lit(0)))
    )


def action_payload(ts: str) -> Column:
    """Action message text from the columns user_id, mood, confidence, language_name, genre, manual."""
    return F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("user_id"),
            F.lit(dims.MOOD_UPDATE).alias("action"),
            F.struct(
                "mood",
                "confidence",
                epoch_seconds(ts).alias("timestamp"),
                dims.lookup(dims.LANGUAGES, F.col("language_name")).alias("language"),
                "language_name",
                "genre",
                "manual",
            ).alias("data"),
        ),
        {"ignoreNullFields": "false"},
    )
