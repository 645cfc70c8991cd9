"""Playlist messages and the anonymous interaction log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACK = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("youtube_url", T.StringType()),
    ]
)

PLAYLIST_MESSAGE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("mood", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("language_name", T.StringType()),
        T.StructField("genre", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("playlist", T.ArrayType(TRACK)),
        T.StructField("ml_recommendations", T.ArrayType(T.StringType())),
    ]
)


def playlist_payload() -> Column:
    """Message text; NULL fields are written out, and the genre is the requested one."""
    tracks = F.transform(
        "playlist",
        lambda t: F.struct(
            t["title"].alias("title"), t["artist"].alias("artist"), t["youtube_url"].alias("youtube_url")
        ),
    )
    message = F.struct(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("action").alias("source"),
        "mood",
        "language",
        "language_name",
        "genre",
        "confidence",
        tracks.alias("playlist"),
        F.col("recommended").alias("ml_recommendations"),
    )
    return F.to_json(message, {"ignoreNullFields": "false"})


def parse_playlists(messages: DataFrame, value: str = "value") -> DataFrame:
    """Playlist rows from message bytes or text; other columns are kept."""
    rest = [c for c in messages.columns if c != value]
    parsed = F.from_json(F.col(value).cast("string"), PLAYLIST_MESSAGE)
    return messages.select(*rest, parsed.alias("_m")).select(*rest, "_m.*")


def received_playlists(messages: DataFrame, language_name: Column, genre: Column) -> DataFrame:
    """Playlist rows with the reader's defaults for whatever the message lacks."""
    return (
        messages.withColumn("playlist", F.coalesce("playlist", F.array()))
        .withColumn("mood", F.coalesce("mood", F.lit("unknown")))
        .withColumn("language_name", F.coalesce("language_name", language_name))
        .withColumn("genre", F.coalesce("genre", genre))
    )


def interactions(served: DataFrame) -> DataFrame:
    """Log rows of served requests. The user is left out on purpose."""
    return served.select(
        "mood", F.col("primary_genre").alias("genre"), F.col("confidence").cast("double"), "language", "action_time"
    )
