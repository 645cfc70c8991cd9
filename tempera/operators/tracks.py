"""Tracks as shown to the user, and as read from a search response."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempera.functions.defaults import or_default, present
from tempera.functions.tracks import embed_link, search_link, video_id, watch_link

_TEXT = T.StringType()

SEARCH_RESPONSE = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StructType([T.StructField("videoId", _TEXT)])),
                        T.StructField(
                            "snippet",
                            T.StructType([T.StructField("title", _TEXT), T.StructField("channelTitle", _TEXT)]),
                        ),
                    ]
                )
            ),
        )
    ]
)


def parse_search_response(responses: DataFrame, value: str = "value") -> DataFrame:
    """One row per usable track of a search response; items without a video id are dropped."""
    rest = [c for c in responses.columns if c != value]
    items = F.from_json(value, SEARCH_RESPONSE)["items"]
    return (
        responses.select(*rest, F.explode(items).alias("_item"))
        .filter(present(F.col("_item.id.videoId")))
        .select(
            *rest,
            F.coalesce("_item.snippet.title", F.lit("Unknown Title")).alias("title"),
            F.coalesce("_item.snippet.channelTitle", F.lit("Unknown Artist")).alias("artist"),
            watch_link(F.col("_item.id.videoId")).alias("youtube_url"),
        )
    )


def normalise_tracks(playlists: DataFrame, playlist: str = "playlist") -> DataFrame:
    """One row per track with position, title, artist and a link, whichever names the fields have.

    ``playlist`` holds structs with title, name, artist, artists, youtube_url and youtube.
    """
    rest = [c for c in playlists.columns if c != playlist]
    rows = playlists.select(*rest, F.posexplode(playlist).alias("_at", "_t"))
    return (
        rows.withColumn("position", F.col("_at") + 1)
        .withColumn("title", or_default(F.col("_t.title"), F.col("_t.name"), "Unknown Track"))
        .withColumn("artist", or_default(F.col("_t.artist"), F.col("_t.artists"), "Unknown Artist"))
        .withColumn("_link", or_default(F.col("_t.youtube_url"), F.col("_t.youtube")))
        .withColumn("link", or_default(F.col("_link"), search_link(F.concat_ws(" ", "title", "artist"))))
        .drop("_at", "_t", "_link")
    )


def now_playing(playlists: DataFrame, playlist: str = "playlist") -> DataFrame:
    """The first track of each playlist with the link to play; no search link stands in."""
    rest = [c for c in playlists.columns if c != playlist]
    first = playlists.filter(F.size(playlist) > 0).withColumn("_t", F.element_at(playlist, 1))
    link = or_default(F.col("_t.youtube_url"), F.col("_t.youtube"))
    return first.withColumn("_link", F.nullif(link, F.lit(""))).select(
        *rest,
        or_default(F.col("_t.title"), F.col("_t.name"), "Unknown").alias("title"),
        or_default(F.col("_t.artist"), F.col("_t.artists"), "").alias("artist"),
        F.coalesce(embed_link(video_id(F.col("_link"))), F.col("_link")).alias("play_link"),
    )
