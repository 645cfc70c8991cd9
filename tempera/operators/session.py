"""What a user's session shows: newest playlist, own playlists, counters, resets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempera.functions.clock import elapsed_seconds
from tempera.operators.lookup import Lookup


def own_playlists(playlists: DataFrame, active_users: DataFrame) -> DataFrame:
    """Playlists of the given users only."""
    users = Lookup(active_users.select("user_id").filter("user_id is not null").distinct())
    return users.join(playlists, {"user_id": "user_id"}, {}, how="left_semi")


def latest_playlist(playlists: DataFrame, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The newest row of each user. Partial maxima leave one row per user and task to shuffle.

    A maximum of structs sorts its input; pass narrow rows, without the tracks where possible.
    """
    rest = [c for c in playlists.columns if c != "user_id"]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return playlists.groupBy("user_id").agg(newest).select("user_id", "_newest.*")


def reset_times(resets: DataFrame) -> Lookup:
    """Time of the last reset of each user."""
    return Lookup(resets.filter("user_id is not null").groupBy("user_id").agg(F.max("ts").alias("ts")))


def since_reset(rows: DataFrame, resets: Lookup | None) -> DataFrame:
    """Adds ``fresh``: whether the row is newer than its user's last reset."""
    if resets is None:
        return rows.withColumn("fresh", F.lit(True))
    joined = resets.join(rows, {"user_id": "user_id"}, {"ts": "_reset"})
    return joined.withColumn("fresh", F.col("_reset").isNull() | (F.col("ts") > F.col("_reset"))).drop("_reset")


def session_stats(
    detections: DataFrame,
    sends: DataFrame,
    playlists: DataFrame,
    as_of: Column,
    resets: DataFrame | None = None,
) -> DataFrame:
    """Per user: detections, actions sent, tracks in the newest playlist, age of the newest reading.

    A reset clears the counters and the playlist but not the time of the newest reading.
    The inputs become narrow rows of one kind each and meet in a single hash aggregate,
    which combines before the shuffle.
    """
    cleared = reset_times(resets) if resets is not None else None
    one, none = F.when(F.col("fresh"), 1).otherwise(0), F.lit(0)
    newest = latest_playlist(
        since_reset(playlists.select("user_id", "ts", "event_id", "n_tracks"), cleared).filter("fresh")
    )
    no_time = F.lit(None).cast("timestamp_ntz")
    together = (
        since_reset(detections.select("user_id", "ts"), cleared)
        .select("user_id", one.alias("d"), none.alias("s"), none.alias("t"), F.col("ts").alias("r"))
        .unionByName(
            since_reset(sends.select("user_id", "ts"), cleared).select(
                "user_id", none.alias("d"), one.alias("s"), none.alias("t"), no_time.alias("r")
            )
        )
        .unionByName(
            newest.select("user_id", none.alias("d"), none.alias("s"), F.col("n_tracks").alias("t"), no_time.alias("r"))
        )
    )
    totals = together.groupBy("user_id").agg(
        F.sum("d").alias("detections"),
        F.sum("s").alias("sends"),
        F.max("t").alias("tracks_in_queue"),
        F.max("r").alias("last_reading"),
    )
    return totals.withColumn("_as_of", as_of).select(
        "user_id",
        F.substring(F.col("user_id").cast("string"), 1, 12).alias("user_label"),
        "detections",
        "sends",
        "tracks_in_queue",
        "last_reading",
        elapsed_seconds("last_reading", "_as_of").alias("seconds_since_reading"),
    )
