"""Tracks for a request, from a catalogue ranked once per (language, genre)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tempera import dims
from tempera.functions.tracks import watch_link
from tempera.operators.lookup import Lookup


def ranked_cells(tracks: DataFrame, limit: int = dims.PRIMARY_LIMIT) -> DataFrame:
    """One row per (language, genre) with its ``limit`` most relevant tracks, best first.

    The rank filter becomes a group limit before the shuffle, so a cell with most of the
    catalogue sends at most ``limit`` tracks per input partition.
    """
    best = W.partitionBy("language", "genre").orderBy(F.desc("relevance"), "video_id")
    return (
        tracks.filter("language is not null and genre is not null")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= limit)
        .groupBy("language", "genre")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "video_id", "title", "artist"))).alias("tracks"))
    )


def catalogue(tracks: DataFrame) -> Lookup:
    return Lookup(ranked_cells(tracks))


def catalogue_candidates(requests: DataFrame, cells: Lookup) -> DataFrame:
    """Adds ``candidates``: the tracks of the primary genre in the request's language."""
    found = cells.join(
        requests, {"language": "language", "primary_genre": "genre"}, {"tracks": "candidates"}
    )
    return found.withColumn("candidates", _or_none("candidates"))


def fallback_stages(requests: DataFrame, cells: Lookup, wanted: int = dims.PLAYLIST_LENGTH) -> DataFrame:
    """Adds ``stage_1``, ``stage_2`` and ``stage_3``, the tracks taken from each search.

    The second and third recommended genre are searched only while fewer than ``wanted``
    tracks are found. Everything stays in the request's row: no fan-out, and no shuffle by
    request. A genre searched twice gives its tracks twice.
    """
    out = catalogue_candidates(requests, cells).withColumnRenamed("candidates", "stage_1")
    out = out.withColumn("_alt_2", F.get("recommended", F.lit(1))).withColumn(
        "_alt_3", F.get("recommended", F.lit(2))
    )
    found = F.size("stage_1")
    for k in (2, 3):
        name = f"stage_{k}"
        out = cells.join(out, {"language": "language", f"_alt_{k}": "genre"}, {"tracks": name})
        more = F.slice(_or_none(name), 1, dims.ALTERNATE_LIMIT)
        out = out.withColumn(name, F.when(found < wanted, more).otherwise(F.array()))
        found = found + F.size(name)
    return out.drop("_alt_2", "_alt_3")


def track_pools(staged: DataFrame) -> DataFrame:
    """Adds ``pool``, the tracks of all stages, each with its ``name`` in the shuffle: stage and track.

    Rows without any track are dropped.
    """

    def stage_tracks(stage: int) -> Column:
        return F.transform(
            f"stage_{stage}",
            lambda t: F.struct(
                F.lit(stage).alias("stage"),
                t["video_id"].alias("video_id"),
                t["title"].alias("title"),
                t["artist"].alias("artist"),
                watch_link(t["video_id"]).alias("youtube_url"),
                F.concat(F.lit(f"|{stage}|"), F.coalesce(t["video_id"], F.lit(""))).alias("name"),
            ),
        )

    found = staged.filter(F.size("stage_1") + F.size("stage_2") + F.size("stage_3") > 0)
    pool = F.concat(stage_tracks(1), stage_tracks(2), stage_tracks(3))
    return found.withColumn("pool", pool).drop("stage_1", "stage_2", "stage_3")


def playlists(pooled: DataFrame, request: str, seed: str, length: int = dims.PLAYLIST_LENGTH) -> DataFrame:
    """Adds ``playlist``: the pool in a shuffled order, cut to ``length``.

    A track's place is the MD5 of the seed, the request, its stage and itself: every track of every request gets a
    draw of its own, and a replay or another engine the same one. Only draws and indexes are sorted.
    """
    drawn = pooled.withColumn("_who", F.concat_ws("|", F.lit(seed), F.col(request)))
    draws = F.transform(
        "pool.name", lambda name, i: F.struct(F.md5(F.concat("_who", name)).alias("draw"), i.alias("i"))
    )
    picked = F.slice(F.sort_array(draws), 1, length)
    chosen = F.transform(picked, lambda d: F.get("pool", d["i"]))
    return drawn.withColumn("playlist", chosen).drop("_who", "pool")


def _or_none(name: str) -> Column:
    return F.coalesce(F.col(name), F.array())
