"""Genres for a request: learned ones, else the mood's defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempera import dims
from tempera.operators.learn import top_genres
from tempera.operators.lookup import Lookup


def learned_genres(scores: DataFrame, n: int = dims.TOP_GENRES) -> Lookup:
    return Lookup(top_genres(scores.filter("mood is not null"), n))


def recommend_genres(requests: DataFrame, learned: Lookup, n: int = dims.TOP_GENRES) -> DataFrame:
    """Adds ``recommended``: learned genres only, not padded, or the first ``n`` defaults."""
    defaults = F.coalesce(
        dims.lookup(dims.DEFAULT_GENRES, F.col("mood")), dims.string_array(dims.FALLBACK_GENRES)
    )
    known = F.when(F.size("_learned") > 0, F.col("_learned"))
    joined = learned.join(requests, {"mood": "mood"}, {"learned": "_learned"})
    return joined.withColumn("recommended", F.coalesce(known, F.slice(defaults, 1, n))).drop("_learned")


def choose_primary(requests: DataFrame) -> DataFrame:
    """Adds ``primary_genre``: the requested genre, or the best recommendation for the wildcard."""
    wildcard = F.col("genre") == dims.ANY_GENRE
    return requests.withColumn(
        "primary_genre", F.when(wildcard, F.get("recommended", F.lit(0))).otherwise(F.col("genre"))
    )
