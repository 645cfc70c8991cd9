"""What the interaction log teaches: genre scores per mood, and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PLACES = 4


def score_parts(interactions: DataFrame) -> DataFrame:
    """Mergeable sums per (mood, genre): a later batch adds its own parts to them."""
    return interactions.groupBy("mood", "genre").agg(
        F.sum("confidence").cast("double").alias("confidence_sum"),
        F.count("confidence").alias("confidence_count"),
        F.count("*").alias("interaction_count"),
    )


def merge_parts(*parts: DataFrame) -> DataFrame:
    together = parts[0]
    for more in parts[1:]:
        together = together.unionByName(more)
    return together.groupBy("mood", "genre").agg(
        F.sum("confidence_sum").alias("confidence_sum"),
        F.sum("confidence_count").alias("confidence_count"),
        F.sum("interaction_count").alias("interaction_count"),
    )


def scores_from_parts(parts: DataFrame) -> DataFrame:
    """Average confidence times number of interactions.

    The average skips NULL while the count does not, so this is not simply the sum.
    Rounded, so that the order of a distributed sum cannot change a rank; first to more
    places, so that it cannot tip a half either.
    """
    average = F.col("confidence_sum") / F.nullif(F.col("confidence_count"), F.lit(0))
    score = average * F.col("interaction_count")
    return parts.select(
        "mood",
        "genre",
        F.round(F.round(average, 2 * PLACES), PLACES).alias("avg_confidence"),
        "interaction_count",
        F.round(F.round(score, 2 * PLACES), PLACES).alias("score"),
    )


def genre_scores(interactions: DataFrame) -> DataFrame:
    return scores_from_parts(score_parts(interactions))


def genre_scores_map(scores: DataFrame) -> DataFrame:
    """One row per mood with its genre to score map, the shape of a score snapshot."""
    entries = F.sort_array(F.collect_list(F.struct("genre", "score")))
    return scores.groupBy("mood").agg(F.map_from_entries(entries).alias("genre_scores"))


def key_counts(interactions: DataFrame, key: str) -> DataFrame:
    return interactions.groupBy(key).agg(F.count("*").alias("interactions"))


def learning_stats(interactions: DataFrame) -> DataFrame:
    """Statistics of a log, which is scanned once."""
    return stats_from_parts(score_parts(interactions))


def stats_from_parts(parts: DataFrame) -> DataFrame:
    """One row: totals, number of moods and genres (NULL is a group too), the most frequent ones.

    The sums per (mood, genre) hold all that is needed. Equal counts give the smallest key.
    """
    pairs = parts.select("mood", "genre", F.col("interaction_count").alias("n"))
    # Two narrow rows per pair, so moods and genres share one aggregate.
    kinds = pairs.select(
        F.explode(
            F.array(
                F.struct(F.lit("mood").alias("kind"), F.col("mood").alias("key"), "n"),
                F.struct(F.lit("genre").alias("kind"), F.col("genre").alias("key"), "n"),
            )
        ).alias("k")
    ).select("k.*")
    counts = kinds.groupBy("kind", "key").agg(F.sum("n").alias("n"))
    mood, genre = F.col("kind") == "mood", F.col("kind") == "genre"
    first = F.struct(-F.col("n"), F.col("key"))
    return counts.agg(
        F.coalesce(F.sum(F.when(mood, F.col("n"))), F.lit(0)).alias("total_interactions"),
        F.count_if(mood).alias("moods_learned"),
        F.count_if(genre).alias("genres_seen"),
        F.min_by("key", F.when(mood, first)).alias("top_mood"),
        F.min_by("key", F.when(genre, first)).alias("top_genre"),
    )


def top_genres(scores: DataFrame, n: int) -> DataFrame:
    """The ``n`` best genres of each mood, best first; equal scores by name."""
    best = W.partitionBy("mood").orderBy(F.desc("score"), "genre")
    return (
        scores.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= n)
        .groupBy("mood")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "genre")))["genre"].alias("learned"))
    )
