"""The shapes of this domain, derived from the shared synthetic tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempera import dims
from tempera.functions.clock import epoch_seconds
from tempera.functions.defaults import or_default

MOOD_OF_EVENT = {
    "click": "happy",
    "view": "neutral",
    "purchase": "surprise",
    "signup": "sad",
    "error": "angry",
}
#: Schemas of the tables in use. A table read without one starts a job that reads its footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
EMOTION_ORDER = ["happy", "sad", "angry", "neutral", "fear", "surprise", "disgust"]


def nth(values: list[str], index: Column) -> Column:
    return F.get(dims.string_array(values), index.cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number ``k`` of their properties.

    A generator parses each row once; filters on what derives from ``k`` are not pushed
    below it, where they would parse again.
    """
    rows = table(spark, sf_dir, "events")
    rest = [c for c in rows.columns if c != "props"]
    return rows.select(*rest, F.json_tuple("props", "k").alias("k")).withColumn("k", F.col("k").cast("int"))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, user = F.col("k"), F.col("user_id")
    codes, names = list(dims.LANGUAGES.values()), list(dims.LANGUAGES)
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        "user_id",
        F.when(F.col("event_id") % 20 == 0, "heartbeat").otherwise(dims.MOOD_UPDATE).alias("action"),
        dims.lookup(MOOD_OF_EVENT, F.col("event_type")).alias("mood"),
        F.least("value", F.lit(100.0)).alias("confidence"),
        nth(codes, user % 14).alias("language"),
        nth(names, user % 14).alias("language_name"),
        F.when(k < 50, dims.ANY_GENRE).when(k == 99, "").otherwise(nth(dims.GENRES, k % 16)).alias("genre"),
        (F.col("event_id") % 9 == 0).alias("manual"),
    )


def action_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions as message text, with their event id beside it."""
    data = F.struct(
        "mood",
        "confidence",
        epoch_seconds("ts").alias("timestamp"),
        "language",
        "language_name",
        "genre",
        "manual",
    )
    message = F.struct(F.col("user_id").cast("string").alias("user_id"), "action", data.alias("data"))
    return actions(spark, sf_dir).select("event_id", "ts", F.to_json(message).alias("value"))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("v"), key).alias("video_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist"),
        nth(dims.GENRES, F.col("p_size") % 16).alias("genre"),
        nth(list(dims.LANGUAGES.values()), key % 14).alias("language"),
        F.col("p_retailprice").alias("relevance"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    mood = dims.lookup(MOOD_OF_EVENT, F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", mood.alias("mood"))


def readings_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).withColumn("manual", F.col("event_id") % 9 == 0)


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings, those sent by hand, and which of them clear the session."""
    mood = dims.lookup(MOOD_OF_EVENT, F.col("event_type"))
    manual, reset = F.col("event_id") % 9 == 0, (F.col("event_type") == "error") & (F.col("k") < 5)
    return events(spark, sf_dir).select(
        "event_id", "user_id", "ts", mood.alias("mood"), manual.alias("manual"), reset.alias("reset")
    )


def preference_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups choose a genre; those with an even ``k`` choose a language too."""
    k = F.col("k")
    return (
        events(spark, sf_dir)
        .filter("event_type = 'signup'")
        .select(
            "event_id",
            "user_id",
            "ts",
            nth(dims.GENRES, k % 16).alias("genre"),
            F.when(k % 2 == 0, nth(list(dims.LANGUAGES), k % 14)).alias("language_name"),
        )
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter("event_type = 'click'").select("event_id", "user_id", "ts")


def resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type = 'error' and k < 5").select("event_id", "user_id", "ts")


def emotion_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first seven elements of each vector stand for the scores of the seven labels."""
    entries = F.arrays_zip(
        dims.string_array(EMOTION_ORDER).alias("k"), F.slice("embedding", 1, len(EMOTION_ORDER)).alias("v")
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", F.map_from_entries(entries).alias("scores"))


def track_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    link = (
        F.when(key % 4 == 0, F.concat(F.lit("https://www.youtube.com/watch?v=v"), key, F.lit("&t=1")))
        .when(key % 4 == 1, F.concat(F.lit("https://youtu.be/v"), key, F.lit("?t=1")))
        .when(key % 4 == 2, F.concat(F.lit("https://example.com/"), key))
    )
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", link.alias("url"))


def shown_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlists of the tracks of four consecutive keys, with fields under either name or missing."""
    key = F.col("p_partkey")
    track = F.struct(
        key.alias("order"),
        F.when(key % 3 != 0, F.col("p_name")).alias("title"),
        F.when(key % 6 == 0, F.col("p_name")).alias("name"),
        F.when(key % 5 != 0, F.col("p_brand")).alias("artist"),
        F.when(key % 10 == 0, F.col("p_brand")).alias("artists"),
        F.when(key % 8 != 3, F.col("url")).alias("youtube_url"),
        F.when(key % 8 == 3, F.concat(F.lit("https://youtu.be/w"), key)).alias("youtube"),
    )
    return (
        track_links(spark, sf_dir)
        .groupBy(F.floor(key / 4).alias("playlist_id"))
        .agg(F.sort_array(F.collect_list(track)).alias("playlist"))
    )


def search_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per language, genre and page of the catalogue; a page has at most 25 tracks.

    Of 350 consecutive keys each of the 14 languages has 25.
    """
    key = F.col("p_partkey")
    item = F.struct(
        F.struct(F.when(key % 5 != 0, F.concat(F.lit("v"), key)).alias("videoId")).alias("id"),
        F.struct(
            F.when(key % 7 != 0, F.col("p_name")).alias("title"), F.col("p_brand").alias("channelTitle")
        ).alias("snippet"),
    )
    return (
        table(spark, sf_dir, "part")
        .groupBy(
            nth(list(dims.LANGUAGES.values()), key % 14).alias("language"),
            nth(dims.GENRES, F.col("p_size") % 16).alias("genre"),
            F.floor(key / 350).alias("page"),
        )
        .agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("value"))
    )


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions to learn from: every mood update, under the genre it was served with.

    A request for any genre counts for the first default of its mood, which is what it gets before
    anything is learned.
    """
    rows = actions(spark, sf_dir).filter(F.col("action") == dims.MOOD_UPDATE)
    genre = or_default(F.col("genre"), dims.ANY_GENRE)
    defaults = F.coalesce(dims.lookup(dims.DEFAULT_GENRES, F.col("mood")), dims.string_array(dims.FALLBACK_GENRES))
    primary = F.when(genre == dims.ANY_GENRE, F.get(defaults, F.lit(0))).otherwise(genre)
    return rows.select("mood", primary.alias("genre"), "confidence", "language", F.col("ts").alias("action_time"))


def manual_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests sent by hand: mood, language and genre are chosen for this one request."""
    k = F.col("k")
    return (
        events(spark, sf_dir)
        .filter("event_id % 9 = 0 and event_type <> 'click'")
        .select(
            "event_id",
            "user_id",
            "ts",
            nth(dims.MOODS, k % len(dims.MOODS)).alias("mood"),
            nth(list(dims.LANGUAGES), k % 14).alias("language_name"),
            nth(dims.GENRES, k % 16).alias("genre"),
        )
    )
