"""Registered queries: (spark, folder of the tables) to DataFrame.

Arrays and maps are joined or unnested in the last step, so that results are flat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempera import dims
from tempera.functions.labels import detection_text, mood_label
from tempera.functions.tracks import embed_link, search_link, search_phrase, search_request, video_id
from tempera.operators import learn, parse, publish, recommend, retrieve, sequence, session
from tempera.operators import tracks as track_ops
from tempera.operators.lookup import Lookup
from tempera.plans.serve import SEED, WISH, answer_wishes, grant, once_per_wish, serve, staged_requests
from tempera.session import shared_folder
from tempera.sources import log, views
from tempera.sources.topics import write_messages

THROTTLE_GAP_SECONDS = 12 * 3600.0
AS_OF = "2024-02-01 00:00:00"
LEARNED_AT_FIRST = 2
FIRST_PREFERENCES = {"language_name": dims.DEFAULT_LANGUAGE_NAME, "genre": dims.ANY_GENRE}


def joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


# --- inputs -------------------------------------------------------------------------------


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.clean_requests(views.actions(spark, sf_dir)).withColumn("action_time", F.col("ts"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.genre_scores(views.training_log(spark, sf_dir))


def recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned = recommend.learned_genres(scores(spark, sf_dir))
    return recommend.choose_primary(recommend.recommend_genres(requests(spark, sf_dir), learned))


def searches(spark: SparkSession, sf_dir: str) -> tuple[Lookup, Lookup]:
    """Learned genres and the ranked catalogue."""
    learned = recommend.learned_genres(scores(spark, sf_dir))
    return learned, retrieve.catalogue(views.tracks(spark, sf_dir))


def pools(spark: SparkSession, sf_dir: str) -> Lookup:
    return answer_wishes(requests(spark, sf_dir), *searches(spark, sf_dir))


def served(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve(requests(spark, sf_dir), pools(spark, sf_dir), "event_id")


def active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those who reset their session at some time."""
    return views.resets(spark, sf_dir).select(F.col("user_id").cast("string").alias("user_id"))


def kept_playlists(messages: DataFrame, active: DataFrame) -> DataFrame:
    """Playlist messages of the active users, read with the reader's defaults."""
    defaults = F.lit(dims.DEFAULT_LANGUAGE_NAME), F.lit(dims.ANY_GENRE)
    received = publish.received_playlists(publish.parse_playlists(messages), *defaults)
    return session.own_playlists(received, active).select(
        "event_id", "user_id", "mood", "language_name", "genre", F.size("playlist").alias("n_tracks")
    )


# --- parsing and learning -----------------------------------------------------------------


def parse_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_actions(views.action_messages(spark, sf_dir).drop("ts"))


def clean_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = parse.parse_actions(views.action_messages(spark, sf_dir).drop("ts"))
    return parse.clean_requests(actions).drop("song", "action_time")


def rejected_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.rejected_actions(views.action_messages(spark, sf_dir)).select("event_id", "reason")


def genre_scores_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = learn.genre_scores_map(scores(spark, sf_dir))
    return nested.select("mood", F.explode("genre_scores").alias("genre", "score"))


def mood_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.key_counts(views.training_log(spark, sf_dir), "mood")


def genre_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.key_counts(views.training_log(spark, sf_dir), "genre")


def learning_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.learning_stats(views.training_log(spark, sf_dir))


# --- recommending and retrieving ----------------------------------------------------------


def top_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.top_genres(scores(spark, sf_dir), dims.TOP_GENRES).select("mood", joined("learned"))


def recommend_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommended(spark, sf_dir).select("event_id", "mood", joined("recommended"))


def recommend_with_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As while learning begins: the log ends before a third mood occurs, which and later ones take the defaults."""
    whole = views.training_log(spark, sf_dir)
    seen = whole.groupBy("mood").agg(F.min("action_time").alias("first")).orderBy("first").limit(LEARNED_AT_FIRST + 1)
    firsts = [r["first"] for r in seen.collect()]
    until = F.lit(firsts[-1]) if len(firsts) > LEARNED_AT_FIRST else None
    early = whole if until is None else whole.filter(F.col("action_time") < until.cast("timestamp_ntz"))
    learned = recommend.learned_genres(learn.genre_scores(early))
    out = recommend.recommend_genres(requests(spark, sf_dir), learned)
    return out.select("event_id", "mood", joined("recommended"))


def primary_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommended(spark, sf_dir).select("event_id", "mood", "genre", "primary_genre")


def search_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The searches of each request: for the primary genre, and for alternates while too few tracks are found."""
    learned, cells = searches(spark, sf_dir)
    wanted, limits = dims.PLAYLIST_LENGTH, (dims.PRIMARY_LIMIT, dims.ALTERNATE_LIMIT, dims.ALTERNATE_LIMIT)

    def answer(wishes: DataFrame) -> DataFrame:
        staged = staged_requests(wishes, learned, cells)
        second, third = F.get("recommended", F.lit(1)), F.get("recommended", F.lit(2))
        found = F.size("stage_1")
        genres = F.array(
            F.col("primary_genre"), F.when(found < wanted, second), F.when(found + F.size("stage_2") < wanted, third)
        )
        return staged.select(*WISH, genres.alias("genres"))

    asked = requests(spark, sf_dir)
    each = grant(asked, once_per_wish(asked, answer), "genres").select(
        "event_id", "mood", "language", "language_name", F.posexplode("genres").alias("at", "search_genre")
    )
    each = each.filter("search_genre is not null").withColumn("search", F.col("at") + 1)
    limit = F.element_at(F.array(*[F.lit(n) for n in limits]), F.col("search"))
    # Every search draws a keyword of its own.
    draw = F.concat_ws("|", "event_id", "search")
    phrase = search_phrase(*[F.col(c) for c in ("mood", "search_genre", "language", "language_name")], draw, SEED)
    call = search_request(phrase, F.col("language"), limit)
    return each.select("event_id", "search", call.alias("call")).select("event_id", "search", "call.*")


def catalogue_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned, cells = searches(spark, sf_dir)

    def answer(wishes: DataFrame) -> DataFrame:
        primary = recommend.choose_primary(recommend.recommend_genres(wishes, learned))
        return retrieve.catalogue_candidates(primary, cells).select(
            *WISH,
            "primary_genre",
            F.size("candidates").alias("n_candidates"),
            F.array_join("candidates.video_id", "|").alias("video_ids"),
        )

    asked = requests(spark, sf_dir)
    columns = ("primary_genre", "n_candidates", "video_ids")
    return grant(asked, once_per_wish(asked, answer), *columns).select("event_id", "language", *columns)


def fallback_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    learned, cells = searches(spark, sf_dir)

    def answer(wishes: DataFrame) -> DataFrame:
        sizes = [F.size(f"stage_{k}").alias(f"n_{k}") for k in (1, 2, 3)]
        return staged_requests(wishes, learned, cells).select(*WISH, "primary_genre", *sizes)

    asked = requests(spark, sf_dir)
    columns = ("primary_genre", "n_1", "n_2", "n_3")
    return grant(asked, once_per_wish(asked, answer), *columns).select("event_id", *columns)


def playlist_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A playlist is never empty, so the outer form gives the same rows; the inner one would
    # first filter on the array's size and compute every playlist twice for it.
    rows = served(spark, sf_dir).select("event_id", F.posexplode_outer("playlist").alias("at", "t"))
    return rows.select("event_id", (F.col("at") + 1).alias("position"), "t.stage", "t.video_id")


def playlist_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlist messages as text, and what a consumer reads from it."""
    messages = served(spark, sf_dir).select("event_id", publish.playlist_payload().alias("value"))
    return publish.parse_playlists(messages).select(
        "event_id",
        "user_id",
        "source",
        "mood",
        "language",
        "language_name",
        "genre",
        "confidence",
        F.array_join("playlist.title", "|").alias("titles"),
        F.array_join("playlist.artist", "|").alias("artists"),
        F.array_join("playlist.youtube_url", "|").alias("links"),
        joined("ml_recommendations"),
    )


def log_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark)
    log.write_batch(publish.interactions(served(spark, sf_dir)), root, 0)
    return log.read_batches(spark, root, log.LOG_SCHEMA).drop("run", "batch_id")


# --- sequences ----------------------------------------------------------------------------


def dominant_emotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sequence.dominant_emotion(views.emotion_scores(spark, sf_dir))
    return found.select("vec_id", "mood", F.col("confidence").cast("double").alias("confidence"))


def detection_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    mood, confidence = F.col("mood"), F.col("confidence")
    label, text = mood_label(mood).alias("label"), detection_text(mood, confidence).alias("text")
    return views.actions(spark, sf_dir).select("event_id", label, text)


def throttle_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.throttle(views.readings(spark, sf_dir), THROTTLE_GAP_SECONDS)


def mood_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.mood_runs(views.readings(spark, sf_dir))


def debounce_moods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.debounce(views.readings(spark, sf_dir))


def debounce_with_manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.debounce(views.readings_mixed(spark, sf_dir), manual="manual")


def asof_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.as_of(views.clicks(spark, sf_dir), views.preference_changes(spark, sf_dir), FIRST_PREFERENCES)


def refresh_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Moods detected or chosen, and resets."""
    by_hand = views.manual_requests(spark, sf_dir).select("event_id", "user_id", "ts", "mood")
    detections = views.events(spark, sf_dir).filter(
        "event_type <> 'click' and event_id % 9 <> 0 and not (event_type = 'error' and k < 5)"
    )
    detections = detections.withColumn("mood", dims.lookup(views.MOOD_OF_EVENT, F.col("event_type")))
    detections = detections.select("event_id", "user_id", "ts", "mood").unionByName(by_hand)
    return detections, views.resets(spark, sf_dir).filter("event_id % 9 <> 0")


def refresh_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks that re-send the mood detected or chosen last, with the preferences of their time."""
    return sequence.refresh_requests(asof_preferences(spark, sf_dir), *refresh_inputs(spark, sf_dir))


def manual_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by hand with preferences for this once, as messages that are parsed again."""
    rows = views.manual_requests(spark, sf_dir)
    rows = rows.withColumn("confidence", F.lit(dims.MANUAL_CONFIDENCE)).withColumn("manual", F.lit(True))
    return parse.parse_actions(rows.select("event_id", parse.action_payload("ts").alias("value"))).drop("song")


def action_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks sent as actions with the preferences of their time, written to a sink and read back."""
    rows = (
        asof_preferences(spark, sf_dir)
        .withColumn("mood", F.lit("happy"))
        .withColumn("confidence", F.lit(dims.MANUAL_CONFIDENCE))
        .withColumn("manual", F.lit(False))
    )
    folder = shared_folder(spark)
    write_messages(rows.select("event_id", parse.action_payload("ts").alias("value")), "parquet", folder, ("event_id",))
    return parse.parse_actions(spark.read.schema("event_id bigint, value string").parquet(folder)).drop("song")


# --- sessions -----------------------------------------------------------------------------


def mood_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sequence.mood_history(views.readings(spark, sf_dir))
    return rows.select("event_id", "user_id", joined("history"), "history_text")


def mood_history_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sequence.mood_history(views.readings(spark, sf_dir), resets=views.resets(spark, sf_dir))
    return rows.select("event_id", "user_id", joined("history"), "history_text")


def latest_playlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest request with tracks is found first, so only one playlist per user is made."""
    answers = pools(spark, sf_dir)
    asked = requests(spark, sf_dir).select("user_id", "ts", "event_id", *WISH)
    newest = session.latest_playlist(grant(asked, answers, how="left_semi"))
    return serve(newest, answers, "event_id").select(
        "user_id",
        "event_id",
        "mood",
        F.size("playlist").alias("n_tracks"),
        F.array_join("playlist.video_id", "|").alias("video_ids"),
    )


def user_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages kept by the active users. Only their requests are served: no other message would be kept."""
    active = active_users(spark, sf_dir)
    asked = session.own_playlists(requests(spark, sf_dir), active.select(F.col("user_id").cast("bigint").alias("user_id")))
    lists = serve(asked, pools(spark, sf_dir), "event_id")
    return kept_playlists(lists.select("event_id", publish.playlist_payload().alias("value")), active)


def _session_stats(spark: SparkSession, sf_dir: str, resets: DataFrame | None) -> DataFrame:
    mixed = views.readings_mixed(spark, sf_dir)
    lists = grant(requests(spark, sf_dir), pools(spark, sf_dir), "n_tracks")
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    sends = sequence.debounce(mixed, manual="manual")
    return session.session_stats(mixed.filter("not manual"), sends, lists, as_of, resets)


def session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _session_stats(spark, sf_dir, None)


def session_stats_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _session_stats(spark, sf_dir, views.resets(spark, sf_dir))


# --- tracks -------------------------------------------------------------------------------


def search_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = F.concat_ws(" ", "p_name", F.lit("& *~+'é"), "p_brand")
    return views.table(spark, sf_dir, "part").select("p_partkey", search_link(query).alias("link"))


def video_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.track_links(spark, sf_dir).withColumn("video_id", video_id(F.col("url")))
    return found.select("p_partkey", "url", "video_id", embed_link(F.col("video_id")).alias("embed_url"))


def normalise_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return track_ops.normalise_tracks(views.shown_playlists(spark, sf_dir))


def now_playing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return track_ops.now_playing(views.shown_playlists(spark, sf_dir))


def parse_search_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    return track_ops.parse_search_response(views.search_responses(spark, sf_dir)).drop("page")


BATCH: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_actions": parse_actions,
    "clean_requests": clean_requests,
    "rejected_actions": rejected_actions,
    "genre_scores": scores,
    "genre_scores_map": genre_scores_map,
    "mood_counts": mood_counts,
    "genre_counts": genre_counts,
    "learning_stats": learning_stats,
    "top_genres": top_genres,
    "recommend_genres": recommend_genres,
    "recommend_with_defaults": recommend_with_defaults,
    "primary_genre": primary_genre,
    "search_phrase": search_phrases,
    "catalogue_candidates": catalogue_candidates,
    "fallback_stages": fallback_stages,
    "playlist_topk": playlist_topk,
    "playlist_payload": playlist_payload,
    "log_interactions": log_interactions,
    "dominant_emotion": dominant_emotion,
    "detection_labels": detection_labels,
    "throttle_detections": throttle_detections,
    "mood_runs": mood_runs,
    "debounce_moods": debounce_moods,
    "debounce_with_manual": debounce_with_manual,
    "asof_preferences": asof_preferences,
    "refresh_requests": refresh_requests,
    "manual_requests": manual_requests,
    "action_payload": action_payload,
    "mood_history": mood_history,
    "mood_history_reset": mood_history_reset,
    "latest_playlist": latest_playlist,
    "user_playlists": user_playlists,
    "session_stats": session_stats,
    "session_stats_reset": session_stats_reset,
    "search_links": search_links,
    "video_ids": video_ids,
    "normalise_tracks": normalise_tracks,
    "now_playing": now_playing,
    "parse_search_response": parse_search_response,
}
