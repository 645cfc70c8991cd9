"""Registered streaming queries: the table as a bounded stream, the result as a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempera import dims
from tempera.operators import learn, parse, publish, retrieve
from tempera.plans.queries import (
    FIRST_PREFERENCES,
    THROTTLE_GAP_SECONDS,
    active_users,
    kept_playlists,
    refresh_inputs,
    served,
)
from tempera.session import shared_folder
from tempera.sources import commits, log, views
from tempera.sources.topics import read_messages, write_messages
from tempera.streaming.asof import stream_as_of, stream_refresh_requests
from tempera.streaming.feed import finish, stage_slices
from tempera.streaming.newest import NewestPerKey
from tempera.streaming.service import OUTPUTS, PLAYLIST_SCHEMA, SNAPSHOTS, STATS_SCHEMA, Service, learn_batch
from tempera.streaming.stateful import stream_debounce, stream_session, stream_throttle
from tempera.streaming.stretches import no_idle_partitions

#: Fixed cuts of the month of events: micro-batches of 180 hours for serving and of 60 for the statistics.
MONTH = dt.datetime(2024, 1, 1)
SERVE_EDGES = [str(MONTH + dt.timedelta(hours=180 * i)) for i in range(1, 4)]
STATS_EDGES = [str(MONTH + dt.timedelta(hours=60 * i)) for i in range(1, 12)]


TRIGGER_EDGES = ["2023-12-31 00:00:00", SERVE_EDGES[1], "2025-01-01 00:00:00"]
ROWS_PER_SERVED_FILE = 25_000  # each row draws and writes a playlist
HEARTBEAT = -1  # event id of the last row of a bounded stream
CLOCK_END = "2100-01-01 00:00:00"


def _source(spark: SparkSession, table: DataFrame, key: str | None = None, edges: list[str] | None = None) -> DataFrame:
    """``table`` as a stream of at least four micro-batches in time order."""
    folder, files = stage_slices(table, key=key, edges=edges)
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(folder)


def _appended(stream: DataFrame) -> DataFrame:
    """Run ``stream`` to its end into files and return them as a table."""
    root = shared_folder(stream.sparkSession)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/state")
    with no_idle_partitions(stream.sparkSession):
        query = writer.trigger(availableNow=True).start(f"{root}/out")
    finish(query)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def _each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    writer = stream.writeStream.foreachBatch(handle).outputMode(mode)
    writer = writer.option("checkpointLocation", shared_folder(stream.sparkSession))
    finish(writer.trigger(availableNow=True).start())


def stream_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = stage_slices(views.action_messages(spark, sf_dir))
    columns = "event_id bigint, ts timestamp_ntz, value string"
    messages = read_messages(spark, "parquet", folder, columns, maxFilesPerTrigger=str(files))
    return _appended(parse.parse_actions(messages.drop("ts")))


def stream_genre_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sums in the state store; each batch writes the whole small score table."""
    source = _source(spark, views.training_log(spark, sf_dir).withColumnRenamed("action_time", "ts"))
    root = shared_folder(spark)
    last = []

    def handle(parts: DataFrame, batch_id: int) -> None:
        log.write_batch(parts, root, batch_id)
        last[:] = [batch_id]

    _each_batch(learn.score_parts(source), handle, "complete")
    parts = log.read_batch(spark, root, last[0], log.PARTS_SCHEMA) if last else spark.createDataFrame([], log.PARTS_SCHEMA)
    return learn.scores_from_parts(parts)


def stream_throttled(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source(spark, views.readings(spark, sf_dir), key="user_id")
    return _appended(stream_throttle(source, THROTTLE_GAP_SECONDS))


def stream_debounced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(stream_debounce(_source(spark, views.readings(spark, sf_dir), key="user_id")))


def stream_debounced_with_manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(stream_debounce(_source(spark, views.readings_mixed(spark, sf_dir), key="user_id")))


def stream_session_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest state of each user's session."""
    source = _source(spark, views.session_events(spark, sf_dir), key="user_id")
    states = _appended(stream_session(source))
    rest = [c for c in states.columns if c not in ("user_id", "version")]
    newest = states.groupBy("user_id").agg(F.max_by(F.struct(*rest), "version").alias("s")).select("user_id", "s.*")
    return newest.withColumn("history", F.array_join("history", "|"))


def _served(spark: SparkSession, sf_dir: str, edges: list[str], run: Callable[[Service, DataFrame], None]) -> DataFrame:
    """What a service writes for the actions, in micro-batches cut at ``edges``, read after compaction."""
    table = views.action_messages(spark, sf_dir)
    folder, files = stage_slices(table, edges=edges, rows_per_file=ROWS_PER_SERVED_FILE)
    columns = "event_id bigint, ts timestamp_ntz, value string"
    messages = read_messages(spark, "parquet", folder, columns, maxFilesPerTrigger=str(files))
    service = Service(shared_folder(spark), retrieve.catalogue(views.tracks(spark, sf_dir)), key="event_id")
    run(service, messages)
    commits.compact(spark, service.root, OUTPUTS)
    commits.expire(spark, service.root, OUTPUTS, SNAPSHOTS)
    rows = commits.read(spark, service.root, "playlists", PLAYLIST_SCHEMA).select("run", "batch_id", "request", "value")
    lists = publish.parse_playlists(rows.drop("run", "batch_id"))
    return lists.select(
        "request",
        "user_id",
        "mood",
        "genre",
        F.size("playlist").alias("n_tracks"),
        F.array_join("playlist.youtube_url", "|").alias("links"),
        F.array_join("ml_recommendations", "|").alias("ml_recommendations"),
    )


def stream_serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlists served while the scores are learned from the batches before."""

    def to_the_end(service: Service, messages: DataFrame) -> None:
        finish(service.start(messages, shared_folder(spark), availableNow=True))

    return _served(spark, sf_dir, SERVE_EDGES, to_the_end)


def stream_serve_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As deployed: a micro-batch every two seconds. The first and the last are empty and serve nothing."""

    def by_the_clock(service: Service, messages: DataFrame) -> None:
        query = service.start(messages, shared_folder(spark))
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    return _served(spark, sf_dir, TRIGGER_EDGES, by_the_clock)


def _coming_late(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """A stream of ``rows`` that come up to 50 minutes late, so out of order, and at last a heartbeat of nobody."""
    late = (F.pmod(F.xxhash64("event_id"), F.lit(3000)) / 1).cast("int")
    coming = rows.withColumn("arrival", F.timestamp_add("SECOND", late, "ts"))
    beat = spark.range(1).select(F.lit(HEARTBEAT).alias("event_id"), F.lit(CLOCK_END).cast("timestamp_ntz").alias("ts"))
    coming = coming.unionByName(beat.withColumn("arrival", F.col("ts")), allowMissingColumns=True)
    folder, files = stage_slices(coming, ts="arrival")
    reader = spark.readStream.schema(coming.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(folder).drop("arrival")


def stream_asof_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and preference changes as two streams, both out of order."""
    clicks = _coming_late(spark, views.clicks(spark, sf_dir))
    changes = _coming_late(spark, views.preference_changes(spark, sf_dir))
    return _appended(stream_as_of(clicks, changes, FIRST_PREFERENCES)).filter(F.col("event_id") != HEARTBEAT)


def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks that re-send the newest mood, from four streams out of order."""
    streams = [views.clicks(spark, sf_dir), *refresh_inputs(spark, sf_dir), views.preference_changes(spark, sf_dir)]
    clicks, detections, resets, changes = (_coming_late(spark, s) for s in streams)
    found = stream_refresh_requests(clicks, detections, resets, (changes, FIRST_PREFERENCES))
    return _appended(found).filter(F.col("event_id") != HEARTBEAT)


def stream_user_playlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The playlist topic as a stream, of which active users keep their own messages."""
    folder = shared_folder(spark)
    messages = served(spark, sf_dir).select("event_id", publish.playlist_payload().alias("value"))
    write_messages(messages, "parquet", folder, ("event_id",))
    topic = read_messages(spark, "parquet", folder, "event_id bigint, value string")
    return _appended(kept_playlists(topic, active_users(spark, sf_dir)))


def stream_latest_playlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The playlist topic upserted into a table of each user's newest."""
    lists = served(spark, sf_dir).select(
        "user_id",
        "event_id",
        "ts",
        "mood",
        F.size("playlist").alias("n_tracks"),
        F.array_join("playlist.video_id", "|").alias("video_ids"),
    )
    topic = _source(spark, lists, key="user_id")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lists.schema)
    newest = NewestPerKey(shared_folder(spark), schema, "user_id", ("ts", "event_id"), buckets=8)
    finish(newest.start(topic, shared_folder(spark), availableNow=True))
    newest.expire(spark)
    return newest.read(spark).drop("ts")


def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions per batch are logged; every tenth batch reports the statistics so far."""
    table = views.training_log(spark, sf_dir).withColumnRenamed("action_time", "ts")
    source = _source(spark, table, edges=STATS_EDGES).withColumnRenamed("ts", "action_time")
    root = shared_folder(spark)

    def handle(batch: DataFrame, batch_id: int) -> None:
        commits.commit(spark, root, batch_id, learn_batch(batch, root, batch_id, dims.STATS_EVERY))

    _each_batch(source, handle)
    return commits.read(spark, root, "stats", STATS_SCHEMA).drop("run")


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_actions": stream_actions,
    "stream_genre_scores": stream_genre_scores,
    "stream_throttle": stream_throttled,
    "stream_debounce": stream_debounced,
    "stream_debounce_with_manual": stream_debounced_with_manual,
    "stream_session": stream_session_state,
    "stream_serve": stream_serve,
    "stream_serve_trigger": stream_serve_trigger,
    "stream_stats": stream_stats,
    "stream_user_playlists": stream_user_playlists,
    "stream_latest_playlist": stream_latest_playlist,
    "stream_asof_preferences": stream_asof_preferences,
    "stream_refresh_requests": stream_refresh,
}

# A stream gives the rows of its batch twin, so it is checked by the same SQL.
BATCH_TWIN = {
    "stream_actions": "parse_actions",
    "stream_genre_scores": "genre_scores",
    "stream_throttle": "throttle_detections",
    "stream_debounce": "debounce_moods",
    "stream_debounce_with_manual": "debounce_with_manual",
    "stream_user_playlists": "user_playlists",
    "stream_latest_playlist": "latest_playlist",
    "stream_asof_preferences": "asof_preferences",
    "stream_refresh_requests": "refresh_requests",
}
