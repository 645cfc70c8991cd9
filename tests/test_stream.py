"""Streams: restarts, replays, empty batches, late state."""

import datetime as dt
import hashlib
import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_ordered import START, by_user, frame, ids, kept_ids, readings, sent_ids
from test_serve import serve, shop

from tempera.operators import learn, parse, recommend
from tempera.operators.publish import parse_playlists
from tempera.session import shared_folder
from tempera.sources import log
from tempera.sources.topics import kafka_options, read_messages, write_messages
from tempera.streaming.asof import stream_as_of
from tempera.streaming.feed import finish, stage_slices
from tempera.streaming.service import PLAYLIST_SCHEMA, Service
from tempera.streaming.stateful import (
    debounce_step,
    debounce_summary,
    debouncing,
    sends,
    stream_debounce,
    stream_session,
    stream_throttle,
)
from tempera.streaming.stretches import cut

@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Every partition of state starts a Python worker of its own."""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


SCHEMA = "event_id bigint, user_id string, ts timestamp_ntz, mood string, manual boolean"


def run(spark, rows, operator, pieces=5):
    """Write the rows piece by piece; the query starts anew from its checkpoint for each."""
    source, state, out = shared_folder(spark), shared_folder(spark), shared_folder(spark)
    rows = sorted(rows, key=lambda r: (r[2], r[0]))
    cut = [len(rows) * i // pieces for i in range(pieces + 1)]
    for low, high in zip(cut, cut[1:], strict=False):
        frame(spark, rows[low:high]).write.mode("append").parquet(source)
        stream = operator(spark.readStream.schema(SCHEMA).parquet(source))
        writer = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
        finish(writer.format("parquet").start(out), 120)
    return sorted(r.event_id for r in spark.read.schema(SCHEMA).parquet(out).collect())


def test_debounce_over_restarts(spark):
    """A hot user has a third of the rows; its stretches hold a few rows each."""
    rows = readings(11)
    assert run(spark, rows, lambda s: stream_debounce(s, stretch_seconds=60), 3) == sent_ids(rows, 2, "manual")
    assert run(spark, rows, lambda s: stream_debounce(s.drop("manual"), 3), 2) == sent_ids(rows, 3, None)


@pytest.mark.parametrize("stretch", [7, 86400])
def test_throttle_over_restarts(spark, stretch):
    rows = readings(12)
    assert run(spark, rows, lambda s: stream_throttle(s, 15, stretch_seconds=stretch), 3) == kept_ids(rows, 15)


@pytest.mark.parametrize("seed", range(40))
def test_summaries_compose_as_rows_do(seed):
    """Chunks of three rows: passing a state through their summaries is folding their rows."""
    rnd = random.Random(seed)
    count, moods = rnd.randrange(1, 4), ["a", "b", None]
    rows = [(rnd.choice(moods), rnd.random() < 0.2, rnd.random() < 0.15) for _ in range(rnd.randrange(1, 40))]
    rule, size = debouncing(count), rnd.choice([1, 3, 8, 50])
    old = (rnd.choice(moods), rnd.randrange(0, count + 2), rnd.choice(moods))
    state, plain, counted, told = old, old, 0, 0
    for low in range(0, len(rows), size):
        piece = pd.DataFrame(rows[low : low + size], columns=["mood", "manual", "reset"])
        mine = np.array([r[0] for r in rows[low : low + size]] + [None], object)[:-1]
        fresh = ~piece["reset"].to_numpy()
        summary = debounce_summary(mine, piece["manual"].to_numpy(), fresh, count)
        state_2, n = debounce_step(state, json.loads(json.dumps(summary)), count)
        sent, plain = sends(mine, piece["manual"].to_numpy(), count, plain)
        counted, told = counted + n, told + int((sent & fresh).sum())
        state = rule.advance(state, rule.summarise(piece))
        assert state[0] == plain[0] and min(state[1], count) == min(plain[1], count) and state[2] == plain[2]
        assert (state_2, counted) == (state, told)
    pending, run_, last = old
    for mood, by_hand, _ in rows:
        if not by_hand:
            run_, pending = (run_ + 1 if mood == pending and run_ else 1), mood
        if by_hand or run_ >= count:
            last = mood
    assert (state[0], state[2]) == (pending, last)


def test_no_stretch_holds_a_hot_user(spark):
    """The hot user has most rows of a micro-batch; none of its stretches has more than its seconds allow."""
    rows = [(i, "hot", START + dt.timedelta(seconds=i), "ab"[i // 3 % 2], False) for i in range(600)]
    rows += [(1000 + i, "hot", None, "a", False) for i in range(5)]
    sizes = cut(frame(spark, rows), "user_id", 20).groupBy("user_id", "_stretch").count().collect()
    assert max(r["count"] for r in sizes) == 20 and len(sizes) == 31
    ordered = [r[0] for r in rows]
    timed = sent_ids(rows[:600], 2, "manual")
    source = shared_folder(spark)
    frame(spark, rows).write.parquet(source)
    stream = stream_debounce(spark.readStream.schema(SCHEMA).parquet(source), stretch_seconds=20)
    query = stream.writeStream.format("memory").queryName("hot").option("checkpointLocation", shared_folder(spark))
    finish(query.trigger(availableNow=True).start(), 120)
    got = ids(spark.table("hot"))
    assert [i for i in got if i < 1000] == timed and len(ordered) == 605


def test_null_moods_and_times(spark):
    rows = [r if r[0] % 4 else (*r[:3], None, r[4]) for r in readings(14, moods=("happy", None))]
    assert run(spark, rows, lambda s: stream_debounce(s, stretch_seconds=30), 3) == sent_ids(rows, 2, "manual")
    source = shared_folder(spark)
    frame(spark, [*rows[:40], (900, "u1", None, "sad", False), (901, "new", None, "sad", False)]).write.parquet(source)
    query = stream_throttle(spark.readStream.schema(SCHEMA).parquet(source), 15).writeStream.format("memory")
    finish(query.queryName("untimed").option("checkpointLocation", shared_folder(spark)).trigger(availableNow=True).start(), 120)
    assert [i for i in ids(spark.table("untimed")) if i >= 900] == [900, 901]


def test_session_over_restarts(spark):
    """The newest state of every user equals a plain fold over all rows."""
    rows = [(*r, r[0] % 23 == 5, r[0] % 7) for r in readings(15)]
    schema = "event_id bigint, user_id string, ts timestamp_ntz, mood string, manual boolean, reset boolean, k int"
    expected = {}
    for user, mine in by_user(rows).items():
        pending, run_, sent, counts, history, last = None, 0, None, [0, 0], [], None
        for _, _, ts, mood, by_hand, reset, _ in mine:
            if not by_hand:
                run_, pending = (run_ + 1 if mood == pending else 1), mood
                counts[0], last = counts[0] + 1, ts
                history = [*history, mood][-10:]
            if by_hand or (run_ >= 2 and mood != sent):
                sent, counts[1] = mood, counts[1] + 1
            if reset:
                counts, history = [0, 0], []
        expected[user] = (*counts, history, last)
    source, state, out = shared_folder(spark), shared_folder(spark), shared_folder(spark)
    for low in range(0, len(rows), 300):
        spark.createDataFrame(sorted(rows, key=lambda r: (r[2], r[0]))[low : low + 300], schema).write.mode("append").parquet(source)
        stream = stream_session(spark.readStream.schema(schema).parquet(source), stretch_seconds=11)
        writer = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
        finish(writer.format("parquet").start(out), 120)
    got = {}
    for r in sorted(spark.read.parquet(out).collect(), key=lambda r: r.version):
        got[r.user_id] = (r.detections, r.sends, r.history, r.last_reading)
    assert got == expected


def test_idle_state_is_forgotten(spark):
    """With a short idle time, a user silent for long starts anew; one who stays active does not."""
    start = dt.datetime(2024, 1, 1)

    def row(i, user, minute):
        return (i, user, start + dt.timedelta(minutes=minute), "sad", False)

    busy = [row(100 + i, "busy", 10 * i) for i in range(60)]
    rows = [row(0, "quiet", 0), row(1, "quiet", 1), row(2, "quiet", 595), row(3, "quiet", 596), *busy]
    kept = run(spark, rows, lambda s: stream_debounce(s, idle_seconds=3600, delay="1 minute"), pieces=6)
    assert kept == [1, 3, 101]
    assert run(spark, rows, stream_debounce, pieces=6) == [1, 101]


def message(user, mood, second, genre="Any Genre", action="mood_update"):
    data = {"mood": mood, "confidence": 50, "timestamp": 1704067200.0 + second, "language": "en", "genre": genre}
    return json.dumps({"user_id": user, "action": action, "data": data})


BATCHES = [
    [message("u1", "sad", 1, "A"), message("u2", "sad", 2, "B"), message("u3", "sad", 3, "B"), "{broken"],
    [message("u1", "sad", 4), message("u2", "happy", 5), message("u3", "", 6), message("u4", "sad", 7, action="ping")],
    [message("u1", "sad", 8), message("u5", "happy", 9, "A"), message("u6", "sad", 10, "Nothing")],
]


def expected_playlists(spark, cells):
    """Batch by batch with the library's batch functions, each from the log before it."""
    logged, out = spark.createDataFrame([], log.LOG_SCHEMA), []
    for texts in BATCHES:
        requests = parse.clean_requests(parse.parse_actions(spark.createDataFrame([(t,) for t in texts], "value string")))
        key = F.concat(F.md5("value"), F.lit("-1"))
        requests = requests.join(
            spark.createDataFrame([(t,) for t in texts], "value string").select(
                key.alias("request"), F.get_json_object("value", "$.user_id").alias("user_id")
            ),
            "user_id",
        )
        rows = serve(requests, recommend.learned_genres(learn.genre_scores(logged)), cells, "request").collect()
        out += [(r.user_id, r.primary_genre, [t.youtube_url for t in r.playlist], r.recommended) for r in rows]
        new = [(r.mood, r.primary_genre, r.confidence, r.language, r.action_time) for r in rows]
        logged = logged.unionByName(spark.createDataFrame(new, log.LOG_SCHEMA))
    return sorted(out), logged


def written_playlists(spark, service):
    rows = parse_playlists(
        log.read_batches(spark, f"{service.root}/playlists", PLAYLIST_SCHEMA)
        .select("primary_genre", "value")
    ).collect()
    return sorted(
        (r.user_id, r.primary_genre, [t.youtube_url for t in r.playlist], r.ml_recommendations) for r in rows
    )


def test_service_learns_between_batches_and_survives_replay(spark):
    cells = shop(spark, {"A": 3, "B": 12, "Pop": 4, "Electronic": 9, "Classical": 1})
    service = Service(shared_folder(spark), cells, stats_every=2)
    source, state = shared_folder(spark), shared_folder(spark)
    for texts in BATCHES:
        write_messages(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), "text", source)
        stream = read_messages(spark, "text", source)
        finish(service.start(stream, state, availableNow=True), 120)
    expected, logged = expected_playlists(spark, cells)
    assert written_playlists(spark, service) == expected
    assert ("u1", "B") in [(u, g) for u, g, *_ in expected]  # learned: B is above A for sad
    run = log.read_batches(spark, f"{service.root}/scores", log.PARTS_SCHEMA).first().run
    scores = learn.scores_from_parts(log.read_batch(spark, f"{service.root}/scores", 2, log.PARTS_SCHEMA, run))
    assert sorted(scores.collect()) == sorted(learn.genre_scores(logged).collect())
    rejected = log.read_batches(spark, f"{service.root}/rejected", "value string, reason string")
    assert sorted(r.reason for r in rejected.collect()) == ["no mood", "not a mood update", "unreadable message"]
    stats = log.read_batches(spark, f"{service.root}/stats", "total_interactions bigint, batch_rows bigint")
    assert [(r.batch_id, r.total_interactions, r.batch_rows) for r in stats.collect()] == [(1, 5, 4)]

    # A batch that runs again writes what it wrote, although the log has grown since.
    service.handle(spark.createDataFrame([(t,) for t in BATCHES[1]], "value string"), 1, run)
    assert written_playlists(spark, service) == expected
    assert log.read_batches(spark, f"{service.root}/log", log.LOG_SCHEMA).count() == logged.count()

    # A new checkpoint on the same folder reads all messages again: it adds to the log, from the scores learned so far.
    finish(service.start(read_messages(spark, "text", source), shared_folder(spark), availableNow=True), 120)
    rows = log.read_batches(spark, f"{service.root}/log", log.LOG_SCHEMA)
    assert rows.select("run").distinct().count() == 2 and rows.count() == 2 * logged.count()
    newest = log.read_batches(spark, f"{service.root}/scores", log.PARTS_SCHEMA).filter(F.col("run") != run)
    assert newest.filter("batch_id = 0").agg(F.sum("interaction_count")).first()[0] == 2 * logged.count()


def test_a_lost_snapshot_is_an_error(spark):
    service = Service(shared_folder(spark), shop(spark, {"A": 9}))
    first = spark.createDataFrame([(message("u", "sad", 1, "A"),)], "value string")
    service.handle(first, 0)
    with pytest.raises(FileNotFoundError):
        service.handle(first, 7)


def test_equal_messages_are_requests_of_their_own(spark):
    service = Service(shared_folder(spark), shop(spark, {"A": 40}))
    text = message("u", "sad", 1, "A")
    other = message("v", "sad", 2, "A")
    service.handle(spark.createDataFrame([(text,)] * 30 + [(other,)], "value string").repartition(7), 0)
    rows = log.read_batches(spark, f"{service.root}/playlists", "request string, value string").collect()
    same = hashlib.md5(text.encode()).hexdigest()
    assert {r.request for r in rows} == {f"{same}-{n}" for n in range(1, 31)} | {f"{hashlib.md5(other.encode()).hexdigest()}-1"}
    assert len(rows) == 31 and len({r.value for r in rows}) > 20


def test_rows_without_a_time_are_staged(spark):
    rows = [(i, "u", START + dt.timedelta(seconds=i) if i % 10 else None, "m", False) for i in range(100)]
    for edges in (None, [str(START + dt.timedelta(seconds=50))]):
        folder, _ = stage_slices(frame(spark, rows), edges=edges)
        assert ids(spark.read.schema(SCHEMA).parquet(folder)) == list(range(100))


def test_slices_have_equally_many_files(spark):
    """Few rows and many files: every micro-batch is still one slice."""
    rows = [(i, "u", START + dt.timedelta(seconds=i), "m", False) for i in range(40)]
    edges = [str(START + dt.timedelta(seconds=s)) for s in (2, 30, 35, 36)]
    folder, files = stage_slices(frame(spark, rows), key="user_id", edges=edges, rows_per_file=2)
    assert files == 4 and len(spark.read.schema(SCHEMA).parquet(folder).inputFiles()) == 5 * files
    seen = []
    query = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(folder).writeStream
    query = query.foreachBatch(lambda batch, _: seen.append(ids(batch))).option("checkpointLocation", shared_folder(spark))
    finish(query.trigger(availableNow=True).start(), 120)
    assert seen == [[0, 1], list(range(2, 30)), list(range(30, 35)), [35], list(range(36, 40))]
    folder, files = stage_slices(frame(spark, rows), key="user_id", key_rows=5, rows_per_file=100)
    assert (files, len(spark.read.schema(SCHEMA).parquet(folder).inputFiles())) == (1, 8)


def test_empty_batch_keeps_the_scores(spark):
    delivered = []
    service = Service(
        shared_folder(spark), shop(spark, {"A": 9}), deliver=lambda rows: delivered.append(rows.count())
    )
    first = spark.createDataFrame([(message("u", "sad", 1, "A"),)], "value string")
    service.handle(first, 0)
    service.handle(first.limit(0), 1)
    assert delivered == [1]
    before, after = (log.read_batch(spark, f"{service.root}/scores", b, log.PARTS_SCHEMA).collect() for b in (0, 1))
    assert before == after and len(after) == 1


def test_integer_confidence_gives_fractions_no_weight(spark):
    service = Service(shared_folder(spark), shop(spark, {"A": 9}), integer_confidence=True)
    text = message("u", "sad", 1, "A").replace('"confidence": 50', '"confidence": 98.7')
    service.handle(spark.createDataFrame([(text,), (message("v", "sad", 2, "A"),)], "value string"), 0)
    part = log.read_batch(spark, f"{service.root}/scores", 0, log.PARTS_SCHEMA).first()
    assert (part.confidence_sum, part.interaction_count) == (50.0, 2)


def test_kafka_options():
    options = kafka_options("host:9092", "user_actions")
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false"


def test_stream_that_does_not_end_is_stopped(spark):
    query = spark.readStream.format("rate").load().writeStream.format("noop").start()
    with pytest.raises(TimeoutError):
        finish(query, 1)
    assert not query.isActive


def test_users_are_seen_whole():
    rows = readings(11)
    assert sum(len(m) for m in by_user(rows).values()) == len(rows)


def test_as_of_meets_streams_out_of_order(spark):
    """Rows come late and in any order, from two sources and over restarts; one later than allowed is dropped."""
    rnd = random.Random(5)
    rows = readings(21, rows=300)
    rows = [(*r[:2], r[2].replace(microsecond=i), *r[3:]) for i, r in enumerate(rows)]
    late = [(rnd.randrange(50), r) for r in rows]
    arriving = [r for _, r in sorted(late, key=lambda p: (p[1][2] + dt.timedelta(seconds=p[0]), p[1][0]))]
    end = START + dt.timedelta(days=900)
    sources, state, out = [shared_folder(spark) for _ in range(2)], shared_folder(spark), shared_folder(spark)
    big = 2**60  # ids that a float cannot hold

    def write(piece):
        for k, source in enumerate(sources):
            mine = [(big + r[0], *r[1:]) for r in piece if (r[0] % 3 == 0) == (k == 0)]
            frame(spark, mine or [(big - 1, None, piece[-1][2], None, False)]).coalesce(1).write.mode("append").parquet(source)

    def go():
        clicks, changes = (spark.readStream.schema(SCHEMA).parquet(s) for s in sources)
        changes = changes.select("event_id", "user_id", "ts", F.when(~F.col("manual"), F.col("mood")).alias("genre"))
        stream = stream_as_of(clicks.drop("mood"), changes, {"genre": "none"}, delay="1 minute", stretch_seconds=20)
        writer = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
        finish(writer.format("parquet").start(out), 120)

    third = len(arriving) // 2
    for low in (0, third):
        write(arriving[low : low + third])
        go()
    write([(10**6, None, end, None, False), (10**6 + 3, None, end, None, False)])
    go()
    write([(3, "hot", START, None, False), (4, "hot", START, "sad", False)])  # far too late
    go()
    expected = {}
    for mine in by_user(rows).values():
        for event, _, ts, *_ in mine:
            if event % 3 == 0:
                known = [r[3] for r in mine if r[0] % 3 and r[2] <= ts and not r[4]]
                expected[big + event] = known[-1] if known else "none"
    got = {r.event_id: r.genre for r in spark.read.parquet(out).collect() if r.user_id is not None}
    assert got == expected
