"""Learning, recommending, the stage rule, playlists and sessions on hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tempera import dims
from tempera.operators import learn, publish, recommend, retrieve, session
from tempera.operators.lookup import Lookup
from tempera.plans import serve as plan
from tempera.plans.serve import staged_requests
from tempera.session import shared_folder
from tempera.sources import log

LOG = "mood string, genre string, confidence double, language string"


def serve(requests, learned, cells, request, **options):
    return plan.serve(requests, plan.answer_wishes(requests, learned, cells), request, **options)


def interactions(spark, rows):
    return spark.createDataFrame([(m, g, c, "en") for m, g, c in rows], LOG)


def test_score_is_average_times_count(spark):
    rows = [("sad", "Pop", 10.0), ("sad", "Pop", None), ("sad", "Rock", 1.0), ("sad", "Jazz", None)]
    out = {r.genre: r for r in learn.genre_scores(interactions(spark, rows)).collect()}
    assert (out["Pop"].avg_confidence, out["Pop"].interaction_count, out["Pop"].score) == (10.0, 2, 20.0)
    assert out["Rock"].score == 1.0 and out["Jazz"].score is None


def test_merged_parts_equal_one_pass(spark):
    rows = [(f"m{i % 3}", f"g{i % 5}", float(i)) for i in range(200)]
    whole = learn.genre_scores(interactions(spark, rows))
    parts = learn.merge_parts(*[learn.score_parts(interactions(spark, rows[i::3])) for i in range(3)])
    assert sorted(whole.collect()) == sorted(learn.scores_from_parts(parts).collect())


def test_stats(spark):
    rows = [("sad", "Pop", 1.0), ("sad", "Rock", 1.0), ("happy", "Rock", 1.0), ("happy", "Pop", 1.0), (None, "Pop", 1.0)]
    assert learn.learning_stats(interactions(spark, rows)).first().asDict() == {
        "total_interactions": 5,
        "moods_learned": 3,
        "genres_seen": 2,
        "top_mood": "happy",
        "top_genre": "Pop",
    }
    assert learn.learning_stats(interactions(spark, [])).first().asDict() == {
        "total_interactions": 0,
        "moods_learned": 0,
        "genres_seen": 0,
        "top_mood": None,
        "top_genre": None,
    }


def test_missing_log_is_empty(spark):
    empty = log.read_batches(spark, shared_folder(spark), log.LOG_SCHEMA)
    assert empty.count() == 0 and empty.columns[-2:] == ["run", "batch_id"]


def test_recommendations(spark):
    scores = spark.createDataFrame(
        [("one", "Pop", 1.0)]
        + [("tied", g, 2.0) for g in ("Rock", "Jazz", "Pop")]
        + [("six", f"g{i}", float(i)) for i in range(6)],
        "mood string, genre string, score double",
    )
    learned = recommend.learned_genres(scores)
    moods = ["one", "tied", "six", "sad", "angry", "unknown"]
    requests = spark.createDataFrame([(m, "Any Genre") for m in moods] + [("sad", "Pop")], "mood string, genre string")
    out = recommend.choose_primary(recommend.recommend_genres(requests, learned)).collect()
    assert {(r.mood, r.genre): (r.recommended, r.primary_genre) for r in out} == {
        ("one", "Any Genre"): (["Pop"], "Pop"),
        ("tied", "Any Genre"): (["Jazz", "Pop", "Rock"], "Jazz"),
        ("six", "Any Genre"): (["g5", "g4", "g3", "g2", "g1"], "g5"),
        ("sad", "Any Genre"): (dims.DEFAULT_GENRES["sad"], "Ballad"),
        ("sad", "Pop"): (dims.DEFAULT_GENRES["sad"], "Pop"),
        ("angry", "Any Genre"): (["Metal", "Rock", "Hip Hop"], "Metal"),
        ("unknown", "Any Genre"): (["Pop", "Rock"], "Pop"),
    }


def shop(spark, sizes):
    """A catalogue with ``sizes[genre]`` English tracks per genre."""
    rows = [(f"{g}{i:02d}", f"t{i}", "a", g, "en", float(100 - i)) for g, n in sizes.items() for i in range(n)]
    schema = "video_id string, title string, artist string, genre string, language string, relevance double"
    return retrieve.catalogue(spark.createDataFrame(rows, schema))


def one_request(spark, genre="A", language="en"):
    return spark.createDataFrame(
        [(1, "u", "mood_update", "m", 5.0, language, "English", genre, dt.datetime(2024, 1, 1))],
        "event_id int, user_id string, action string, mood string, confidence double, language string, "
        "language_name string, genre string, action_time timestamp_ntz",
    )


def learned_abc(spark, genres="ABC"):
    rows = [("m", g, float(10 - i)) for i, g in enumerate(genres)]
    return recommend.learned_genres(spark.createDataFrame(rows, "mood string, genre string, score double"))


@pytest.mark.parametrize(
    "sizes,expected",
    [
        ((8, 9, 9), (8, 0, 0)),
        ((40, 9, 9), (25, 0, 0)),
        ((7, 1, 9), (7, 1, 0)),
        ((7, 0, 5), (7, 0, 5)),
        ((0, 0, 0), (0, 0, 0)),
        ((3, 5, 4), (3, 5, 0)),
        ((3, 4, 40), (3, 4, 15)),
        ((0, 40, 4), (0, 15, 0)),
    ],
)
def test_stage_rule(spark, sizes, expected):
    cells = shop(spark, dict(zip("ABC", sizes, strict=True)) | {"Z": 1})
    row = staged_requests(one_request(spark), learned_abc(spark), cells).first()
    assert tuple(len(row[f"stage_{k}"]) for k in (1, 2, 3)) == expected
    assert [t.rank for t in row.stage_1] == list(range(1, expected[0] + 1))
    served = serve(one_request(spark), learned_abc(spark), cells, "event_id").collect()
    assert len(served) == (sum(expected) > 0)
    if served:
        assert len(served[0].playlist) == min(8, sum(expected))
        assert len({t.video_id for t in served[0].playlist}) == min(8, sum(expected))


def test_repeated_genre_repeats_tracks(spark):
    """A chosen genre that is also the second recommendation is searched twice."""
    served = serve(one_request(spark, "B"), learned_abc(spark), shop(spark, {"B": 2}), "event_id").first()
    assert sorted((t.stage, t.video_id) for t in served.playlist) == [(1, "B00"), (1, "B01"), (2, "B00"), (2, "B01")]


def test_short_recommendation_list(spark):
    served = serve(one_request(spark), learned_abc(spark, "A"), shop(spark, {"A": 2, "B": 5}), "event_id").first()
    assert len(served.playlist) == 2 and served.recommended == ["A"]


def test_other_language_finds_nothing(spark):
    cells = shop(spark, {"A": 9})
    assert serve(one_request(spark, language="fr"), learned_abc(spark), cells, "event_id").count() == 0


def test_shuffle_is_even_and_repeatable(spark):
    """Over many requests every track and every pair of tracks is chosen about equally often."""
    requests = one_request(spark).drop("event_id").crossJoin(spark.range(8000).withColumnRenamed("id", "event_id"))
    cells, learned = shop(spark, {"A": 20}), learned_abc(spark)
    out = serve(requests, learned, cells, "event_id").select("event_id", "playlist.video_id").collect()
    again = serve(requests.repartition(3), learned, cells, "event_id").select("event_id", "playlist.video_id").collect()
    assert sorted(out) == sorted(again)
    singles, pairs, first = {}, {}, {}
    for row in out:
        ids = row.video_id
        first[ids[0]] = first.get(ids[0], 0) + 1
        for a in ids:
            singles[a] = singles.get(a, 0) + 1
            for b in ids:
                if a < b:
                    pairs[a, b] = pairs.get((a, b), 0) + 1
    assert len(singles) == 20 and all(0.9 < n / 3200 < 1.1 for n in singles.values())
    assert len(first) == 20 and all(0.75 < n / 400 < 1.25 for n in first.values())
    assert len(pairs) == 190 and all(0.8 < n / (8000 * 56 / 380) < 1.2 for n in pairs.values())
    other = serve(requests, learned, cells, "event_id", seed="8").select("event_id", "playlist.video_id").collect()
    assert sorted(out) != sorted(other)


def test_pools_of_any_size_are_shuffled_whole(spark):
    """Two hundred tracks of a cell: every one is served to someone, none twice in a playlist."""
    rows = [(f"v{i:03d}", "t", "a", "A", "en", float(i)) for i in range(200)]
    schema = "video_id string, title string, artist string, genre string, language string, relevance double"
    cells = Lookup(retrieve.ranked_cells(spark.createDataFrame(rows, schema), limit=200))
    requests = one_request(spark).drop("event_id").crossJoin(spark.range(1000).withColumnRenamed("id", "event_id"))
    out = serve(requests, learned_abc(spark), cells, "event_id").select("playlist.video_id").collect()
    assert all(len(set(r.video_id)) == 8 for r in out)
    assert {v for r in out for v in r.video_id} == {f"v{i:03d}" for i in range(200)}


def test_interactions_credit_the_primary_genre_without_the_user(spark):
    served = serve(one_request(spark, "Any Genre"), learned_abc(spark), shop(spark, {"B": 9}), "event_id")
    rows = publish.interactions(served)
    assert "user_id" not in rows.columns
    assert [(r.genre, r.mood, r.confidence) for r in rows.collect()] == [("A", "m", 5.0)]


def test_log_batches_are_replaced_on_replay(spark):
    root = shared_folder(spark)
    schema = "n int"
    for batch, rows in [(0, 5), (1, 7), (1, 7), (0, 3)]:
        log.write_batch(spark.range(rows).selectExpr("cast(id as int) n"), root, batch)
    assert log.read_batches(spark, root, schema).count() == 10
    log.write_batch(spark.range(0).selectExpr("cast(id as int) n"), root, 1)
    assert log.read_batches(spark, root, schema).count() == 3
    assert log.read_batch(spark, root, 0, schema).count() == 3
    with pytest.raises(FileNotFoundError):
        log.read_batch(spark, root, 9, schema)
    log.write_batch(spark.range(4).selectExpr("cast(id as int) n"), root, 0, "other")
    assert log.read_batches(spark, root, schema).count() == 7


def at(second):
    return dt.datetime(2024, 1, 1, 0, 0, second)


def test_session_reset(spark):
    ids = "user_id string, ts timestamp_ntz, event_id bigint"
    detections = spark.createDataFrame([("a", at(1), 1), ("a", at(5), 2), ("b", at(2), 3)], ids)
    sends = spark.createDataFrame([("a", at(1), 1), ("b", at(2), 3)], ids)
    lists = spark.createDataFrame([("a", at(2), 1, 8), ("b", at(3), 3, 4), ("b", at(4), 4, 6)], f"{ids}, n_tracks int")
    resets = spark.createDataFrame([("a", at(3), 9), ("a", at(2), 8), ("b", at(1), 7)], ids)
    now = F.lit("2024-01-01 00:01:00.9").cast("timestamp_ntz")

    def rows(reset):
        out = session.session_stats(detections, sends, lists, now, reset).orderBy("user_id").collect()
        return [(r.user_id, r.detections, r.sends, r.tracks_in_queue, r.seconds_since_reading) for r in out]

    assert rows(None) == [("a", 2, 1, 8, 55), ("b", 1, 1, 6, 58)]
    assert rows(resets) == [("a", 1, 0, 0, 55), ("b", 1, 1, 6, 58)]
