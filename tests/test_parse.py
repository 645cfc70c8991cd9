"""Messages that are odd or broken."""

import json

from tempera.operators import parse
from tempera.operators.publish import parse_playlists, received_playlists
from pyspark.sql import functions as F


def message(**data):
    return json.dumps({"user_id": "u", "action": "mood_update", "data": {"mood": "sad", **data}})


def parsed(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return {r.i: r for r in parse.parse_actions(df, **options).collect()}


def test_confidence_forms(spark):
    texts = [message(confidence=c) for c in (7, 98.73, 100.0, "98", None, 10**20)]
    rows = parsed(spark, texts)
    assert [rows[i].confidence for i in range(6)] == [7.0, 98.73, 100.0, None, None, 1e20]
    strict = parsed(spark, texts, integer_confidence=True)
    assert [strict[i].confidence for i in range(6)] == [7, None, None, None, None, None]
    assert all(r.mood == "sad" and r.user_id == "u" for r in [*rows.values(), *strict.values()])


def test_broken_messages(spark):
    texts = ["{oops", "", '{"user_id": "u", "action": "mood_update"}', message(extra=1, manual=True), None]
    rows = parsed(spark, texts)
    assert len(rows) == 5
    assert [rows[i].mood for i in range(5)] == [None, None, None, "sad", None]
    assert rows[2].user_id == "u" and rows[3].manual is True


def test_message_bytes_and_time(spark):
    df = spark.createDataFrame([(bytearray(message(timestamp=1700000000.123457).encode()),)], "value binary")
    assert str(parse.parse_actions(df).first().action_time) == "2023-11-14 22:13:20.123457"


def test_defaults_and_filter(spark):
    schema = (
        "user_id string, action string, song string, mood string, confidence double, language string, "
        "language_name string, genre string, manual boolean"
    )
    rows = [
        ("a", "mood_update", None, "sad", None, None, None, None, None),
        ("b", "mood_update", None, "sad", 0.0, "", "", "", None),
        ("c", "mood_update", None, "sad", 5.0, "fr", "French", "Pop", True),
        ("d", "mood_update", None, "", 5.0, "fr", "French", "Pop", True),
        ("e", "mood_update", None, None, 5.0, "fr", "French", "Pop", True),
        ("f", "heartbeat", None, "sad", 5.0, "fr", "French", "Pop", True),
        ("g", None, None, "sad", 5.0, "fr", "French", "Pop", True),
    ]
    out = parse.clean_requests(spark.createDataFrame(rows, schema)).collect()
    assert [(r.user_id, r.language, r.language_name, r.genre, r.confidence) for r in out] == [
        ("a", "en", "English", "Any Genre", 0.0),
        ("b", "en", "English", "Any Genre", 0.0),
        ("c", "fr", "French", "Pop", 5.0),
    ]


def test_rejected(spark):
    texts = ["{oops", message(mood=""), message(), json.dumps({"user_id": "u", "action": "ping"})]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert sorted((r.value, r.reason) for r in parse.rejected_actions(df).collect()) == sorted(
        [(texts[0], "unreadable message"), (texts[1], "no mood"), (texts[3], "not a mood update")]
    )


def test_playlist_defaults(spark):
    texts = ['{"user_id": "u"}', '{"user_id": "v", "mood": "sad", "genre": "Pop", "playlist": [{"title": "t"}]}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    out = received_playlists(parse_playlists(df), F.lit("French"), F.lit("Jazz")).orderBy("user_id").collect()
    assert [(r.mood, r.language_name, r.genre, len(r.playlist)) for r in out] == [
        ("unknown", "French", "Jazz", 0),
        ("sad", "French", "Pop", 1),
    ]


def test_action_round_trip_keeps_null_fields(spark):
    df = spark.sql(
        "select 5 user_id, 'sad' mood, cast(null as double) confidence, 'Tamil' language_name, "
        "'Pop' genre, true manual, timestamp_ntz'2024-01-01 00:00:00.5' ts"
    ).select(parse.action_payload("ts").alias("value"))
    assert json.loads(df.first().value) == {
        "user_id": "5",
        "action": "mood_update",
        "data": {
            "mood": "sad",
            "confidence": None,
            "timestamp": 1704067200.5,
            "language": "ta",
            "language_name": "Tamil",
            "genre": "Pop",
            "manual": True,
        },
    }
