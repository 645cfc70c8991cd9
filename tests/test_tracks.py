"""Links, ids, phrases and track rows."""

from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from tempera import dims
from tempera.functions import tracks as fn
from tempera.operators import tracks

QUERIES = ["a b", "a&b+c", "x*y~z", "it's \"quoted\"", "é ü", "音楽", "a/b?c=d#e%", "-_.", "", None]
URLS = {
    "https://www.youtube.com/watch?v=abc": "abc",
    "https://www.youtube.com/watch?v=abc&t=1": "abc",
    "https://youtu.be/xyz?t=3": "xyz",
    "https://youtu.be/xyz": "xyz",
    "https://youtu.be/no?u=watch?v=yes&x": "yes",
    "https://www.youtube.com/watch?v=&t=1": "",
    "https://example.com/1": None,
    "": None,
    None: None,
}


def test_search_link(spark):
    df = spark.createDataFrame([(q,) for q in QUERIES], "q string")
    out = {r.q: r.l for r in df.select("q", fn.search_link(F.col("q")).alias("l")).collect()}
    assert out == {q: fn.SEARCH_LINK + quote_plus(q) if q else None for q in QUERIES}


def test_video_id(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    out = {r.u: r.v for r in df.select("u", fn.video_id(F.col("u")).alias("v")).collect()}
    assert out == URLS


def test_search_phrase(spark):
    rows = [
        ("happy", "Pop", "en", "English"),
        ("happy", "Any Genre", "fr", "French"),
        ("bored", "", "xx", "Other"),
        ("", "Pop", "en", "English"),
        (None, "Pop", "en", "English"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, m string, g string, l string, n string")
    phrase = fn.search_phrase(*[F.col(c) for c in "mglni"], "7")
    out = df.select("i", phrase.alias("p"), fn.search_request(phrase, F.col("l"), 25).alias("r")).orderBy("i").collect()
    first = out[0].p.removesuffix(" Pop songs music")
    assert first in dims.MOOD_KEYWORDS["happy"]
    assert out[1].p.removesuffix(" French songs music") in dims.MOOD_KEYWORDS["happy"]
    assert out[2].p == "bored Other songs music" and out[2].r.regionCode == "US"
    assert out[3].p is None and out[4].p is None
    assert out[1].r.regionCode == "FR" and out[1].r.maxResults == 25


def test_keywords_are_drawn_evenly(spark):
    drawn = spark.range(5000).select(fn.pick_keyword(F.lit("sad"), F.col("id"), "7").alias("w"))
    counts = {r.w: r["count"] for r in drawn.groupBy("w").count().collect()}
    assert set(counts) == set(dims.MOOD_KEYWORDS["sad"])
    assert all(850 < n < 1150 for n in counts.values())


TRACK = "struct<title:string,name:string,artist:string,artists:string,youtube_url:string,youtube:string>"


@pytest.fixture
def lists(spark):
    rows = [
        (1, [("t", "n", "a", "b", "https://youtu.be/x", "y"), ("", "n", None, "b", "", "https://e.com/1")]),
        (2, [(None, None, None, None, None, None)]),
        (3, []),
        (4, [("", "", "", None, None, None)]),
    ]
    return spark.createDataFrame(rows, f"id int, playlist array<{TRACK}>")


def test_normalise(lists):
    out = tracks.normalise_tracks(lists).orderBy("id", "position").collect()
    assert [(r.id, r.position, r.title, r.artist, r.link) for r in out] == [
        (1, 1, "t", "a", "https://youtu.be/x"),
        (1, 2, "n", "b", "https://e.com/1"),
        (2, 1, "Unknown Track", "Unknown Artist", fn.SEARCH_LINK + "Unknown+Track+Unknown+Artist"),
        (4, 1, "", "Unknown Artist", fn.SEARCH_LINK + "+Unknown+Artist"),
    ]


def test_now_playing(lists):
    out = tracks.now_playing(lists).orderBy("id").collect()
    assert [(r.id, r.title, r.artist, r.play_link) for r in out] == [
        (1, "t", "a", "https://www.youtube.com/embed/x"),
        (2, "Unknown", "", None),
        (4, "", "", None),
    ]


def test_search_response(spark):
    text = """{"items": [
        {"id": {"videoId": "a"}, "snippet": {"title": "T", "channelTitle": "C"}},
        {"id": {"videoId": "b"}, "snippet": {}},
        {"id": {"videoId": "c"}},
        {"id": {"videoId": "d"}, "snippet": {"title": "", "channelTitle": ""}},
        {"id": {"videoId": ""}, "snippet": {"title": "no"}},
        {"id": {}, "snippet": {"title": "no"}},
        {"snippet": {"title": "no"}}]}"""
    df = spark.createDataFrame([(1, text), (2, "{}"), (3, "broken")], "id int, value string")
    out = tracks.parse_search_response(df).collect()
    assert [(r.id, r.title, r.artist, r.youtube_url[-1]) for r in out] == [
        (1, "T", "C", "a"),
        (1, "Unknown Title", "Unknown Artist", "b"),
        (1, "Unknown Title", "Unknown Artist", "c"),
        (1, "", "", "d"),
    ]
