"""Links, video ids and search phrases."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempera import dims
from tempera.functions.defaults import present

# Link formats.
SEARCH_LINK = "https://www.youtube.com/results?search_query="
WATCH_LINK = "https://www.youtube.com/watch?v="
EMBED_LINK = "https://www.youtube.com/embed/"
WATCH_MARK = "watch?v="
SHORT_MARK = "youtu.be/"


def search_link(query: Column) -> Column:
    """Search page for a query, NULL for an empty one.

    ``url_encode`` differs from form encoding in two characters: it keeps ``*`` and
    escapes ``~``.
    """
    encoded = F.replace(F.replace(F.url_encode(query), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.when(present(query), F.concat(F.lit(SEARCH_LINK), encoded))


def video_id(url: Column) -> Column:
    """Id inside a watch link or a short link; the watch form wins, other links give NULL."""

    def between(mark: str, end: str) -> Column:
        return F.split_part(F.split_part(url, F.lit(mark), F.lit(2)), F.lit(end), F.lit(1))

    return F.when(F.contains(url, F.lit(WATCH_MARK)), between(WATCH_MARK, "&")).when(
        F.contains(url, F.lit(SHORT_MARK)), between(SHORT_MARK, "?")
    )


def watch_link(vid: Column) -> Column:
    return F.concat(F.lit(WATCH_LINK), vid)


def embed_link(vid: Column) -> Column:
    return F.when(present(vid), F.concat(F.lit(EMBED_LINK), vid))


def pick_keyword(mood: Column, request: Column, seed: str) -> Column:
    """One of the mood's keywords, uniform over seeds but the same on every run."""
    words = F.coalesce(dims.lookup(dims.MOOD_KEYWORDS, mood), F.array(mood))
    hashed = F.transform(
        words, lambda w: F.struct(F.md5(F.concat_ws("|", F.lit(seed), request, w)).alias("h"), w.alias("w"))
    )
    return F.array_min(hashed)["w"]


def search_phrase(
    mood: Column, genre: Column, language: Column, language_name: Column, request: Column, seed: str
) -> Column:
    """Phrase for the track search; an empty mood gives no search at all."""
    phrase = F.concat_ws(
        " ",
        pick_keyword(mood, request, seed),
        F.when(present(genre) & (genre != dims.ANY_GENRE), genre),
        F.when(language != dims.DEFAULT_LANGUAGE, language_name),
        F.lit("songs music"),
    )
    return F.when(present(mood), phrase)


def search_request(phrase: Column, language: Column, limit: Column | int) -> Column:
    """Parameters of one search call; credentials are not part of it."""
    return F.struct(
        F.lit("snippet").alias("part"),
        phrase.alias("q"),
        F.lit("video").alias("type"),
        F.lit("10").alias("videoCategoryId"),
        (limit if isinstance(limit, Column) else F.lit(limit)).alias("maxResults"),
        F.coalesce(dims.lookup(dims.REGIONS, language), F.lit(dims.DEFAULT_REGION)).alias("regionCode"),
        language.alias("relevanceLanguage"),
        F.lit("relevance").alias("order"),
    )
