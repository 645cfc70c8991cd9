"""From cleaned requests to playlists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempera import dims
from tempera.operators.lookup import Lookup
from tempera.operators.recommend import choose_primary, recommend_genres
from tempera.operators.retrieve import fallback_stages, playlists, track_pools

SEED = "7"
WISH = ["mood", "language", "genre"]


def staged_requests(requests: DataFrame, learned: Lookup, cells: Lookup) -> DataFrame:
    """Requests with their genres and the tracks of each search stage."""
    return fallback_stages(choose_primary(recommend_genres(requests, learned)), cells)


def once_per_wish(requests: DataFrame, answer: Callable[[DataFrame], DataFrame]) -> Lookup:
    """``answer`` of every distinct (mood, language, genre) that is asked for.

    Genres, searches and the stage rule depend on nothing else, so they run once per wish
    and not once per request.
    """
    return Lookup(answer(requests.select(*WISH).distinct()))


def grant(requests: DataFrame, answers: Lookup, *columns: str, how: str = "inner") -> DataFrame:
    """Requests with ``columns`` of the answer to their wish: one lookup per request.

    The requests are not shuffled while the table of answers is small.
    """
    return answers.join(requests, {w: w for w in WISH}, {c: c for c in columns}, how)


def answer_wishes(requests: DataFrame, learned: Lookup, cells: Lookup) -> Lookup:
    """The track pool of every wish for which some track was found."""

    def pools(wishes: DataFrame) -> DataFrame:
        found = track_pools(staged_requests(wishes, learned, cells))
        length = F.least(F.size("pool"), F.lit(dims.PLAYLIST_LENGTH)).alias("n_tracks")
        return found.select(*WISH, "recommended", "primary_genre", "pool", length)

    return once_per_wish(requests, pools)


def serve(requests: DataFrame, pools: Lookup, request: str, seed: str = SEED) -> DataFrame:
    """Requests for which some track was found, with their playlist.

    ``request`` names the column that identifies a request.
    """
    return playlists(grant(requests, pools, "recommended", "primary_genre", "pool"), request, seed)
