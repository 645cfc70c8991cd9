"""The registered queries in the SQL of another engine, for checking."""

from __future__ import annotations

import re

from tempera import dims
from tempera.plans.queries import AS_OF, LEARNED_AT_FIRST, THROTTLE_GAP_SECONDS
from tempera.plans.serve import SEED
from tempera.sources.views import EMOTION_ORDER, MOOD_OF_EVENT


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _case(column: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(
        f"WHEN {_text(k)} THEN {_list(v) if isinstance(v, list) else _text(v)}" for k, v in mapping.items()
    )
    return f"CASE {column} {arms} ELSE {default} END"


IDENTITY = f"concat_ws('|', '{SEED}', event_id)"
GENRES, CODES, NAMES = _list(dims.GENRES), _list(list(dims.LANGUAGES.values())), _list(list(dims.LANGUAGES))

# Common table expressions in order of use; a query takes all of them, unused ones cost nothing.
CTES = {
    "ev": """SELECT event_id, ts, user_id, event_type, value,
                    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "actions": f"""SELECT event_id, ts, user_id,
        CASE WHEN event_id % 20 = 0 THEN 'heartbeat' ELSE 'mood_update' END AS action,
        {_case("event_type", MOOD_OF_EVENT)} AS mood,
        least(value, 100.0) AS confidence,
        {CODES}[1 + user_id % 14] AS language,
        {NAMES}[1 + user_id % 14] AS language_name,
        CASE WHEN k < 50 THEN 'Any Genre' WHEN k = 99 THEN '' ELSE {GENRES}[1 + k % 16] END AS genre,
        event_id % 9 = 0 AS manual
        FROM ev""",
    "req": """SELECT * REPLACE (CASE WHEN genre = '' THEN 'Any Genre' ELSE genre END AS genre)
              FROM actions WHERE action = 'mood_update'""",
    "log": f"""SELECT mood, confidence, language, ts AS action_time, CASE WHEN genre <> 'Any Genre' THEN genre
               ELSE {_case("mood", {m: g[0] for m, g in dims.DEFAULT_GENRES.items()}, _text(dims.FALLBACK_GENRES[0]))}
               END AS genre FROM req""",
    "scores": """SELECT mood, genre, round(round(avg(confidence), 8), 4) AS avg_confidence,
                 count(*) AS interaction_count, round(round(avg(confidence) * count(*), 8), 4) AS score
                 FROM log GROUP BY mood, genre""",
    "learned": f"""SELECT mood, list(genre ORDER BY score DESC, genre)[1:{dims.TOP_GENRES}] AS learned
                   FROM scores GROUP BY mood""",
    "rec": f"""SELECT req.*, coalesce(learned, {_case("req.mood", dims.DEFAULT_GENRES, _list(dims.FALLBACK_GENRES))})
               AS recommended FROM req LEFT JOIN learned USING (mood)""",
    "prim": """SELECT *, CASE WHEN genre = 'Any Genre' THEN recommended[1] ELSE genre END AS primary_genre
               FROM rec""",
    "tracks": f"""SELECT 'v' || p_partkey AS video_id, p_name AS title, p_brand AS artist,
                  {GENRES}[1 + p_size % 16] AS genre, {CODES}[1 + p_partkey % 14] AS language,
                  p_retailprice AS relevance FROM part""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY language, genre
                 ORDER BY relevance DESC, video_id) AS rank FROM tracks""",
    "counts": """SELECT language, genre, count(*) AS n FROM tracks GROUP BY language, genre""",
    "found": f"""SELECT prim.*,
        least(coalesce(a.n, 0), {dims.PRIMARY_LIMIT}) AS n_1,
        CASE WHEN least(coalesce(a.n, 0), {dims.PRIMARY_LIMIT}) < {dims.PLAYLIST_LENGTH}
             THEN least(coalesce(b.n, 0), {dims.ALTERNATE_LIMIT}) ELSE 0 END AS n_2,
        least(coalesce(c.n, 0), {dims.ALTERNATE_LIMIT}) AS third
        FROM prim
        LEFT JOIN counts a ON a.language = prim.language AND a.genre = prim.primary_genre
        LEFT JOIN counts b ON b.language = prim.language AND b.genre = prim.recommended[2]
        LEFT JOIN counts c ON c.language = prim.language AND c.genre = prim.recommended[3]""",
    "staged": f"""SELECT * EXCLUDE (third),
        CASE WHEN n_1 + n_2 < {dims.PLAYLIST_LENGTH} THEN third ELSE 0 END AS n_3 FROM found""",
    "pool": """SELECT s.event_id, 1 AS stage, t.* FROM staged s JOIN ranked t
          ON t.language = s.language AND t.genre = s.primary_genre AND t.rank <= s.n_1
        UNION ALL SELECT s.event_id, 2, t.* FROM staged s JOIN ranked t
          ON t.language = s.language AND t.genre = s.recommended[2] AND t.rank <= s.n_2
        UNION ALL SELECT s.event_id, 3, t.* FROM staged s JOIN ranked t
          ON t.language = s.language AND t.genre = s.recommended[3] AND t.rank <= s.n_3""",
    "mixed_up": f"""SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY
        md5({IDENTITY} || '|' || stage || '|' || video_id), stage, rank) AS position FROM pool""",
    "chosen": f"SELECT * FROM mixed_up WHERE position <= {dims.PLAYLIST_LENGTH}",
    "lists": """SELECT event_id, count(*) AS n_tracks,
        string_agg(video_id, '|' ORDER BY position) AS video_ids,
        string_agg(title, '|' ORDER BY position) AS titles,
        string_agg(artist, '|' ORDER BY position) AS artists,
        string_agg('https://www.youtube.com/watch?v=' || video_id, '|' ORDER BY position) AS links
        FROM chosen GROUP BY event_id""",
    "served": "SELECT prim.*, lists.* EXCLUDE (event_id) FROM prim JOIN lists USING (event_id)",
    "readings": f"""SELECT event_id, user_id, ts, {_case("event_type", MOOD_OF_EVENT)} AS mood,
                    event_id % 9 = 0 AS manual FROM events""",
    "resets": "SELECT event_id, user_id, ts FROM ev WHERE event_type = 'error' AND k < 5",
    "changes": f"""SELECT event_id, user_id, ts, {GENRES}[1 + k % 16] AS genre,
                   CASE WHEN k % 2 = 0 THEN {NAMES}[1 + k % 14] END AS language_name
                   FROM ev WHERE event_type = 'signup'""",
    "clicks": "SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'",
    "preferred": """SELECT c.event_id, c.user_id, c.ts,
        coalesce(l.language_name, 'English') AS language_name, coalesce(g.genre, 'Any Genre') AS genre
        FROM clicks c
        ASOF LEFT JOIN changes g ON c.user_id = g.user_id AND c.ts >= g.ts
        ASOF LEFT JOIN (SELECT * FROM changes WHERE language_name IS NOT NULL) l
          ON c.user_id = l.user_id AND c.ts >= l.ts""",
    "links": """SELECT *, CASE p_partkey % 4
        WHEN 0 THEN 'https://www.youtube.com/watch?v=v' || p_partkey || '&t=1'
        WHEN 1 THEN 'https://youtu.be/v' || p_partkey || '?t=1'
        WHEN 2 THEN 'https://example.com/' || p_partkey END AS url FROM part""",
    "shown": """SELECT p_partkey // 4 AS playlist_id, p_partkey AS k,
        row_number() OVER (PARTITION BY p_partkey // 4 ORDER BY p_partkey) AS position,
        CASE WHEN p_partkey % 3 <> 0 OR p_partkey % 6 = 0 THEN p_name END AS title,
        CASE WHEN p_partkey % 5 <> 0 OR p_partkey % 10 = 0 THEN p_brand END AS artist,
        CASE WHEN p_partkey % 8 = 3 THEN 'https://youtu.be/w' || p_partkey ELSE url END AS url FROM links""",
}


def _runs(source: str) -> str:
    """Table expressions that number the equal moods in a row of each user."""
    return f"""starts AS (SELECT *, CASE WHEN lag(mood) OVER w IS DISTINCT FROM mood THEN 1 ELSE 0 END AS starts
          FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        islands AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id
          ROWS UNBOUNDED PRECEDING) AS island FROM starts),
        runs AS (SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id)
          AS run_position FROM islands)"""


_SENT = f"""{_runs("(SELECT * FROM readings WHERE NOT manual)")},
    setters AS (SELECT event_id, user_id, ts, mood, manual FROM runs WHERE run_position >= {dims.DEBOUNCE_COUNT}
      UNION ALL SELECT event_id, user_id, ts, mood, manual FROM readings WHERE manual),
    sent AS (SELECT * FROM setters QUALIFY manual OR lag(mood) OVER
      (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM mood)"""

_LATEST = "SELECT * FROM served QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


_SINCE_RESET = "LEFT JOIN last_reset z ON z.user_id = x.user_id", "reset IS NULL OR x.ts > reset"


def _sessions(fresh_join: str, fresh: str) -> str:
    """Table expressions that end in ``sessions``, the counters of each user."""

    def kept(rows: str) -> str:
        return f"SELECT x.* FROM {rows} x {fresh_join} WHERE {fresh}"

    return f"""{_SENT},
      last_reset AS (SELECT user_id, max(ts) AS reset FROM resets GROUP BY user_id),
      d AS (SELECT user_id, count(*) AS n FROM ({kept("(SELECT * FROM readings WHERE NOT manual)")}) GROUP BY user_id),
      s AS (SELECT user_id, count(*) AS n FROM ({kept("sent")}) GROUP BY user_id),
      p AS (SELECT user_id, arg_max(n_tracks, ts) AS n FROM ({kept("served")}) GROUP BY user_id),
      t AS (SELECT user_id, max(ts) AS last_reading FROM readings WHERE NOT manual GROUP BY user_id),
      told AS (SELECT user_id, array_to_string(list(mood ORDER BY ts, event_id)[-{dims.HISTORY_LENGTH}:], '|') AS history
        FROM ({kept("(SELECT * FROM readings WHERE NOT manual)")}) GROUP BY user_id),
      u AS (SELECT user_id FROM t UNION SELECT user_id FROM s UNION SELECT user_id FROM p),
      sessions AS (SELECT u.user_id, substr(CAST(u.user_id AS VARCHAR), 1, 12) AS user_label,
      coalesce(d.n, 0) AS detections, coalesce(s.n, 0) AS sends, coalesce(p.n, 0) AS tracks_in_queue,
      last_reading, date_sub('second', last_reading, TIMESTAMP '{AS_OF}') AS seconds_since_reading
    FROM u LEFT JOIN d USING (user_id) LEFT JOIN s USING (user_id) LEFT JOIN p USING (user_id)
      LEFT JOIN t USING (user_id))"""


def _keyword() -> str:
    words = _case("mood", dims.MOOD_KEYWORDS, "[mood]")
    hashed = f"lambda w: md5(concat_ws('|', '{SEED}', event_id, search, w)) || w"
    return f"substr(list_sort(list_transform({words}, {hashed}))[1], 33)"


_RECOMMENDED = "array_to_string(recommended, '|') AS recommended"

# Query text after the common expressions; a leading name continues the list of expressions.
_BODIES = {
    "parse_actions": """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, action, CAST(NULL AS VARCHAR) AS song,
        mood, confidence, language, language_name, genre, manual, ts AS action_time FROM actions""",
    "clean_requests": """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, action, mood, confidence,
        language, language_name, genre, manual FROM req""",
    "rejected_actions": """SELECT event_id, 'not a mood update' AS reason FROM actions
        WHERE action <> 'mood_update'""",
    "genre_scores": "SELECT * FROM scores",
    "genre_scores_map": "SELECT mood, genre, score FROM scores",
    "mood_counts": "SELECT mood, count(*) AS interactions FROM log GROUP BY mood",
    "genre_counts": "SELECT genre, count(*) AS interactions FROM log GROUP BY genre",
    "learning_stats": """SELECT count(*) AS total_interactions, count(DISTINCT mood) AS moods_learned,
        count(DISTINCT genre) AS genres_seen,
        (SELECT mood FROM log GROUP BY mood ORDER BY count(*) DESC, mood LIMIT 1) AS top_mood,
        (SELECT genre FROM log GROUP BY genre ORDER BY count(*) DESC, genre LIMIT 1) AS top_genre FROM log""",
    "top_genres": "SELECT mood, array_to_string(learned, '|') AS learned FROM learned",
    "recommend_genres": f"SELECT event_id, mood, {_RECOMMENDED} FROM rec",
    "recommend_with_defaults": f"""firsts AS (SELECT min(action_time) AS t FROM log GROUP BY mood),
        cut AS (SELECT coalesce(max(t) FILTER (n = {LEARNED_AT_FIRST + 1}), TIMESTAMP '9999-01-01') AS t
          FROM (SELECT t, row_number() OVER (ORDER BY t) AS n FROM firsts)),
        early AS (SELECT mood, list(genre ORDER BY score DESC, genre)[1:{dims.TOP_GENRES}] AS learned FROM
          (SELECT mood, genre, round(round(avg(confidence) * count(*), 8), 4) AS score FROM log, cut
            WHERE action_time < cut.t GROUP BY mood, genre) GROUP BY mood)
        SELECT event_id, req.mood, array_to_string(coalesce(learned,
        {_case("req.mood", dims.DEFAULT_GENRES, _list(dims.FALLBACK_GENRES))}), '|') AS recommended
        FROM req LEFT JOIN early ON req.mood = early.mood""",
    "primary_genre": "SELECT event_id, mood, genre, primary_genre FROM prim",
    "search_phrase": f"""made AS (SELECT *, 1 AS search, primary_genre AS g, {dims.PRIMARY_LIMIT} AS n FROM staged
          UNION ALL SELECT *, 2, recommended[2], {dims.ALTERNATE_LIMIT} FROM staged WHERE n_1 < {dims.PLAYLIST_LENGTH}
          UNION ALL SELECT *, 3, recommended[3], {dims.ALTERNATE_LIMIT} FROM staged WHERE n_1 + n_2 < {dims.PLAYLIST_LENGTH})
        SELECT event_id, search, 'snippet' AS part,
        concat_ws(' ', {_keyword()}, CASE WHEN g NOT IN ('', 'Any Genre') THEN g END,
          CASE WHEN language <> 'en' THEN language_name END, 'songs music') AS q,
        'video' AS "type", '10' AS "videoCategoryId", n AS "maxResults",
        {_case("language", dims.REGIONS, "'US'")} AS "regionCode", language AS "relevanceLanguage",
        'relevance' AS "order" FROM made WHERE g IS NOT NULL""",
    "catalogue_candidates": f"""SELECT event_id, p.language, primary_genre, count(video_id) AS n_candidates,
        coalesce(string_agg(video_id, '|' ORDER BY rank), '') AS video_ids
        FROM prim p LEFT JOIN ranked t ON t.language = p.language AND t.genre = p.primary_genre
          AND t.rank <= {dims.PRIMARY_LIMIT} GROUP BY event_id, p.language, primary_genre""",
    "fallback_stages": "SELECT event_id, primary_genre, n_1, n_2, n_3 FROM staged",
    "playlist_topk": "SELECT event_id, position, stage, video_id FROM chosen",
    "playlist_payload": """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, action AS source, mood, language,
        language_name, genre, confidence, titles, artists, links,
        array_to_string(recommended, '|') AS ml_recommendations FROM served""",
    "log_interactions": """SELECT mood, primary_genre AS genre, confidence, language, ts AS action_time
        FROM served""",
    "dominant_emotion": f"""SELECT vec_id,
        {_list(EMOTION_ORDER)}[list_position(embedding[1:7], list_max(embedding[1:7]))] AS mood,
        CAST(list_max(embedding[1:7]) AS DOUBLE) AS confidence FROM embeddings""",
    "detection_labels": f"""SELECT event_id,
        {_case("mood", dims.MOOD_EMOJI, _text(dims.DEFAULT_EMOJI))} || ' ' || upper(mood) AS label,
        printf('Detected: %s (%.0f%% confidence)', mood, confidence) AS text FROM actions""",
    "throttle_detections": f"""kept AS (
        SELECT user_id, min(ts) AS ts FROM readings GROUP BY user_id
        UNION ALL
        SELECT k.user_id, min(r.ts) FROM kept k JOIN readings r ON r.user_id = k.user_id
          AND r.ts >= k.ts + INTERVAL {int(THROTTLE_GAP_SECONDS)} SECOND GROUP BY k.user_id)
        SELECT event_id, user_id, ts, mood FROM readings JOIN kept USING (user_id, ts)""",
    "mood_runs": f"{_runs('readings')} SELECT event_id, user_id, ts, mood, run_position FROM runs",
    "debounce_moods": f"""{_runs("readings")} SELECT event_id, user_id, ts, mood
        FROM (SELECT * FROM runs WHERE run_position >= {dims.DEBOUNCE_COUNT})
        QUALIFY lag(mood) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM mood""",
    "debounce_with_manual": f"{_SENT} SELECT event_id, user_id, ts, mood, manual FROM sent",
    "asof_preferences": "SELECT * FROM preferred",
    "refresh_requests": f"""seen AS (SELECT event_id, user_id, ts,
          CASE WHEN event_id % 9 = 0 THEN {_list(dims.MOODS)}[1 + k % {len(dims.MOODS)}]
            WHEN event_type = 'error' AND k < 5 THEN NULL ELSE {_case("event_type", MOOD_OF_EVENT)} END AS mood
          FROM ev WHERE event_type <> 'click')
        SELECT c.event_id, c.user_id, c.ts, c.language_name, c.genre, s.mood,
          {dims.MANUAL_CONFIDENCE}::DOUBLE AS confidence, true AS manual
        FROM preferred c ASOF JOIN seen s ON c.user_id = s.user_id AND c.ts >= s.ts WHERE s.mood IS NOT NULL""",
    "manual_requests": f"""SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, 'mood_update' AS action,
        {_list(dims.MOODS)}[1 + k % {len(dims.MOODS)}] AS mood, {dims.MANUAL_CONFIDENCE}::DOUBLE AS confidence,
        {CODES}[1 + k % 14] AS language, {NAMES}[1 + k % 14] AS language_name, {GENRES}[1 + k % 16] AS genre,
        true AS manual, ts AS action_time FROM ev WHERE event_id % 9 = 0 AND event_type <> 'click'""",
    "action_payload": f"""SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, 'mood_update' AS action,
        'happy' AS mood, {dims.MANUAL_CONFIDENCE}::DOUBLE AS confidence,
        {_case("language_name", dims.LANGUAGES)} AS language, language_name, genre, false AS manual,
        ts AS action_time FROM preferred""",
    "mood_history": f"""h AS (SELECT event_id, user_id, list(mood) OVER (PARTITION BY user_id ORDER BY ts, event_id
          ROWS BETWEEN {dims.HISTORY_LENGTH - 1} PRECEDING AND CURRENT ROW) AS history FROM readings)
        SELECT event_id, user_id, array_to_string(history, '|') AS history,
          array_to_string(list_transform(history[-{dims.HISTORY_SHOWN}:],
            lambda m: {_case("m", dims.MOOD_EMOJI, _text(dims.DEFAULT_EMOJI))}), ' → ') AS history_text FROM h""",
    "mood_history_reset": f"""marked AS (SELECT r.event_id, r.user_id, r.ts, r.mood,
          max(z.ts) AS since FROM readings r LEFT JOIN resets z ON z.user_id = r.user_id AND z.ts < r.ts
          GROUP BY r.event_id, r.user_id, r.ts, r.mood),
        h AS (SELECT event_id, user_id, list(mood) OVER (PARTITION BY user_id, since ORDER BY ts, event_id
          ROWS BETWEEN {dims.HISTORY_LENGTH - 1} PRECEDING AND CURRENT ROW) AS history FROM marked)
        SELECT event_id, user_id, array_to_string(history, '|') AS history,
          array_to_string(list_transform(history[-{dims.HISTORY_SHOWN}:],
            lambda m: {_case("m", dims.MOOD_EMOJI, _text(dims.DEFAULT_EMOJI))}), ' → ') AS history_text FROM h""",
    "latest_playlist": f"SELECT user_id, event_id, mood, n_tracks, video_ids FROM ({_LATEST})",
    "user_playlists": """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, mood, language_name, genre, n_tracks
        FROM served WHERE user_id IN (SELECT user_id FROM resets)""",
    "session_stats": f"{_sessions('', 'true')} SELECT * FROM sessions",
    "session_stats_reset": f"{_sessions(*_SINCE_RESET)} SELECT * FROM sessions",
    "search_links": """SELECT p_partkey, 'https://www.youtube.com/results?search_query=' ||
        replace(url_encode(p_name || ' & *~+''é ' || p_brand), '%20', '+') AS link FROM part""",
    "video_ids": """v AS (SELECT p_partkey, url, CASE WHEN p_partkey % 4 < 2 THEN 'v' || p_partkey END AS video_id
          FROM links)
        SELECT *, 'https://www.youtube.com/embed/' || video_id AS embed_url FROM v""",
    "normalise_tracks": """t AS (SELECT playlist_id, position, url, coalesce(title, 'Unknown Track') AS title,
          coalesce(artist, 'Unknown Artist') AS artist FROM shown)
        SELECT playlist_id, position, title, artist, coalesce(url,
          'https://www.youtube.com/results?search_query=' ||
          replace(url_encode(title || ' ' || artist), '%20', '+')) AS link FROM t""",
    "now_playing": """SELECT playlist_id, coalesce(title, 'Unknown') AS title, coalesce(artist, '') AS artist,
        CASE WHEN k % 8 = 3 THEN 'https://www.youtube.com/embed/w' || k
             WHEN k % 4 < 2 THEN 'https://www.youtube.com/embed/v' || k ELSE url END AS play_link
        FROM shown WHERE position = 1""",
    "parse_search_response": f"""SELECT language, genre,
        CASE WHEN p.p_partkey % 7 <> 0 THEN p_name ELSE 'Unknown Title' END AS title, p_brand AS artist,
        'https://www.youtube.com/watch?v=' || video_id AS youtube_url
        FROM tracks JOIN part p ON video_id = 'v' || p_partkey WHERE p_partkey % 5 <> 0""",
}

_WITH = "WITH RECURSIVE " + ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())


def _whole(body: str) -> str:
    starts_query = body.lstrip().upper().startswith("SELECT")
    return f"{_WITH}{'' if starts_query else ','}\n{body}"


BATCH: dict[str, str] = {key: _whole(body) for key, body in _BODIES.items()}


# --- streams ------------------------------------------------------------------------------

_PER_BATCH = "req log scores learned rec prim found staged pool mixed_up chosen lists served".split()


def _unrolled(edges: list[str]) -> str:
    """Serving batch by batch: each learns from what the batches before it served."""
    shared = [n for n in CTES if n not in _PER_BATCH]
    at = shared.index("actions") + 1
    ctes = [f"{n} AS ({CTES[n]})" for n in [*shared[:at], "req", *shared[at:]]]
    bounds = ["TIMESTAMP '1900-01-01'", *[f"TIMESTAMP '{e}'" for e in edges], "TIMESTAMP '9999-01-01'"]
    for k, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        logged = [f"SELECT mood, primary_genre AS genre, confidence FROM served_{j}" for j in range(k)]
        nothing = "SELECT mood, genre, confidence FROM req WHERE false"
        ctes.append(f"req_{k} AS (SELECT * FROM req WHERE ts >= {low} AND ts < {high})")
        ctes.append(f"log_{k} AS ({' UNION ALL '.join(logged) or nothing})")
        for name in _PER_BATCH[2:]:
            body = CTES[name]
            for other in _PER_BATCH:
                body = re.sub(rf"\b{other}\b", f"{other}_{k}", body)
            ctes.append(f"{name}_{k} AS ({body})")
    rows = [
        f"""SELECT CAST(event_id AS VARCHAR) AS request, CAST(user_id AS VARCHAR) AS user_id, mood, genre, n_tracks, links,
            array_to_string(recommended, '|') AS ml_recommendations FROM served_{k}"""
        for k in range(len(edges) + 1)
    ]
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(rows)


def stream_serve(edges: list[str]) -> str:
    return _unrolled(edges)


def stream_session() -> str:
    """The counters of the session statistics with resets, and the last moods since the reset."""
    return _whole(f"""{_sessions(*_SINCE_RESET)}
        SELECT user_id, detections, sends, coalesce(history, '') AS history, last_reading
        FROM sessions LEFT JOIN told USING (user_id)""")


def stream_stats(edges: list[str], every: int = dims.STATS_EVERY) -> str:
    """The reports of every ``every``-th batch: statistics so far, its number and its rows."""
    bounds = ["1900-01-01", *edges, "9999-01-01"]
    reports = []
    for batch in range(every - 1, len(edges) + 1, every):
        low, high = bounds[batch], bounds[batch + 1]
        so_far = f"(SELECT * FROM log WHERE action_time < TIMESTAMP '{high}')"
        reports.append(f"""SELECT count(*) AS total_interactions, count(DISTINCT mood) AS moods_learned,
            count(DISTINCT genre) AS genres_seen,
            (SELECT mood FROM {so_far} GROUP BY mood ORDER BY count(*) DESC, mood LIMIT 1) AS top_mood,
            (SELECT genre FROM {so_far} GROUP BY genre ORDER BY count(*) DESC, genre LIMIT 1) AS top_genre,
            count(*) FILTER (action_time >= TIMESTAMP '{low}') AS batch_rows, {batch}::BIGINT AS batch_id FROM {so_far}""")
    return _whole(" UNION ALL ".join(reports))
