"""DuckDB SQL that gives the same rows as the Spark query of the same name."""

from __future__ import annotations

from encore.schemas import BATCH_FEATURES, IMPUTE_FEATURES, LIVE_FEATURES, POPULARITY_WEIGHTS, RAW_SONG
from queries.spark_queries import FEED_USER
from queries.views import ACTIONS_CTE, FILLED_CTE, NOISY_CTE, OFF_TIE, RECORDS_CTE, SIGNED_CTE, SIGNED_FEATURES, SONGS_CTE, full_record

DETAILS = "title, artist_name, album_name, year"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _dot(left: str, right: str, features: list[str]) -> str:
    return "(" + " + ".join(f"{left}.{c} * {right}.{c}" for c in features) + ")"


def _cosine(left: str, right: str, features: list[str]) -> str:
    lengths = f"(sqrt({_dot(left, left, features)}) * sqrt({_dot(right, right, features)}))"
    return f"CASE WHEN {lengths} <> 0 THEN {_dot(left, right, features)} / {lengths} ELSE 0.0 END"


def _means(features: list[str]) -> str:
    return ", ".join(f"AVG({c}) AS {c}" for c in features)


def _six(expression: str) -> str:
    return f"round({expression} + {OFF_TIE}::DOUBLE, 6)"


def _round(columns: list[str]) -> str:
    return ", ".join(f"{_six(c)} AS {c}" for c in columns)


PROFILES_CTE = f"""profiles AS (
    SELECT user_id, {_means(BATCH_FEATURES)} FROM actions JOIN filled USING (song_id)
    WHERE rating >= 3.5 GROUP BY user_id)"""

CONTENT_CTES = (FILLED_CTE, ACTIONS_CTE, PROFILES_CTE, f"""content AS (
    SELECT user_id, song_id, similarity,
           row_number() OVER (PARTITION BY user_id ORDER BY round(similarity, 9) DESC, song_id) AS rank
    FROM (SELECT p.user_id, s.song_id, {_cosine("p", "s", BATCH_FEATURES)} AS similarity FROM profiles p, filled s)
    WHERE similarity > 0 QUALIFY rank <= 10)""")


def _live_ctes(actions: str) -> tuple[str, ...]:
    return (f"""catalogue AS (
    SELECT song_id, {DETAILS}, {", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in LIVE_FEATURES)} FROM songs)""",
            f"played AS (SELECT user_id, song_id FROM {actions} WHERE action_type = 'listened')",
            f"""live_profiles AS (
    SELECT user_id, {_means(LIVE_FEATURES)} FROM played JOIN catalogue USING (song_id)
    WHERE user_id IS NOT NULL GROUP BY user_id)""", f"""live AS (
    SELECT user_id, song_id, similarity,
           row_number() OVER (PARTITION BY user_id ORDER BY round(similarity, 9) DESC, song_id) AS rank
    FROM (SELECT p.user_id, s.song_id, {_cosine("p", "s", LIVE_FEATURES)} AS similarity
          FROM live_profiles p, catalogue s) pairs
    WHERE NOT EXISTS (SELECT 1 FROM played WHERE played.user_id = pairs.user_id AND played.song_id = pairs.song_id)
    QUALIFY rank <= 10)""")


def _matches(table: str) -> str:
    return (f"SELECT song_id, user_id, round(similarity, 9) AS similarity, CAST(rank AS INT) AS rank, {DETAILS} "
            f"FROM {table} JOIN songs USING (song_id)")


def _recs(table: str) -> str:
    return (f"SELECT concat(user_id, '#', song_id) AS row_key, title AS song_name, artist_name, album_name, "
            f"CAST(year AS VARCHAR) AS year FROM {table} JOIN songs USING (song_id)")


POPULAR_CTE = f"""popular AS (
    SELECT song_id, {DETAILS}, {" + ".join(f"{c} * {w}::DOUBLE" for c, w in POPULARITY_WEIGHTS.items())} AS popularity_score
    FROM songs WHERE {" AND ".join(f"{c} IS NOT NULL" for c in POPULARITY_WEIGHTS)}
    ORDER BY popularity_score DESC, song_id LIMIT 100)"""
POPULAR_RECS = ("SELECT song_id AS row_key, title AS song_name, artist_name, album_name, CAST(year AS VARCHAR) AS year "
                "FROM popular")

PARSED_CTES = (RECORDS_CTE, """fields AS (
    SELECT event_id, value, j,
           json_type(j, '$.userId') AS ut, json_type(j, '$.songId') AS st, json_type(j, '$.action') AS kind,
           json_type(j, '$.rating') AS rt, json_type(j, '$.timestamp') AS tt,
           json_extract_string(j, '$.rating') AS r, json_extract_string(j, '$.timestamp') AS t
    FROM (SELECT event_id, value, CASE WHEN json_valid(value) THEN value END AS j FROM records))""", """parsed AS (
    SELECT *, COALESCE(
        ut IN ('VARCHAR', 'NULL') AND st IN ('VARCHAR', 'NULL') AND kind IN ('VARCHAR', 'NULL')
        AND rt IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') AND TRY_CAST(r AS DOUBLE) IS NOT NULL
        AND (tt IN ('UBIGINT', 'BIGINT') OR (tt = 'VARCHAR' AND regexp_full_match(t, '[+-]?[0-9]+'))), FALSE) AS accepted,
        CASE WHEN COALESCE(ut, st, kind, rt, tt) IS NULL THEN 'no_record'
             WHEN COALESCE(ut, '') NOT IN ('VARCHAR', 'NULL') THEN 'user' WHEN COALESCE(st, '') NOT IN ('VARCHAR', 'NULL') THEN 'song'
             WHEN COALESCE(kind, '') NOT IN ('VARCHAR', 'NULL') THEN 'action'
             WHEN COALESCE(rt, '') NOT IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') OR TRY_CAST(r AS DOUBLE) IS NULL THEN 'rating'
             ELSE 'timestamp' END AS broken
    FROM fields)""", """sent AS (
    SELECT event_id, json_extract_string(j, '$.userId') AS user_id, json_extract_string(j, '$.songId') AS song_id,
           json_extract_string(j, '$.action') AS action_type, CAST(t AS BIGINT) AS action_ms, CAST(r AS DOUBLE) AS rating
    FROM parsed WHERE accepted)""")

_FREQUENCY = """SELECT {c}, row_number() OVER (ORDER BY n DESC, {c}) - 1 AS {name}
    FROM (SELECT {c}, COUNT(*) AS n FROM {table} GROUP BY {c})"""

_REVERSED = """pairs AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS a, list_reverse(CAST(embedding AS DOUBLE[])) AS b FROM embeddings)"""

_FEEDS = ("""feeds AS (
    SELECT 'content' AS source, user_id, song_id FROM content
    UNION ALL SELECT 'live', user_id, song_id FROM live
    UNION ALL SELECT 'popular', NULL, song_id FROM popular)""")

ORACLE: dict[str, str] = {
    "popularity_topk": _with(SONGS_CTE, POPULAR_CTE, select=(
        f"SELECT song_id, {DETAILS}, {_six('popularity_score')} AS popularity_score FROM popular")),
    "insert_overwrite_orc": _with(SONGS_CTE, POPULAR_CTE, select=POPULAR_RECS),
    "copy_upsert_serving": _with(SONGS_CTE, POPULAR_CTE, select=(
        "SELECT song_id AS row_key, CASE WHEN song_id IN (SELECT song_id FROM popular) THEN upper(title) ELSE title END "
        "AS song_name, artist_name, album_name, CAST(year AS VARCHAR) AS year FROM songs")),
    "high_rated_join": _with(SONGS_CTE, ACTIONS_CTE, select=(
        f"SELECT song_id, user_id, rating, title, {_round(['duration', 'tempo'])} "
        "FROM actions JOIN songs USING (song_id) WHERE rating >= 3.5")),
    "user_profile": _with(FILLED_CTE, ACTIONS_CTE, PROFILES_CTE, select=(
        f"SELECT user_id, {_round(BATCH_FEATURES)} FROM profiles")),
    "cosine_pairs": _with(FILLED_CTE, ACTIONS_CTE, PROFILES_CTE, select=(
        f"SELECT a.user_id, a.song_id, {_six(_cosine('p', 's', BATCH_FEATURES))} AS similarity "
        "FROM actions a JOIN filled s ON a.song_id = s.song_id JOIN profiles p ON a.user_id = p.user_id WHERE a.rating >= 3.5")),
    "cosine_embeddings": f"""
WITH items AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, AVG(x) AS m FROM items GROUP BY label, i)
SELECT vec_id, label, {_six("""CASE WHEN SUM(x * x) * SUM(m * m) > 0
    THEN SUM(x * m) / (sqrt(SUM(x * x)) * sqrt(SUM(m * m))) ELSE 0.0 END""")} AS similarity
FROM items JOIN means USING (label, i) GROUP BY vec_id, label""",
    "vector_functions": _with(_REVERSED, select=f"""
SELECT vec_id, {_six("list_inner_product(a, b)")} AS dot, {_six("sqrt(list_inner_product(a, a))")} AS norm,
       {_six("sqrt(list_inner_product(a, a) + 2 * list_inner_product(a, b) + list_inner_product(b, b))")} AS sum_norm,
       {_six("sqrt(list_inner_product(a, a)) / 4")} AS quarter_norm
FROM pairs"""),
    "sql_cosine_function": _with(_REVERSED, select=(
        f"SELECT vec_id, {_six('list_cosine_similarity(a, b)')} AS similarity FROM pairs")),
    "content_topk": _with(*CONTENT_CTES, select=_matches("content")),
    "content_topk_clustered": _with(*CONTENT_CTES, select=_matches("content")),
    "content_recs": _with(*CONTENT_CTES, select=_recs("content")),
    "freq_index": _with(ACTIONS_CTE, select=_FREQUENCY.format(c="user_id", name="user_index", table="actions")),
    "user_index_join": _with(
        SONGS_CTE, ACTIONS_CTE,
        "users AS (" + _FREQUENCY.format(c="user_id", name="user_index", table="actions") + ")",
        "numbers AS (" + _FREQUENCY.format(c="song_id", name="song_index", table="songs") + ")",
        select="SELECT user_index, song_index, user_id, song_id, title, MAX(rating) AS rating FROM actions "
               "JOIN users USING (user_id) JOIN numbers USING (song_id) JOIN songs USING (song_id) GROUP BY ALL"),
    "explode_recs": _with(
        ACTIONS_CTE, "plays AS (SELECT user_id, song_id, COUNT(*) AS plays FROM actions GROUP BY ALL)",
        """best AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY plays DESC, song_id) AS INT) AS rank
    FROM plays QUALIFY rank <= 10)""",
        """lists AS (SELECT user_id, list({'rank': rank, 'song_id': song_id, 'plays': plays}) AS recs FROM best GROUP BY user_id)""",
        select="SELECT user_id, e.rank AS rank, e.song_id AS song_id, e.plays AS plays "
               "FROM (SELECT user_id, unnest(recs) AS e FROM lists)"),
    "null_profile": _with(SONGS_CTE, select="\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS nulls FROM songs WHERE {c} IS NULL HAVING COUNT(*) > 0"
        for c in ["song_id", "title", "artist_name", "album_name", "year", "artist_hotttnesss", "danceability",
                  "duration", "energy", "loudness", "mode", "tempo", "song_hotttnesss"])),
    "drop_any_null": _with(SONGS_CTE, select=(
        f"SELECT song_id, title, {_round(['song_hotttnesss'])} FROM songs "
        "WHERE COLUMNS(*) IS NOT NULL")),
    "impute_one_feature": _with(SONGS_CTE, """line AS (
    SELECT regr_slope(song_hotttnesss, energy) AS a, regr_intercept(song_hotttnesss, energy) AS b FROM songs)""", select=(
        f"SELECT song_id, {_six('COALESCE(song_hotttnesss, a * energy + b)')} AS song_hotttnesss_filled FROM songs, line")),
    "impute_six_features": _with(FILLED_CTE, select=(
        f"SELECT song_id, {_six('song_hotttnesss')} AS song_hotttnesss_filled FROM filled")),
    # The columns made up from others are exact linear functions of the predictors, so the fit restores them.
    "clean_songs": _with(FILLED_CTE, select=(
        "SELECT song_id, title, artist_name, album_name, year, mode, "
        + _round(["artist_hotttnesss", "danceability", "duration", "energy", "loudness", "tempo", "song_hotttnesss"])
        + f", {_six('energy * 5 + tempo')} AS artist_familiarity FROM filled")),
    "latest_per_key": _with(ACTIONS_CTE, "timed AS (SELECT *, epoch_ms(action_time) AS action_ms FROM actions)", select="""
SELECT user_id, action_ms, song_id, action_type, rating FROM timed
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY action_ms DESC, song_id DESC, action_type DESC, rating DESC) = 1"""),
    "encode_actions": _with(ACTIONS_CTE, select="""
SELECT concat('{"userId":"', user_id, '","songId":"', song_id, '","rating":"', CAST(rating AS VARCHAR), '","action":"',
              action_type, '","timestamp":', epoch_ms(action_time), '}') AS value FROM actions"""),
    "parse_actions": _with(*PARSED_CTES, select="SELECT * FROM sent"),
    "reject_actions": _with(*PARSED_CTES, select="SELECT value, broken AS reason FROM parsed WHERE NOT accepted"),
    "plays_per_user": _with(ACTIONS_CTE, select=(
        "SELECT user_id, song_id, COUNT(*) AS plays FROM actions WHERE action_type = 'listened' GROUP BY ALL")),
    "skipped_not_played": _with(ACTIONS_CTE, select="""
SELECT DISTINCT user_id, song_id FROM actions s WHERE action_type = 'skipped' AND NOT EXISTS (
    SELECT 1 FROM actions l WHERE l.action_type = 'listened' AND l.user_id = s.user_id AND l.song_id = s.song_id)"""),
    "live_profile": _with(SONGS_CTE, ACTIONS_CTE, *_live_ctes("actions"), select=(
        f"SELECT user_id, {_round(LIVE_FEATURES)} FROM live_profiles")),
    "live_topk": _with(SONGS_CTE, ACTIONS_CTE, *_live_ctes("actions"), select=_matches("live")),
    "live_topk_clustered": _with(SONGS_CTE, ACTIONS_CTE, *_live_ctes("actions"), select=_matches("live")),
    "stream_action_lake": _with(*PARSED_CTES, select=(
        "SELECT user_id, song_id, action_type, action_ms, rating FROM sent")),
    "stream_live_recs": _with(SONGS_CTE, *PARSED_CTES, *_live_ctes("sent"), select=_recs("live")),
    "union_feeds": _with(*CONTENT_CTES, *_live_ctes("actions"), POPULAR_CTE, _FEEDS, select=(
        "SELECT source, user_id, song_id, title AS song_name, artist_name, album_name, CAST(year AS VARCHAR) AS year "
        "FROM feeds JOIN songs USING (song_id)")),
    "prefix_feed": _with(*CONTENT_CTES, *_live_ctes("actions"), POPULAR_CTE, _FEEDS, select=(
        f"SELECT source, '{FEED_USER}' AS user_id, song_id, title AS song_name, artist_name, album_name, "
        "CAST(year AS VARCHAR) AS year FROM feeds JOIN songs USING (song_id) "
        f"WHERE user_id = '{FEED_USER}' OR user_id IS NULL")),
    "cells_to_rows": _with(SONGS_CTE, select=(
        "SELECT song_id AS row_key, title AS song_name, artist_name, album_name, CAST(year AS VARCHAR) AS year FROM songs")),
    "record_ingest": f"""
WITH flagged AS (SELECT *, CAST(s_suppkey AS VARCHAR) AS id, (s_acctbal < 0 OR s_suppkey % 12 IN (3, 5, 7, 9)) AS rejected FROM supplier)
SELECT id AS file, rejected, CASE WHEN NOT rejected THEN id END AS song_id,
       CASE WHEN NOT rejected THEN s_name END AS title, CASE WHEN NOT rejected THEN CAST(s_nationkey AS INT) END AS key,
       CASE WHEN NOT rejected THEN {_six('s_acctbal')} END AS tempo,
       CASE WHEN NOT rejected THEN replace(s_name, '#', '|') END AS terms,
       CASE WHEN NOT rejected THEN {_six('s_acctbal + 3.5')} END AS pitches, CAST(NULL AS VARCHAR) AS audio_md5
FROM flagged""",
    "decode_utf8_text": "SELECT conv_id, turn, concat(role, '|', text) AS decoded FROM conversations",
    "partition_bucket_roundtrip": _with(SONGS_CTE, select=(
        f"SELECT song_id, title, CAST(floor(year / 10) AS INT) AS decade, album_name, {_round(['tempo'])} FROM songs")),
}

ORACLE["topk_dot"] = f"""
WITH parts AS (
    SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
), means AS (SELECT label, i, AVG(x) AS m FROM parts GROUP BY label, i),
products AS (SELECT m.label, p.vec_id, SUM(p.x * m.m) AS score FROM parts p JOIN means m USING (i) GROUP BY m.label, p.vec_id)
SELECT label, vec_id, {_six("round(score, 9)")} AS score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(score, 9) DESC, vec_id) AS rank FROM products) ranked
WHERE rank <= 10"""

# Every user who rated a song of the song table is trained and gets ten songs.
ORACLE["als_checks"] = _with(SONGS_CTE, ACTIONS_CTE, select="""
SELECT DISTINCT user_id, 10 AS rows, 10 AS songs, 1 AS first_rank, 10 AS last_rank, 0 AS rises, 0 AS negative, 10 AS known
FROM actions JOIN songs USING (song_id) WHERE user_id IS NOT NULL AND rating IS NOT NULL""")

ORACLE["stream_rejects"] = _with(*PARSED_CTES, select="SELECT value, broken AS reason FROM parsed WHERE NOT accepted")
ORACLE["stream_reject_counts"] = _with(*PARSED_CTES, select="""
SELECT n.reason, COUNT(p.event_id) AS records
FROM (VALUES ('accepted'), ('no_record'), ('user'), ('song'), ('action'), ('rating'), ('timestamp')) n(reason)
LEFT JOIN parsed p ON n.reason = CASE WHEN accepted THEN 'accepted' ELSE broken END GROUP BY n.reason""")
ORACLE["live_to_daily"] = _with(
    CONTENT_CTES[0], *PARSED_CTES, "actions AS (SELECT * FROM sent WHERE user_id IS NOT NULL)", *CONTENT_CTES[2:], select=_matches("content")
)
ORACLE["bucketed_join"] = ORACLE["high_rated_join"]


def _fitted(table: str, label: str, features: list[str], complete: str) -> list[str]:
    """Least squares in SQL: centred sums of products, then Gauss-Jordan elimination with one column per number."""
    names = [*features, label]
    steps = [f"fit AS (SELECT * FROM {table} WHERE {complete})", "centre AS (SELECT " + ", ".join(f"AVG({c}) AS m_{c}" for c in names) + " FROM fit)"]
    size = len(features)
    sums = [f"SUM(({names[i]} - m_{names[i]}) * ({names[j]} - m_{names[j]})) AS e{i}_{j}" for i in range(size) for j in range(size + 1)]
    steps.append("step0 AS (SELECT " + ", ".join(sums) + " FROM fit, centre)")
    for p in range(size):
        cells = []
        for i in range(size):
            for j in range(size + 1):
                own = f"e{p}_{j} / e{p}_{p}"
                cells.append((own if i == p else f"e{i}_{j} - e{i}_{p} * {own}") + f" AS e{i}_{j}")
        steps.append(f"step{p + 1} AS (SELECT " + ", ".join(cells) + f" FROM step{p})")
    return steps


_LINE = " + ".join(f"e{i}_{len(IMPUTE_FEATURES)} * ({c} - m_{c})" for i, c in enumerate(IMPUTE_FEATURES))
ORACLE["impute_noisy_label"] = _with(
    SONGS_CTE, NOISY_CTE, *_fitted("noisy", "label", IMPUTE_FEATURES, "label IS NOT NULL AND other IS NOT NULL"),
    select=f"SELECT song_id, {_six(f'COALESCE(label, m_label + {_LINE})')} AS label_filled FROM noisy, centre, step{len(IMPUTE_FEATURES)}",
)

_SIGNED_ZERO = "zeroed AS (SELECT * REPLACE (" + ", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in SIGNED_FEATURES) + ") FROM signed_songs)"


def _signed(profile_rows: str, condition: str, name: str) -> tuple[str, ...]:
    return (
        f"{name}_profiles AS (SELECT user_id, {_means(SIGNED_FEATURES)} FROM {profile_rows} JOIN zeroed USING (song_id) GROUP BY user_id)",
        f"""{name} AS (SELECT user_id, song_id, similarity,
           row_number() OVER (PARTITION BY user_id ORDER BY round(similarity, 9) DESC, song_id) AS rank
    FROM (SELECT p.user_id, s.song_id, {_cosine("p", "s", SIGNED_FEATURES)} AS similarity FROM {name}_profiles p, zeroed s) pairs
    WHERE {condition} QUALIFY rank <= 10)""",
    )


ORACLE["signed_content_topk"] = _with(
    SONGS_CTE, SIGNED_CTE, _SIGNED_ZERO, ACTIONS_CTE, "liked AS (SELECT user_id, song_id FROM actions WHERE rating >= 3.5)",
    *_signed("liked", "round(similarity, 9) > 0", "content"), select=_matches("content"),
)
ORACLE["signed_live_topk"] = _with(
    SONGS_CTE, SIGNED_CTE, _SIGNED_ZERO, ACTIONS_CTE, "played AS (SELECT user_id, song_id FROM actions WHERE action_type = 'listened')",
    *_signed("played", "NOT EXISTS (SELECT 1 FROM played WHERE played.user_id = pairs.user_id AND played.song_id = pairs.song_id)", "live"),
    select=_matches("live"),
)


def _told(name: str, sql: str, kind: str) -> str:
    if not kind.startswith("array"):
        return f"{sql} AS {name}"
    flat = f"flatten({sql})" if kind.startswith("array<array") else sql
    return f"array_to_string(list_transform({flat}, lambda x: CAST(x AS VARCHAR)), '|') AS {name}"


_RECORD = full_record("s_suppkey", RAW_SONG, "VARCHAR", "DOUBLE", ("[", "]"))
ORACLE["record_ingest_full"] = (
    "SELECT FALSE AS rejected, " + ", ".join(_told(f.name, _RECORD[f.name], f.dataType.simpleString()) for f in RAW_SONG) + " FROM supplier"
)
