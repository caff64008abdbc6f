"""Column names and types of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, orders and types of the stored data formats.
# ---------------------------------------------------------------------------

RAW_SONG_DDL = """
    analysis_sample_rate double,
    artist_7digitalid bigint,
    artist_familiarity double,
    artist_hotttnesss double,
    artist_id string,
    artist_latitude double,
    artist_location string,
    artist_longitude double,
    artist_mbid string,
    artist_mbtags array<string>,
    artist_mbtags_count array<bigint>,
    artist_name string,
    artist_playmeid bigint,
    artist_terms array<string>,
    artist_terms_freq array<double>,
    artist_terms_weight array<double>,
    audio_md5 string,
    bars_confidence array<double>,
    bars_start array<double>,
    beats_confidence array<double>,
    beats_start array<double>,
    danceability double,
    duration double,
    end_of_fade_in double,
    energy double,
    key int,
    key_confidence double,
    loudness double,
    mode int,
    mode_confidence double,
    release string,
    release_7digitalid bigint,
    sections_confidence array<double>,
    sections_start array<double>,
    segments_confidence array<double>,
    segments_loudness_max array<double>,
    segments_loudness_max_time array<double>,
    segments_loudness_start array<double>,
    segments_pitches array<array<double>>,
    segments_start array<double>,
    segments_timbre array<array<double>>,
    similar_artists array<string>,
    song_hotttnesss double,
    song_id string,
    start_of_fade_out double,
    tatums_confidence array<double>,
    tatums_start array<double>,
    tempo double,
    time_signature int,
    time_signature_confidence double,
    title string,
    track_id string,
    track_7digitalid bigint,
    year int
"""

# Columns the clean song table leaves out. The two imputed columns come back, filled, at its end.
DROPPED_SONG_COLUMNS = """
    analysis_sample_rate artist_7digitalid artist_familiarity artist_latitude artist_location
    artist_longitude artist_mbid artist_mbtags artist_mbtags_count artist_playmeid audio_md5
    bars_confidence bars_start beats_confidence beats_start end_of_fade_in release_7digitalid
    sections_confidence sections_start song_hotttnesss start_of_fade_out track_7digitalid
""".split()
IMPUTED_SONG_COLUMNS = ["artist_familiarity", "song_hotttnesss"]
RENAMED_SONG_COLUMNS = {"release": "album_name"}

# Predictors of both imputed columns.
IMPUTE_FEATURES = ["artist_hotttnesss", "year", "danceability", "energy", "loudness", "tempo"]
# Song vector of the daily content job.
BATCH_FEATURES = [
    "artist_hotttnesss", "danceability", "duration", "energy", "loudness", "tempo", "song_hotttnesss",
]
# Song vector of the live job.
LIVE_FEATURES = ["danceability", "duration", "energy", "loudness", "mode", "tempo"]

USER_ACTION_DDL = """
    user_id string, song_id string, action_type string, action_time timestamp, rating double
"""
ACTION_JSON_FIELDS = ["userId", "songId", "rating", "action", "timestamp"]
RECOMMENDATION_DDL = """
    row_key string, song_name string, artist_name string, album_name string, year string
"""
KEY_SEPARATOR = "#"
LISTENED, SKIPPED = "listened", "skipped"
MIN_LIKED_RATING = 3.5
POPULARITY_WEIGHTS = {"song_hotttnesss": 0.7, "artist_hotttnesss": 0.3}
POPULAR_SONGS = 100
SONGS_PER_USER = 10
ALS_ITERATIONS, ALS_REGULARISATION = 10, 0.1
SONG_BUCKETS = 50
ALS_BLOCKS = 24

# ---------------------------------------------------------------------------

_SCALARS = {
    "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _type(text: str) -> T.DataType:
    return T.ArrayType(_type(text[6:-1])) if text.startswith("array<") else _SCALARS[text]


def _schema(columns: str) -> T.StructType:
    """StructType.fromDDL needs a running session; these lists must be readable without one."""
    return T.StructType([T.StructField(name, _type(kind)) for name, kind in map(str.split, columns.split(","))])


RAW_SONG = _schema(RAW_SONG_DDL)
USER_ACTION = _schema(USER_ACTION_DDL)
RECOMMENDATION = _schema(RECOMMENDATION_DDL)
METADATA_COLUMNS = ["title", "artist_name", "album_name", "year"]


def _clean_song_schema() -> T.StructType:
    kept = [
        T.StructField(RENAMED_SONG_COLUMNS.get(f.name, f.name), f.dataType)
        for f in RAW_SONG
        if f.name not in DROPPED_SONG_COLUMNS
    ]
    return T.StructType(kept + [T.StructField(c, T.DoubleType()) for c in IMPUTED_SONG_COLUMNS])


CLEAN_SONG = _clean_song_schema()
