"""The song and action tables, derived from the given tables. One SQL text serves both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.chunks import partitions

SONGS = """
SELECT CAST(p_partkey AS {text}) AS song_id, p_name AS title, p_brand AS artist_name, p_type AS album_name,
       CAST(1960 + p_partkey % 60 AS INT) AS year,
       p_size / CAST(50.0 AS DOUBLE) AS artist_hotttnesss,
       d AS danceability, q AS duration, t AS energy,
       p_retailprice / CAST(100.0 AS DOUBLE) AS loudness,
       CAST(p_size % 2 AS INT) AS mode,
       x / CAST(1000.0 AS DOUBLE) AS tempo,
       CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE d * 10 END AS song_hotttnesss
FROM {part} JOIN (SELECT l_partkey, AVG(l_quantity) q, AVG(l_discount) d, AVG(l_tax) t, AVG(l_extendedprice) x
                  FROM {lineitem} GROUP BY l_partkey) f ON p_partkey = l_partkey
"""
ACTIONS = """
SELECT CAST(o_custkey AS {text}) AS user_id, CAST(l_partkey AS {text}) AS song_id,
       CASE WHEN l_returnflag = 'R' THEN 'skipped' ELSE 'listened' END AS action_type,
       CAST(l_shipdate AS TIMESTAMP) AS action_time,
       CASE WHEN l_returnflag = 'R' THEN CAST(0.0 AS DOUBLE) ELSE FLOOR(l_quantity / 5) / 2 END AS rating
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def songs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        SONGS.replace("{text}", "STRING"),
        # Both sides are shuffled: by the size of its file a large table may look small, and a broadcast passes the driver.
        part=table(spark, folder, "part").hint("merge"), lineitem=table(spark, folder, "lineitem"),
    )


def filled_songs(spark: SparkSession, folder: str) -> DataFrame:
    """Songs with the missing song_hotttnesss filled: it is ten times danceability wherever present."""
    return filled(songs(spark, folder))


def filled(songs: DataFrame) -> DataFrame:
    return songs.withColumn("song_hotttnesss", F.coalesce("song_hotttnesss", F.col("danceability") * 10))


def actions(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(
        ACTIONS.replace("{text}", "STRING"),
        lineitem=table(spark, folder, "lineitem"), orders=table(spark, folder, "orders").hint("merge"),
    )


def duck(sql: str) -> str:
    return sql.format(text="VARCHAR", part="part", lineitem="lineitem", orders="orders")


SONGS_CTE = f"songs AS ({duck(SONGS)})"
FILLED_CTE = (
    SONGS_CTE + ",\nfilled AS (SELECT * REPLACE (COALESCE(song_hotttnesss, danceability * 10) AS song_hotttnesss) FROM songs)"
)
ACTIONS_CTE = f"actions AS ({duck(ACTIONS)})"

# Action records as JSON text, one per event. Ten in sixteen differ from the plain form, so that each
# decoding rule meets rows it accepts and rows it rejects.
RECORD_PARTS = """
    event_id, CAST(user_id AS {text}) AS u, {song} AS s,
    CAST(ROUND(LEAST(value, 250) / 25) / 2 AS {text}) AS r,
    CASE WHEN event_type IN ('error', 'signup') THEN 'skipped' ELSE 'listened' END AS a,
    CAST({millis} AS {text}) AS ms
"""
RECORD = """
CASE event_id % 16
    WHEN 6 THEN concat('{"userId":"', u, '","songId":"', s, '","rating":"', r, '","action":"', a, '","timestamp":"', ms, '"}')
    WHEN 7 THEN concat('{"userId":"', u, '","songId":"', s, '","rating":"', r, '","action":"', a, '","timestamp":', ms, ',"page":[1,{}]}')
    WHEN 8 THEN concat('{"songId":"', s, '","rating":"', r, '","action":"', a, '","timestamp":', ms, '}')
    WHEN 9 THEN concat('{"userId":null,"songId":"', s, '","rating":"', r, '","action":"', a, '","timestamp":', ms, '}')
    WHEN 10 THEN concat('{"userId":', u, ',"songId":"', s, '","rating":"', r, '","action":"', a, '","timestamp":', ms, '}')
    WHEN 11 THEN concat('{"userId":"', u, '","songId":"', s, '","rating":"","action":"', a, '","timestamp":', ms, '}')
    WHEN 12 THEN concat('{"userId":"', u, '","songId":"', s, '","rating":null,"action":"', a, '","timestamp":', ms, '}')
    WHEN 13 THEN concat('{"userId":"', u, '","songId":"', s, '","rating":', r, ',"action":"', a, '","timestamp":', ms, '}')
    WHEN 14 THEN concat('{"userId":"', u, '","songId":"', s, '","rating":"', r, '","action":"', a)
    WHEN 15 THEN concat('{"userId":"', u, '","songId":"', s, '","rating":"', r, '","action":"', a, '","timestamp":', ms, '.0}')
    ELSE concat('{"userId":"', u, '","songId":"', s, '","rating":"', r, '","action":"', a, '","timestamp":', ms, '}')
END AS value
"""


def records(spark: SparkSession, folder: str) -> DataFrame:
    parts = RECORD_PARTS.format(
        text="STRING", song="get_json_object(props, '$.k')",
        millis="timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)",
    )
    events = table(spark, folder, "events")
    events.createOrReplaceTempView("encore_events")
    return spark.sql(f"SELECT event_id, {RECORD} FROM (SELECT {parts} FROM encore_events) e")


RECORDS_CTE = "records AS (SELECT event_id, {} FROM (SELECT {} FROM events) e)".format(
    RECORD, RECORD_PARTS.format(text="VARCHAR", song="json_extract_string(props, '$.k')", millis="epoch_us(ts) // 1000")
)

# Means of decimal numbers often lie exactly on a rounding tie, where the last bit of a sum would decide.
# Both engines add this before they round to six places, which moves such ties off the boundary.
OFF_TIE = "0.00000002"

# Songs whose features are whole numbers of either sign, zero or null: many equal similarities, opposite vectors, vectors
# without length.
SIGNED = """
SELECT song_id, title, artist_name, album_name, year,
       CAST(CASE WHEN n % 11 = 0 THEN 0 ELSE n * 7 % 5 - 2 END AS DOUBLE) AS danceability,
       CAST(CASE WHEN n % 11 = 0 THEN 0 WHEN n % 17 = 0 THEN NULL ELSE n % 7 - 3 END AS DOUBLE) AS energy,
       CAST(CASE WHEN n % 11 = 0 THEN 0 WHEN n % 19 = 0 THEN NULL ELSE year - 1990 END AS DOUBLE) AS tempo
FROM (SELECT *, CAST(song_id AS INT) AS n FROM {songs}) numbered
"""
SIGNED_FEATURES = ["danceability", "energy", "tempo"]


def signed_songs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(SIGNED, songs=songs(spark, folder))


SIGNED_CTE = f"signed_songs AS ({SIGNED.format(songs='songs')})"

# Songs with a label that is no linear function of the features, and gaps in it and in another column.
NOISY = """
SELECT *, CAST(n % 23 AS DOUBLE) / 3 + energy * 4 - danceability * danceability + year % 6 AS whole,
       CASE WHEN n % 4 = 1 THEN NULL ELSE CAST(n % 23 AS DOUBLE) / 3 + energy * 4 - danceability * danceability + year % 6 END AS label,
       CASE WHEN n % 9 = 2 THEN NULL ELSE n END AS other
FROM (SELECT *, CAST(song_id AS INT) AS n FROM {songs}) numbered
"""


def noisy_songs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(NOISY, songs=songs(spark, folder)).drop("n", "whole")


NOISY_CTE = f"noisy AS ({NOISY.format(songs='songs')})"


def full_record(number: str, fields, text: str, double: str, array: str) -> dict[str, str]:
    """SQL of a value for every field of a schema, from a whole number."""
    values = {}
    for place, field in enumerate(fields):
        kind = field.dataType.simpleString()
        whole, half = f"({number} * 10 + {place})", f"CAST({number} + {place} + 0.5 AS {double})"
        name = f"concat('{field.name} ', CAST({number} AS {text}))"
        values[field.name] = {
            "string": name, "int": f"CAST({whole} AS INT)", "bigint": f"CAST({whole} AS BIGINT)", "double": half,
            "array<string>": f"{array[0]}{name}, 'é{place}'{array[1]}", "array<bigint>": f"{array[0]}CAST({whole} AS BIGINT), CAST({place} AS BIGINT){array[1]}",
            "array<double>": f"{array[0]}{half}, CAST(0.25 AS {double}){array[1]}",
            "array<array<double>>": f"{array[0]}{array[0]}{half}, CAST(1.5 AS {double}){array[1]}, {array[0]}CAST(2.5 AS {double}), {half}{array[1]}{array[1]}",
        }[kind]
    return values


def write_each(records: DataFrame, column: str, path: str) -> None:
    """One text file per value of `column`. The number of tasks is given, else adaptive execution would see few bytes and let
    one task write all files. Tasks put their files in place themselves: the driver would move folder by folder."""
    spread = records.repartition(partitions(records.sparkSession), column)
    spread.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(column).text(path)
