"""One Spark query per operator, over the given tables. Names match those in `oracle`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.functions import vectors as vec
from encore.functions.actions import accepted_actions, decode_actions, encode_action, rejected_records
from encore.operators import tables as ops
from encore.operators.catalogue import Catalogue
from encore.operators.impute import impute
from encore.operators.topk import index_items, top_k
from encore.plans import content, feed, live
from encore.plans.collab import als_matches
from encore.plans.popularity import popular_recommendations, popular_songs
from encore.plans.preprocess import preprocess
from encore.schemas import BATCH_FEATURES, IMPUTE_FEATURES, LISTENED, LIVE_FEATURES, METADATA_COLUMNS, RAW_SONG, SKIPPED
from encore.session import prepare
from encore.sinks import catalog, files, lake
from encore.sources.cells import cells_from_rows, rows_from_cells
from encore.sources.records import decode_json, decode_utf8, record_files
from encore.sources.tables import file_actions
from encore.storage import materialize, scratch_path
from encore.streaming.live import LiveTables, start
from queries import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
FEED_USER = "42"
EMBEDDING_DIMS = 64


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder.rstrip("/"))

    QUERIES[function.__name__] = run
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + float(views.OFF_TIE), 6) for c in columns})


def table_name() -> str:
    return f"encore_{uuid.uuid4().hex}"


# -- popularity ------------------------------------------------------------------------------------


@query
def popularity_topk(spark, folder):
    return rounded(popular_songs(views.songs(spark, folder)), "popularity_score")


@query
def insert_overwrite_orc(spark, folder):
    """The popularity result written twice into an ORC table by position: the second write replaces the first."""
    name = table_name()
    catalog.recommendation_table(spark, name, scratch_path(spark, "popular"))
    recommendations = popular_recommendations(views.songs(spark, folder))
    catalog.insert_overwrite(popular_recommendations(views.songs(spark, folder), 5), name)
    catalog.insert_overwrite(recommendations, name)
    return spark.table(name)


@query
def copy_upsert_serving(spark, folder):
    """Songs copied to a keyed table, then the popular ones of them again under a new name."""
    name, serving = table_name(), scratch_path(spark, "serving")
    catalog.recommendation_table(spark, name, scratch_path(spark, "staging"))
    rows = views.songs(spark, folder).select(
        F.col("song_id").alias("row_key"), F.col("title").alias("song_name"), "artist_name", "album_name",
        F.col("year").cast("string").alias("year"),
    )
    catalog.insert_overwrite(rows, name)
    catalog.copy_to_serving(spark, name, serving)
    catalog.insert_overwrite(
        popular_recommendations(views.songs(spark, folder)).withColumn("song_name", F.upper("song_name")), name
    )
    catalog.copy_to_serving(spark, name, serving, mode="upsert", batch=1, version=1)
    return files.read_keyed(spark, serving)


# -- content ---------------------------------------------------------------------------------------


@query
def high_rated_join(spark, folder):
    columns = ["title", "duration", "tempo"]
    liked = content.liked_songs(views.actions(spark, folder), views.songs(spark, folder), columns, 3.5)
    return rounded(liked, "duration", "tempo")


@query
def user_profile(spark, folder):
    profiles = content.user_profiles(views.actions(spark, folder), views.filled_songs(spark, folder))
    return rounded(profiles, *BATCH_FEATURES)


@query
def cosine_pairs(spark, folder):
    """Similarity of every song a user liked to that user's profile."""
    songs = views.filled_songs(spark, folder)
    actions = views.actions(spark, folder)
    liked = content.liked_songs(actions, songs, BATCH_FEATURES, 3.5).drop("rating")
    profiles = content.user_profiles(actions, songs).withColumnsRenamed({c: f"mean_{c}" for c in BATCH_FEATURES})
    similarity = vec.cosine_of([F.col(f"mean_{c}") for c in BATCH_FEATURES], [F.col(c) for c in BATCH_FEATURES])
    pairs = liked.join(profiles, "user_id").select("user_id", "song_id", similarity.alias("similarity"))
    return rounded(pairs, "similarity")


@query
def cosine_embeddings(spark, folder):
    """Similarity of every vector to the mean vector of its label."""
    table = views.table(spark, folder, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    means = vec.mean_array(table, ["label"], "embedding").withColumnRenamed("embedding", "mean")
    pairs = table.join(means, "label")
    return rounded(pairs.select("vec_id", "label", vec.cosine(F.col("embedding"), F.col("mean")).alias("similarity")), "similarity")


@query
def vector_functions(spark, folder):
    """Dot, norm, sum and scaling of every vector with itself reversed."""
    table = views.table(spark, folder, "embeddings").withColumn("a", F.col("embedding").cast("array<double>"))
    table = table.withColumn("b", F.reverse("a"))
    a, b = F.col("a"), F.col("b")
    return rounded(table.select(
        "vec_id", vec.vec_dot(a, b).alias("dot"), vec.vec_norm(a).alias("norm"),
        vec.vec_norm(vec.vec_add(a, b)).alias("sum_norm"), vec.vec_norm(vec.vec_scale(a, F.lit(4.0))).alias("quarter_norm"),
    ), "dot", "norm", "sum_norm", "quarter_norm")


@query
def sql_cosine_function(spark, folder):
    """cosine_similarity called from SQL text."""
    vec.register_sql_functions(spark)
    return spark.sql(
        f"SELECT vec_id, round(cosine_similarity(e, reverse(e)) + {views.OFF_TIE}D, 6) AS similarity "
        "FROM (SELECT vec_id, CAST(embedding AS ARRAY<DOUBLE>) AS e FROM {embeddings}) t",
        embeddings=views.table(spark, folder, "embeddings"),
    )


def _content(spark, folder, **options):
    songs = views.filled_songs(spark, folder)
    catalogue = Catalogue.of(songs, BATCH_FEATURES, **options)
    return content.content_matches(views.actions(spark, folder), songs, catalogue=catalogue)


@query
def content_topk(spark, folder):
    return _content(spark, folder)


@query
def content_topk_clustered(spark, folder):
    """The same by the plan for catalogues too large to broadcast."""
    return _content(spark, folder, broadcast_rows=0, chunk_rows=1024)


@query
def content_recs(spark, folder):
    return content.as_recommendations(_content(spark, folder))


# -- collaborative filtering -----------------------------------------------------------------------


@query
def freq_index(spark, folder):
    return ops.frequency_index(views.actions(spark, folder), "user_id", "user_index")


@query
def user_index_join(spark, folder):
    """Actions by number, joined back to distinct users (left) and to songs (inner)."""
    actions = views.actions(spark, folder)
    # Both are read twice below, so they are put together once.
    songs = materialize(views.songs(spark, folder).select("song_id", "title"), "songs")
    users = ops.frequency_index(actions, "user_id", "user_index")
    index = ops.frequency_index(songs, "song_id", "song_index")
    numbered = ops.index_columns(actions, {"song_id": index, "user_id": users})
    numbered = materialize(numbered.select("user_id", "user_index", "song_index", "rating"), "numbered")
    rows = numbered.groupBy("user_index", "song_index").agg(F.max("rating").alias("rating"))
    named = rows.join(numbered.select("user_id", "user_index").distinct(), "user_index", "left")
    return named.join(index.join(songs, "song_id"), "song_index").select(
        "user_index", "song_index", "user_id", "song_id", "title", "rating"
    )


@query
def explode_recs(spark, folder):
    """Each user's ten most played songs as one list, and back to rows."""
    plays = ops.plays_per_user(views.actions(spark, folder))
    best = ops.ranked(plays, "user_id", "plays", "song_id", 10)
    lists = best.groupBy("user_id").agg(F.collect_list(F.struct("rank", "song_id", "plays")).alias("recommendations"))
    return ops.explode_lists(lists, "recommendations")


@query
def als_recs(spark, folder):
    matches = als_matches(views.actions(spark, folder), views.songs(spark, folder))
    return rounded(matches, "predicted_rating")


@query
def topk_dot(spark, folder):
    """Each label's ten vectors of greatest product with the label's mean vector, as for users and songs by factors."""
    names = [f"f{i}" for i in range(EMBEDDING_DIMS)]
    parts = [f"CAST(embedding[{i}] AS DOUBLE)" for i in range(EMBEDDING_DIMS)]
    table = views.table(spark, folder, "embeddings")
    items = spark.sql("SELECT vec_id, " + ", ".join(f"{p} AS {n}" for p, n in zip(parts, names)) + " FROM {t}", t=table)
    means = spark.sql("SELECT label, " + ", ".join(f"avg({p}) AS {n}" for p, n in zip(parts, names)) + " FROM {t} GROUP BY label", t=table)
    index = index_items(items, "vec_id", names, metric="dot", broadcast_rows=0, chunk_rows=256)
    return rounded(top_k(means, index, user="label", k=10).select("label", "vec_id", "score", "rank"), "score")


@query
def als_checks(spark, folder):
    """What must hold for any trained model: every trained user has ten rows of known songs, ranks 1 to 10, scores not
    below zero and falling, and the details of the song table."""
    actions, songs = views.actions(spark, folder), views.songs(spark, folder)
    matches = als_matches(actions, songs)
    order = Window.partitionBy("user_id").orderBy("rank")
    rows = matches.withColumn("rises", F.col("predicted_rating") > F.lag("predicted_rating").over(order))
    known = songs.select("song_id", F.col("title").alias("known_title"), F.col("year").cast("string").alias("known_year"))
    rows = rows.join(known, "song_id", "left")
    per_user = rows.groupBy("user_id").agg(
        F.count("*").alias("n"), F.countDistinct("song_id").alias("songs"), F.min("rank").alias("low"), F.max("rank").alias("high"),
        F.count_if("rises").alias("rises"), F.count_if(F.col("predicted_rating") < 0).alias("negative"),
        F.count_if(F.col("title").eqNullSafe(F.col("known_title")) & F.col("year").cast("string").eqNullSafe(F.col("known_year"))).alias("known"),
    )
    return per_user.select(
        "user_id", F.col("n").alias("rows"), "songs", F.col("low").cast("long").alias("first_rank"), F.col("high").cast("long").alias("last_rank"),
        "rises", "negative", "known",
    )


# -- preparation -----------------------------------------------------------------------------------


@query
def null_profile(spark, folder):
    return ops.null_columns(views.songs(spark, folder))


@query
def drop_any_null(spark, folder):
    return rounded(views.songs(spark, folder).na.drop().select("song_id", "title", "song_hotttnesss"), "song_hotttnesss")


@query
def impute_one_feature(spark, folder):
    filled = impute(views.songs(spark, folder), "song_hotttnesss", ["energy"])
    return rounded(filled.select("song_id", "song_hotttnesss_filled"), "song_hotttnesss_filled")


@query
def impute_six_features(spark, folder):
    filled = impute(views.songs(spark, folder), "song_hotttnesss", IMPUTE_FEATURES)
    return rounded(filled.select("song_id", "song_hotttnesss_filled"), "song_hotttnesss_filled")


@query
def clean_songs(spark, folder):
    """Both imputed columns filled, unused columns gone, album renamed, written and read back."""
    raw = views.songs(spark, folder).withColumnRenamed("album_name", "release").withColumns({
        "artist_familiarity": F.when(F.col("year") % 7 != 0, F.col("energy") * 5 + F.col("tempo")),
        "audio_md5": F.md5("title"),
    })
    clean = preprocess(raw, scratch_path(spark, "clean"))
    return rounded(clean, *[f.name for f in clean.schema if f.dataType.typeName() == "double"])


@query
def latest_per_key(spark, folder):
    """Each user's last action by time."""
    actions = views.actions(spark, folder).withColumn("action_ms", F.unix_millis("action_time"))
    last = ops.last_per_key(actions.drop("action_time"), "user_id", ["action_ms"])
    return last.select("user_id", "action_ms", "song_id", "action_type", "rating")


# -- actions and the live job ----------------------------------------------------------------------


@query
def encode_actions(spark, folder):
    actions = views.actions(spark, folder)
    return encode_action(actions, F.unix_millis("action_time"))


def _decoded(spark, folder):
    return decode_actions(views.records(spark, folder))


@query
def parse_actions(spark, folder):
    return _decoded(spark, folder).filter("accepted").select(
        "event_id", "user_id", "song_id", "action_type", "action_ms", "rating"
    )


@query
def reject_actions(spark, folder):
    return rejected_records(_decoded(spark, folder))


@query
def plays_per_user(spark, folder):
    return ops.plays_per_user(ops.of_type(views.actions(spark, folder), LISTENED))


@query
def skipped_not_played(spark, folder):
    """Songs a user skipped and never listened to."""
    actions = views.actions(spark, folder)
    skipped = ops.of_type(actions, SKIPPED).select("user_id", "song_id").distinct()
    return ops.without(skipped, ops.of_type(actions, LISTENED), ["user_id", "song_id"])


@query
def live_profile(spark, folder):
    catalogue = live.live_catalogue(views.songs(spark, folder))
    played = ops.of_type(views.actions(spark, folder), LISTENED)
    return rounded(live.played_profiles(played, catalogue), *LIVE_FEATURES)


def _live(spark, folder, **options):
    catalogue = live.live_catalogue(views.songs(spark, folder), **options)
    return live.live_matches(views.actions(spark, folder), catalogue)


@query
def live_topk(spark, folder):
    """All actions as one batch."""
    return _live(spark, folder)


@query
def live_topk_clustered(spark, folder):
    return _live(spark, folder, broadcast_rows=0, chunk_rows=1024)


def _stream(spark, folder) -> LiveTables:
    """Run the live job over the event records, which lie in a folder as text files."""
    base = scratch_path(spark, "stream")
    views.records(spark, folder).select("value").write.text(f"{base}/in")
    tables = LiveTables(f"{base}/lake", f"{base}/serving", f"{base}/rejects")
    songs = live.live_catalogue(views.songs(spark, folder))
    start(file_actions(spark, f"{base}/in"), songs, tables, f"{base}/checkpoint", None).awaitTermination()
    return tables


@query
def stream_action_lake(spark, folder):
    rows = lake.read_lake(spark, _stream(spark, folder).lake)
    return rows.select("user_id", "song_id", "action_type", F.unix_millis("action_time").alias("action_ms"), "rating")


@query
def stream_live_recs(spark, folder):
    return files.read_keyed(spark, _stream(spark, folder).serving)


@query
def stream_rejects(spark, folder):
    return spark.read.parquet(_stream(spark, folder).rejects).select("value", "reason")


@query
def stream_reject_counts(spark, folder):
    """Records by why they were rejected, as the live job counts them while it writes."""
    counts = spark.read.parquet(_stream(spark, folder).reject_counts)
    return counts.groupBy("reason").agg(F.sum("records").alias("records"))


@query
def live_to_daily(spark, folder):
    """The live job fills the declared action view, its batches are merged, and the daily content job reads the table."""
    name, base = table_name(), scratch_path(spark, "loop")
    catalog.action_lake(spark, name, f"{base}/lake")
    views.records(spark, folder).select("value").write.text(f"{base}/in")
    tables = LiveTables(name, f"{base}/serving", f"{base}/rejects")
    start(file_actions(spark, f"{base}/in"), live.live_catalogue(views.songs(spark, folder)), tables, f"{base}/checkpoint", None).awaitTermination()
    catalog.compact_lake(spark, name, fanout=2)
    files.compact_keyed(spark, tables.serving)
    songs = views.filled_songs(spark, folder)
    return content.content_matches(catalog.lake_actions(spark, name), songs)


# -- serving ---------------------------------------------------------------------------------------


def _result_tables(spark, folder) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The content, live and popularity results, each written to an ORC table."""
    # The song table is put together once for the three jobs.
    songs, actions = materialize(views.songs(spark, folder), "songs"), views.actions(spark, folder)
    filled = views.filled(songs)
    results = {
        "content": content.as_recommendations(content.content_matches(actions, filled, catalogue=Catalogue.of(filled, BATCH_FEATURES))),
        "live": content.as_recommendations(live.live_matches(actions, live.live_catalogue(songs))),
        "popular": popular_recommendations(songs),
    }
    stored = {}
    for source, rows in results.items():
        name = table_name()
        catalog.recommendation_table(spark, name, scratch_path(spark, source))
        catalog.insert_overwrite(rows, name)
        stored[source] = spark.table(name)
    return {"content": stored["content"], "live": stored["live"]}, {"popular": stored["popular"]}


@query
def union_feeds(spark, folder):
    """The feeds of all users."""
    return feed.union_feeds(*_result_tables(spark, folder))


@query
def prefix_feed(spark, folder):
    """One user's feed from the serving tables, as the web page asks for it: their keys' prefix is the feature."""
    paths = []
    for tables in _result_tables(spark, folder):
        paths.append({name: scratch_path(spark, f"serving-{name}") for name in tables})
        for name, path in paths[-1].items():
            files.replace_keyed(tables[name], path)
    return feed.served_feed(spark, FEED_USER, *paths, seed=1)


@query
def cells_to_rows(spark, folder):
    rows = views.songs(spark, folder).select(
        F.col("song_id").alias("row_key"), F.col("title").alias("song_name"), "artist_name", "album_name", "year"
    )
    return rows_from_cells(cells_from_rows(rows))


# -- files and layouts -----------------------------------------------------------------------------


@query
def record_ingest(spark, folder):
    """One JSON file per supplier, decoded under the raw song schema. Those in debt are cut short; of the others some hold
    a number out of range, a fraction where a whole number is declared, a word for a number, or an object for a text."""
    path = scratch_path(spark, "records")
    suppliers = views.table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("song_id"), F.col("s_name").alias("title"),
        F.col("s_nationkey").alias("key"), F.col("s_acctbal").alias("tempo"),
        F.split("s_name", "#").alias("artist_terms"),
        F.array(F.array("s_acctbal", F.lit(1)), F.array(F.lit(0.5), F.lit(2.0))).alias("segments_pitches"),
    )
    text = F.to_json(F.struct(*suppliers.columns))
    kind = F.col("song_id").cast("long") % 12
    for value, field, wrong in ((3, "key", "3000000000"), (5, "key", "2.5"), (7, "tempo", '"fast"'), (9, "title", "{}")):
        text = F.when(kind == value, F.regexp_replace(text, f'"{field}":("[^"]*"|[^,}}]*)', f'"{field}":{wrong}')).otherwise(text)
    records = suppliers.select(
        F.when(F.col("tempo") < 0, F.substring(text, 1, 20)).otherwise(text).alias("value"), F.col("song_id").alias("file")
    )
    views.write_each(records, "file", path)
    pitches = F.aggregate(F.flatten("segments_pitches"), F.lit(0.0), lambda s, x: s + x)
    return rounded(record_files(spark, path, "*.txt", decode_json).select(
        F.regexp_extract("path", "file=([^/]+)", 1).alias("file"), F.col("error").isNotNull().alias("rejected"),
        "song_id", "title", "key", "tempo", F.array_join("artist_terms", "|").alias("terms"),
        pitches.alias("pitches"), "audio_md5",
    ), "tempo", "pitches")


@query
def decode_utf8_text(spark, folder):
    """Byte strings in arrays back to text."""
    turns = views.table(spark, folder, "conversations")
    encoded = turns.withColumn("bytes", F.array(F.encode("role", "UTF-8"), F.encode("text", "UTF-8")))
    return encoded.select("conv_id", "turn", F.array_join(decode_utf8("bytes"), "|").alias("decoded"))


@query
def partition_bucket_roundtrip(spark, folder):
    songs = views.songs(spark, folder).withColumn("decade", F.floor(F.col("year") / 10).cast("int"))
    saved = catalog.partitioned_bucketed(
        songs, table_name(), scratch_path(spark, "bucketed"), ["decade", "album_name"], "song_id", buckets=4
    )
    return rounded(saved.select("song_id", "title", "decade", "album_name", "tempo"), "tempo")


@query
def bucketed_join(spark, folder):
    """Liked songs with their details by a join of buckets: the song table by decade and album, the actions by bucket alone."""
    songs = views.songs(spark, folder).withColumn("decade", F.floor(F.col("year") / 10).cast("int"))
    names = [table_name(), table_name()]
    catalog.partitioned_bucketed(views.actions(spark, folder), names[0], scratch_path(spark, "bucketed"), [], "song_id", buckets=8)
    catalog.partitioned_bucketed(songs, names[1], scratch_path(spark, "bucketed"), ["decade", "album_name"], "song_id", buckets=8)
    liked = ops.rated_at_least(catalog.bucket_join(spark, *names, "song_id"))
    return rounded(liked.select("song_id", "user_id", "rating", "title", "duration", "tempo"), "duration", "tempo")


@query
def impute_noisy_label(spark, folder):
    """A label off the line, with gaps; rows with a gap in another column take no part in the fit either."""
    filled = impute(views.noisy_songs(spark, folder), "label", IMPUTE_FEATURES, complete=["label", "other"])
    return rounded(filled.select("song_id", "label_filled"), "label_filled")


@query
def signed_content_topk(spark, folder):
    """Content matches on signed features, zero for null: only similarities above zero count, also where few songs have one."""
    songs = views.signed_songs(spark, folder).fillna(0.0, views.SIGNED_FEATURES)
    catalogue = Catalogue.of(songs, views.SIGNED_FEATURES, broadcast_rows=0, chunk_rows=64)
    return content.content_matches(views.actions(spark, folder), songs, views.SIGNED_FEATURES, catalogue=catalogue)


@query
def signed_live_topk(spark, folder):
    """Live matches on signed features and nulls, which count as zero: similarities of any sign count."""
    catalogue = live.live_catalogue(views.signed_songs(spark, folder), views.SIGNED_FEATURES)
    return live.live_matches(views.actions(spark, folder), catalogue)


@query
def record_ingest_full(spark, folder):
    """Records with all fields of the raw song table, each of its declared type, and back."""
    path = scratch_path(spark, "full-records")
    values = views.full_record("s_suppkey", RAW_SONG, "STRING", "DOUBLE", ("array(", ")"))
    fields = ", ".join(f"{sql} AS `{name}`" for name, sql in values.items())
    records = views.table(spark, folder, "supplier").selectExpr(f"to_json(struct({fields})) AS value", "CAST(s_suppkey AS STRING) AS file")
    views.write_each(records, "file", path)

    def told(field):
        kind, column = field.dataType.simpleString(), F.col(field.name)
        if not kind.startswith("array"):
            return column
        flat = F.flatten(column) if kind.startswith("array<array") else column
        return F.array_join(F.transform(flat, lambda x: x.cast("string")), "|").alias(field.name)

    rows = record_files(spark, path, "*.txt", decode_json)
    return rows.select(F.col("error").isNotNull().alias("rejected"), *[told(f) for f in RAW_SONG])
