"""The recommenders, imputation and preprocessing on small hand-made tables."""

import os

import subprocess
import sys
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from encore import storage
from encore.operators import tables as ops
from encore.operators.impute import columns_with_gaps, impute
from encore.operators.topk import index_items, top_k
from encore.plans.collab import (
    als_matches, best_by_factors, fit_als, indexed_ratings, training_rows,
)
from encore.plans.content import as_recommendations, content_matches, user_profiles
from encore.plans.live import live_catalogue, live_matches
from encore.plans.popularity import popular_recommendations, popular_songs
from encore.plans.preprocess import clean_songs, preprocess
from encore.schemas import CLEAN_SONG, RAW_SONG
from encore.plans.daily import run_daily
from encore.sinks.catalog import recommendation_table
from encore.sinks.files import read_keyed
from encore.storage import SHUFFLE_CLEANUP, freed, materialize, scratch_path, scratch_scope
from queries import views

FOLDER = "/root/testdata/sf0.001"
SONG = "song_id string, title string, artist_name string, album_name string, year int"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_popularity(spark):
    songs = spark.createDataFrame(
        [("b", 1.0, 0.0), ("a", 1.0, 0.0), ("c", 0.0, 1.0), ("d", None, 1.0), ("e", 1.0, None)],
        "song_id string, song_hotttnesss double, artist_hotttnesss double",
    ).withColumns({"title": F.lit("t"), "artist_name": F.lit("n"), "album_name": F.lit("l"), "year": F.lit(0)})
    best = popular_songs(songs)
    assert [(r.song_id, r.popularity_score) for r in best.collect()] == [("a", 0.7), ("b", 0.7), ("c", 0.3)]
    assert "TakeOrderedAndProject" in plan_of(best)
    assert popular_recommendations(songs, 1).first().asDict() == {
        "row_key": "a", "song_name": "t", "artist_name": "n", "album_name": "l", "year": "0"}


def small_songs(spark, rows, features):
    columns = ", ".join(f"{c} double" for c in features)
    table = spark.createDataFrame(rows, f"song_id string, {columns}")
    return table.withColumns({"title": F.col("song_id"), "artist_name": F.lit("n"), "album_name": F.lit("l"), "year": F.lit(1999)})


def test_content_rules(spark):
    songs = small_songs(spark, [("x", 1.0, 0.0), ("y", 0.0, 1.0), ("z", -1.0, 0.0), ("o", 0.0, 0.0)], ["p", "q"])
    actions = spark.createDataFrame(
        [("u", "x", 3.5), ("u", "x", 5.0), ("u", "y", 4.0), ("u", "z", 3.0), ("v", "missing", 5.0), (None, "x", 5.0), ("w", "x", None)],
        "user_id string, song_id string, rating double",
    )
    profile = user_profiles(actions, songs, ["p", "q"]).collect()
    # x was liked twice and counts twice; z stays below the threshold; v knows no song.
    assert [(r.user_id, round(r.p, 6), round(r.q, 6)) for r in profile] == [("u", 0.666667, 0.333333)]
    matches = content_matches(actions, songs, ["p", "q"])
    # The opposite song and the one without length are not above zero; liked songs stay.
    assert [(r.song_id, r["rank"]) for r in matches.orderBy("rank").collect()] == [("x", 1), ("y", 2)]
    assert {r.row_key for r in as_recommendations(matches).collect()} == {"u#x", "u#y"}
    with pytest.raises(PySparkException, match="null or NaN"):
        content_matches(actions, songs.withColumn("p", F.when(F.col("song_id") != "o", F.col("p"))), ["p", "q"])


def test_content_plan_prunes_and_pushes(spark):
    actions = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(
        F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("song_id"), F.col("l_quantity").alias("rating"))
    plan = plan_of(ops.rated_at_least(actions))
    assert "GreaterThanOrEqual(l_quantity,3.5)" in plan
    assert "l_extendedprice" not in plan


def test_live_rules(spark):
    songs = small_songs(spark, [("x", 1.0, 0.0), ("y", 1.0, 0.5), ("z", -1.0, 0.0), ("n", None, 1.0)], ["p", "q"])
    songs = songs.union(songs.filter("song_id = 'y'"))
    actions = spark.createDataFrame(
        [("u", "x", "listened"), ("u", "y", "skipped"), ("u", "gone", "listened"), ("v", "gone", "listened"), ("w", "x", "skipped")],
        "user_id string, song_id string, action_type string",
    )
    catalogue = live_catalogue(songs, ["p", "q"])
    matches = live_matches(actions, catalogue)
    # x was played; y only skipped; z is opposite but counts; n has a null read as 0; y is one song.
    assert [(r.user_id, r.song_id) for r in matches.orderBy("rank").collect()] == [("u", "y"), ("u", "n"), ("u", "z")]


def test_ranking_cuts_before_the_shuffle(spark):
    table = spark.createDataFrame([("u", "a", 1.0), ("u", "b", 1.0), ("v", "c", 2.0)], "u string, s string, x double")
    best = ops.ranked(table, "u", "x", "s", 1)
    assert [(r.u, r.s) for r in best.orderBy("u").collect()] == [("u", "a"), ("v", "c")]
    assert "WindowGroupLimit" in plan_of(best)


def test_last_per_key_and_null_columns(spark):
    table = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("l", None, "d")], "k string, t int, v string")
    assert sorted(tuple(r) for r in ops.last_per_key(table, "k", ["t"]).collect()) == [("k", 2, "c"), ("l", None, "d")]
    assert [tuple(r) for r in ops.null_columns(table).collect()] == [("t", 1)]
    assert columns_with_gaps(table.withColumn("n", F.lit(float("nan")))) == ["t", "n"]


def test_frequency_index(spark):
    values = ["b"] * 3 + ["a"] * 3 + ["c"] + [None]
    index = ops.frequency_index(spark.createDataFrame([(v,) for v in values], "v string"), "v", "i")
    assert sorted(tuple(r) for r in index.collect()) == [("a", 0), ("b", 1), ("c", 2)]
    many = spark.range(5000).select((F.col("id") % 977).cast("string").alias("v"))
    numbers = [r.i for r in ops.frequency_index(many, "v", "i").collect()]
    assert sorted(numbers) == list(range(977))


def test_impute_rules(spark):
    rows = [(float(i), 2.0 * i + 1, None if i == 3 else 1.0) for i in range(6)] + [(10.0, None, None), (20.0, None, 1.0)]
    table = spark.createDataFrame(rows, "x double, y double, other double")
    filled = {r.x: r.y_filled for r in impute(table, "y", ["x"]).collect()}
    assert filled[3.0] == 7.0 and filled[10.0] == pytest.approx(21) and filled[20.0] == pytest.approx(41)
    # A row with a gap anywhere stays out of the fit, unless the columns to look at are named.
    odd = table.union(spark.createDataFrame([(1.0, 100.0, None)], table.schema))
    assert {r.x: r.y_filled for r in impute(odd, "y", ["x"]).collect()}[10.0] == pytest.approx(21)
    assert {r.x: r.y_filled for r in impute(odd, "y", ["x"], complete=["x", "y"]).collect()}[10.0] != pytest.approx(21)
    with pytest.raises(Exception, match="FAILED_EXECUTE_UDF"):
        impute(table.union(spark.createDataFrame([(None, None, 1.0)], table.schema)), "y", ["x"]).collect()


def test_clean_song_table(spark):
    parts = spark.range(40).select(F.col("id"), *[
        (F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") * 1.0) if f.name == "artist_familiarity" else
         F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 3.0) if f.name == "song_hotttnesss" else
         F.when(F.col("id") < 30, 1.0) if f.name == "artist_latitude" else
         F.col("id").cast(f.dataType) if f.dataType.typeName() in ("double", "long", "integer", "string") else
         F.array().cast(f.dataType)).alias(f.name) for f in RAW_SONG])
    raw = parts.drop("id").withColumns({"tempo": F.rand(1), "energy": F.rand(2), "loudness": F.rand(3), "danceability": F.rand(4), "year": (F.rand(5) * 50).cast("int")})
    clean = clean_songs(raw)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in CLEAN_SONG]
    row = clean.filter("song_id = '35'").first()
    assert row.artist_familiarity == pytest.approx(35) and row.song_hotttnesss == pytest.approx(105)
    written = preprocess(raw, scratch_path(spark, "clean"), files=3)
    assert written.count() == 40 and len(written.inputFiles()) == 3


@pytest.fixture(scope="module")
def als_input(spark):
    actions, songs = views.actions(spark, FOLDER), views.songs(spark, FOLDER)
    rows = training_rows(actions)
    users = ops.frequency_index(rows, "user_id", "user_index")
    index = ops.frequency_index(songs, "song_id", "song_index")
    return indexed_ratings(rows, users, index).persist()


def test_als_model(spark, als_input):
    model = fit_als(als_input, seed=3)
    factors = model.userFactors.union(model.itemFactors)
    assert factors.filter(F.exists("features", lambda x: x < 0)).count() == 0
    error = model.transform(als_input).agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0]
    assert error < 1.5
    # The same songs as the library's own all-pairs ranking.
    ours = {(r.user_index, r["rank"]): r.score for r in best_by_factors(model, 10).collect()}
    theirs = {
        (r.user_index, i + 1): s.rating
        for r in model.recommendForAllUsers(10).collect() for i, s in enumerate(r.recommendations)
    }
    assert ours.keys() == theirs.keys()
    assert all(ours[key] == pytest.approx(theirs[key], abs=1e-5) for key in ours)
    again = fit_als(als_input, seed=3)
    first = {r.id: r.features for r in model.itemFactors.collect()}
    assert all(first[r.id] == pytest.approx(r.features, abs=1e-4) for r in again.itemFactors.collect())


def test_als_job(spark):
    actions, songs = views.actions(spark, FOLDER), views.songs(spark, FOLDER)
    unknown = actions.limit(1).withColumn("song_id", F.lit("unknown"))
    matches = als_matches(actions.union(unknown), songs, k=10, exclude_actions=("skipped",), blocks=4)
    counts = matches.groupBy("user_id").count()
    assert counts.filter("count != 10").count() == 0
    assert counts.count() == actions.filter("action_type != 'skipped'").select("user_id").distinct().count()
    assert matches.filter("song_id = 'unknown'").count() == 0


def test_daily_batch(spark):
    tables = {name: f"t_daily_{name}" for name in ("popular", "content", "als")}
    for name, table in tables.items():
        recommendation_table(spark, table, scratch_path(spark, name))
    serving = {name: scratch_path(spark, f"serving-{name}") for name in ("popular", "content")}
    songs = views.filled_songs(spark, FOLDER)
    run_daily(spark, views.actions(spark, FOLDER), songs, tables, serving)
    assert spark.table(tables["popular"]).count() == 100
    assert spark.table(tables["als"]).count() == 10 * 150
    assert read_keyed(spark, serving["content"]).count() == spark.table(tables["content"]).count() > 1000


def shuffles_of(spark):
    """Numbers of the shuffles that have files."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {n.split("_")[1] for folder in folders for _, _, names in os.walk(folder) for n in names if n.startswith("shuffle_")}


def soon(condition):
    """Files are deleted in the background."""
    end = time.time() + 20
    while not (met := condition()) and time.time() < end:
        time.sleep(0.2)
    return met


def test_written_tables_keep_no_shuffle_files(spark):
    setting = spark.conf.get(SHUFFLE_CLEANUP, None)
    before = shuffles_of(spark)
    rows = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    stored = materialize(rows, "shuffled")
    assert soon(lambda: shuffles_of(spark) <= before)
    assert sorted(r["count"] for r in stored.collect()) == sorted(r["count"] for r in rows.collect())
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    with pytest.raises(Exception):
        materialize(rows.select(F.raise_error(F.lit("no"))), "failed")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_rounds_of_the_factor_model_keep_no_shuffle_files(spark):
    ratings = spark.range(400).select(
        (F.col("id") % 20).cast("int").alias("user_index"), (F.col("id") % 23).cast("int").alias("song_index"), (F.col("id") % 5).cast("float").alias("rating"))
    freed(spark)
    before = shuffles_of(spark)
    model = fit_als(ratings, blocks=2)
    # Ten rounds of two shuffles each, and a few of the input.
    assert soon(lambda: len(shuffles_of(spark) - before) < 15)
    found = best_by_factors(model, 3)
    assert found.count() == 60


def test_search_keeps_no_users_of_earlier_rounds(spark):
    names = ["p", "q", "r"]
    rows = spark.range(2000).select(F.col("id").alias("key"), *[F.randn(i).alias(n) for i, n in enumerate(names)])
    rows = materialize(rows, "search-rows")
    with scratch_scope(spark):
        index = index_items(rows, "key", names, metric="dot", broadcast_rows=0, chunk_rows=16)
        found = top_k(rows.withColumnRenamed("key", "user_id"), index, k=3)
        rounds = [p for p in storage._open_scopes()[-1] if "/frontier-" in p]
        assert len(rounds) > 2 and not [p for p in rounds[:-1] if os.path.exists(f"{p.removeprefix('file:')}/finished=false")]
        assert found.count() == 6000


def test_scratch_scope_removes_its_tables(spark):
    with scratch_scope(spark):
        table = materialize(spark.range(3), "scope")
        assert table.count() == 3
    path = table.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert not os.path.exists(path)


ALS_SCRIPT = """
import sys
from pyspark.sql import SparkSession
from encore.session import prepare
from encore.plans.collab import als_matches
from queries import views
spark = prepare(SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate())
rows = als_matches(views.actions(spark, sys.argv[2]), views.songs(spark, sys.argv[2])).select("user_id", "rank", "song_id").collect()
print("ROWS", hash(tuple(sorted(map(tuple, rows)))))
"""


def test_als_does_not_depend_on_cores():
    said = []
    for master in ("local[2]", "local[8]"):
        run = subprocess.run(
            [sys.executable, "-c", ALS_SCRIPT, master, FOLDER], capture_output=True, text=True, timeout=600,
            env=os.environ | {"PYTHONHASHSEED": "1", "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))},
        )
        said.append([line for line in run.stdout.splitlines() if line.startswith("ROWS")])
    assert len(said[0]) == 1 and said[0] == said[1]
