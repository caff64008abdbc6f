"""Sources, sinks, the live job and the feed."""

import json
import time

import pytest
from pyspark.sql import functions as F

from encore.plans import feed
from encore.plans.content import as_recommendations
from encore.plans.live import live_catalogue, live_matches
from encore.functions.actions import accepted_actions, decode_actions
from encore.schemas import RAW_SONG, RECOMMENDATION, USER_ACTION
from encore.sinks import catalog, files, lake, snapshots
from encore.sinks.snapshots import newest_snapshot
from encore.sources import records
from encore.sources.cells import rows_from_cells
from encore.sources.tables import file_actions, kafka_actions, read_parquet, read_table
from encore.storage import scratch_path, shared_folder
from encore.streaming.live import LiveTables, process_batch, start
from queries import views

FOLDER = "/root/testdata/sf0.001"


def recommendations(spark, keys, name="t"):
    return spark.createDataFrame([(k, name, "n", "l", "1999") for k in keys], RECOMMENDATION)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_catalog_tables(spark):
    catalog.recommendation_table(spark, "t_recs", scratch_path(spark, "recs"))
    # Columns go by position, and an int year becomes text.
    wrong_names = spark.createDataFrame([("k", "t", "n", "l", 1999)], "a string, b string, c string, d string, e int")
    catalog.insert_overwrite(recommendations(spark, ["x", "y"]), "t_recs")
    catalog.insert_overwrite(wrong_names, "t_recs")
    assert rows(spark.table("t_recs")) == [("k", "t", "n", "l", "1999")]
    location = scratch_path(spark, "actions")
    catalog.action_table(spark, "t_actions", location)
    action = spark.sql("SELECT 'u', 's', 'listened', timestamp'2024-01-01', 1.5D")
    catalog.insert_append(action, "t_actions")
    catalog.insert_append(action, "t_actions")
    assert read_table(spark, "t_actions", ["user_id", "rating"]).count() == 2
    assert all(f.endswith(".snappy.parquet") for f in read_parquet(spark, location, USER_ACTION).inputFiles())


def test_partitioned_and_bucketed(spark):
    songs = spark.range(30).selectExpr("cast(id as string) song_id", "cast(1990 + id % 2 as int) year", "'a' artist_id")
    table = catalog.partitioned_bucketed(songs, "t_bucketed", scratch_path(spark, "bucketed"), ["year", "artist_id"], "song_id")
    details = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED t_bucketed").collect()}
    assert details["Num Buckets"] == "50"
    assert rows(table.select("song_id", "year", "artist_id")) == rows(songs.select("song_id", "year", "artist_id"))
    assert "PartitionFilters: [isnotnull(year" in table.filter("year = 1990")._jdf.queryExecution().executedPlan().toString()
    joined = table.hint("merge").join(table.select("song_id").withColumn("one", F.lit(1)), "song_id")
    assert joined.count() == 30


def test_keyed_table(spark):
    path = scratch_path(spark, "keyed")
    files.replace_keyed(recommendations(spark, ["u#a", "u#b"]), path)
    files.upsert(recommendations(spark, ["u#b", "u#c"], "new"), path, "s", 1, version=5)
    files.upsert(recommendations(spark, ["u#b", "u#c"], "new"), path, "s", 1, version=5)  # a replay
    files.upsert(recommendations(spark, ["u#c"], "newest"), path, "s", 2, version=6)
    current = rows(files.read_keyed(spark, path).select("row_key", "song_name"))
    assert current == [("u#a", "t"), ("u#b", "new"), ("u#c", "newest")]
    merged = scratch_path(spark, "merged")
    files.merge_versions(spark, path, merged)
    assert rows(files.read_keyed(spark, merged).select("row_key", "song_name")) == current
    files.replace_keyed(recommendations(spark, ["z"]), path)
    assert rows(files.read_keyed(spark, path).select("row_key")) == [("z",)]


def test_copy_to_serving(spark):
    catalog.recommendation_table(spark, "t_copy", scratch_path(spark, "copy"))
    serving = scratch_path(spark, "serving")
    catalog.insert_overwrite(recommendations(spark, ["a", "b"]), "t_copy")
    catalog.copy_to_serving(spark, "t_copy", serving)
    catalog.insert_overwrite(recommendations(spark, ["b", "c"], "new"), "t_copy")
    catalog.copy_to_serving(spark, "t_copy", serving, mode="upsert", batch=1, version=1)
    assert rows(files.read_keyed(spark, serving).select("row_key", "song_name")) == [("a", "t"), ("b", "new"), ("c", "new")]
    catalog.copy_to_serving(spark, "t_copy", serving)
    assert rows(files.read_keyed(spark, serving).select("row_key")) == [("b",), ("c",)]
    with pytest.raises(ValueError):
        catalog.copy_to_serving(spark, "t_copy", serving, mode="append")


def test_feed(spark):
    own = {"content": recommendations(spark, ["u1#a", "u10#b", "x#y#c", "u1#a"]), "live": recommendations(spark, ["u1#a"])}
    common = {"popular": recommendations(spark, ["a", "p"])}
    seen = feed.user_feed("u1", own, common, seed=4)
    assert rows(seen.select("source", "user_id", "song_id")) == [
        ("content", "u1", "a"), ("live", "u1", "a"), ("popular", "u1", "a"), ("popular", "u1", "p")]
    # A user id that holds the separator keeps its song id.
    assert rows(feed.user_feed("x#y", own, {}).select("song_id")) == [("c",)]
    assert rows(feed.user_feed("", own, common).select("source")) == [("popular",), ("popular",)]
    assert [r.song_id for r in seen.collect()] == [r.song_id for r in feed.user_feed("u1", own, common, seed=4).collect()]
    path = scratch_path(spark, "scan")
    own["content"].write.orc(path)
    plan = feed.prefix_scan(spark.read.orc(path), "u1")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(row_key,u1#)" in plan
    # The condition also reaches the scan of a keyed table, below the choice of the newest rows.
    files.replace_keyed(own["content"], scratch := scratch_path(spark, "keyed"))
    keyed = feed.prefix_scan(files.read_keyed(spark, scratch), "u1")
    assert "StringStartsWith(row_key,u1#)" in keyed._jdf.queryExecution().executedPlan().toString()


def test_cells(spark):
    cells = spark.createDataFrame(
        [("k", "details:song_name", "old", 1), ("k", "details:song_name", "new", 2), ("k", "details:year", None, 1),
         ("k", "details:other", "x", 1), ("l", "details:year", "2001", 1)],
        "row_key string, column string, value string, version int",
    )
    assert rows(rows_from_cells(cells).fillna("-")) == [("k", "new", "-", "-", ""), ("l", "-", "-", "-", "2001")]


def test_ingest(spark, tmp_path):
    good = {"song_id": "s1", "title": "t", "year": 1999, "tempo": 120, "analysis_sample_rate": 22050, "mode": 1.0,
            "artist_terms": ["a", "b"], "segments_timbre": [[1, 2.5], []], "extra": 1}
    (tmp_path / "A" / "B").mkdir(parents=True)
    (tmp_path / "A" / "B" / "one.rec").write_text(json.dumps(good))
    (tmp_path / "A" / "bad.rec").write_text("{")
    (tmp_path / "A" / "wrong.rec").write_text(json.dumps({**good, "year": "soon"}))
    (tmp_path / "A" / "other.txt").write_text("not asked for")
    table, rejects = records.ingest(spark, str(tmp_path), "*.rec", records.decode_json)
    assert table.schema.names == RAW_SONG.names and table.count() == 1
    row = table.first()
    assert (row.song_id, row.tempo, row.analysis_sample_rate, row.mode) == ("s1", 120.0, 22050.0, 1)
    assert row.segments_timbre == [[1.0, 2.5], []] and row.artist_terms == ["a", "b"] and row.artist_mbid is None
    assert sorted(r.path.rsplit("/", 1)[1] for r in rejects.collect()) == ["bad.rec", "wrong.rec"]

    def decode_bytes(content):
        return {"title": b"caf\xc3\xa9", "artist_terms": [b"x"], "artist_mbtags": []}

    table, _ = records.ingest(spark, str(tmp_path), "one.rec", decode_bytes)
    assert (table.first().title, table.first().artist_terms, table.first().artist_mbtags) == ("café", ["x"], [])


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_actions(spark, "host:1", "topic", "group")


@pytest.fixture(scope="module")
def catalogue(spark):
    return live_catalogue(views.songs(spark, FOLDER))


def test_stream_equals_batches_and_survives_a_restart(spark, catalogue, tmp_path):
    records_in = views.records(spark, FOLDER).filter("event_id < 300").select("event_id", "value")
    groups = [records_in.filter(f"event_id % 3 = {i}").select("value") for i in range(3)]
    source, tables = str(tmp_path / "in"), LiveTables(*[str(tmp_path / n) for n in ("lake", "serving", "rejects")])

    def run(folder="checkpoint"):
        stream = file_actions(spark, source, files_per_batch=1)
        start(stream, catalogue, tables, str(tmp_path / folder), None).awaitTermination()

    for group in groups[:2]:
        group.coalesce(1).write.mode("append").text(source)
    run()
    # Restarted from the same checkpoint, only the new file is read.
    groups[2].coalesce(1).write.mode("append").text(source)
    run()
    assert [list(p.covers.values()) for p in newest_snapshot(spark, tables.lake).parts] == [[[n, n]] for n in range(3)]
    actions = lake.read_lake(spark, tables.lake)
    expected = accepted_actions(decode_actions(records_in.select("value")))
    assert rows(actions.fillna("-")) == rows(expected.fillna("-"))
    assert spark.read.parquet(tables.rejects).count() == records_in.count() - expected.count()
    # Each batch's recommendations come from that batch alone; the serving table keeps the union of keys.
    keys = set()
    for group in groups:
        actions = accepted_actions(decode_actions(group))
        matches = live_matches(actions, catalogue)
        keys |= {r.row_key for r in as_recommendations(matches).collect()}
    assert {r.row_key for r in files.read_keyed(spark, tables.serving).collect()} == keys


def test_replay_changes_nothing(spark, catalogue, tmp_path):
    tables = LiveTables(*[str(tmp_path / n) for n in ("lake", "serving", "rejects")])
    batch = views.records(spark, FOLDER).filter("event_id < 50").select("value")
    process_batch(batch, 0, "q", catalogue, tables)
    actions, serving = lake.read_lake(spark, tables.lake).count(), rows(files.read_keyed(spark, tables.serving))
    counts = rows(spark.read.parquet(tables.reject_counts))
    assert {r[0]: r[1] for r in counts}["accepted"] == actions
    process_batch(batch, 0, "q", catalogue, tables)
    process_batch(batch.limit(0), 1, "q", catalogue, tables)
    assert lake.read_lake(spark, tables.lake).count() == actions
    assert rows(spark.read.parquet(tables.reject_counts)) == counts
    assert rows(files.read_keyed(spark, tables.serving)) == serving


@pytest.mark.parametrize("field, value", [
    ("key", "3000000000"), ("key", "2.5"), ("key", "true"), ("key", '"1"'), ("year", "1e400"), ("tempo", '"fast"'), ("title", "{}"), ("title", "5"),
    ("artist_terms", '"one"'), ("bars_start", '[1, "x"]'), ("track_7digitalid", "9223372036854775808"),
])
def test_no_file_stops_an_ingest(spark, tmp_path, field, value):
    (tmp_path / "good.rec").write_text('{"song_id": "a", "key": 3.0, "tempo": 7}')
    (tmp_path / "bad.rec").write_text('{"song_id": "b", "%s": %s}' % (field, value))
    table, rejects = records.ingest(spark, str(tmp_path), "*.rec", records.decode_json)
    assert [(r.song_id, r.key, r.tempo) for r in table.collect()] == [("a", 3, 7.0)]
    assert [r.path.rpartition("/")[2] for r in rejects.collect()] == ["bad.rec"]


def test_seeded_order_does_not_depend_on_partitions(spark):
    rows = spark.range(200).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("song_id"))
    orders = [[r.song_id for r in feed.shuffled(rows.repartition(n), 5).collect()] for n in (1, 4)]
    assert orders[0] == orders[1] != sorted(orders[0])
    assert [r.song_id for r in feed.shuffled(rows, 6).collect()] != orders[0]


def test_feed_of_one_key_with_two_details_is_stable(spark):
    rows = [("u#s", "old", "a", "b", "1"), ("u#s", "new", "a", "b", "1")]
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "row_key string, song_name string, artist_name string, album_name string, year string")
        assert [r.song_name for r in feed.as_feed(table, "x").collect()] == ["old"]


def test_serving_scan_skips_files(spark, tmp_path):
    table = spark.range(20_000).select(
        F.concat_ws("#", (F.col("id") % 500).cast("string"), F.col("id").cast("string")).alias("row_key"),
        *[F.lit("x").alias(c) for c in ("song_name", "artist_name", "album_name", "year")],
    )
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # a table this small would be one file
    try:
        files.upsert(table, f"{tmp_path}/t", "s", 0, 1)
    finally:
        spark.conf.unset(coalesce)
    parts = newest_snapshot(spark, f"{tmp_path}/t").parts
    assert len(parts) > 2 and len(files.files_of(parts, "42#")) <= 2
    served = files.read_keyed(spark, f"{tmp_path}/t", prefix="42#")
    assert len(served.inputFiles()) == len(files.files_of(parts, "42#")) and served.count() == 40
    assert files.read_keyed(spark, f"{tmp_path}/t", F.col("row_key").startswith("42#")).count() == 40
    assert files.read_keyed(spark, f"{tmp_path}/t", prefix="no such user#").count() == 0


def test_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    files.replace_keyed(recommendations(spark, ["a", "b"]), path)
    broken = recommendations(spark, ["c"]).withColumn("song_name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        files.replace_keyed(broken, path)
    assert rows(files.read_keyed(spark, path).select("row_key")) == [("a",), ("b",)]
    files.replace_keyed(recommendations(spark, ["d"]), path)
    assert rows(files.read_keyed(spark, path).select("row_key")) == [("d",)]


def test_compaction_keeps_rows_and_order_of_versions(spark, tmp_path):
    path = f"{tmp_path}/t"
    for batch in range(5):
        files.upsert(recommendations(spark, ["a", f"b{batch}"], f"n{batch}"), path, "s", batch, version=batch)
    before = rows(files.read_keyed(spark, path))
    files.compact_keyed(spark, path)
    assert rows(files.read_keyed(spark, path)) == before and files.newest_version(spark, path) == 4
    files.upsert(recommendations(spark, ["a"], "late"), path, "t", 0, version=5)
    assert ("late",) in rows(files.read_keyed(spark, path).select("song_name"))


ACTION = [("u", "s", "listened", None, 1.0)]


def test_lake_replays_and_merges(spark, tmp_path):
    """Compacted twice while the stream goes on, replayed before and after: every batch is there once."""
    catalog.action_lake(spark, "t_lake", f"{tmp_path}/lake")
    action = spark.createDataFrame(ACTION, USER_ACTION)
    assert spark.table("t_lake").count() == 0 and catalog.lake_actions(spark, "t_lake").columns == USER_ACTION.names
    for batch in (0, 1, 1):
        catalog.write_actions(action, "t_lake", "q", batch)
    assert catalog.lake_actions(spark, "t_lake").count() == 2
    assert catalog.compact_lake(spark, "t_lake", fanout=2) == 1
    for batch in (1, 2, 3):  # the last merged batch comes again, as after a restart
        catalog.write_actions(action, "t_lake", "q", batch)
    catalog.write_actions(action, "t_lake", "r", 0)
    assert catalog.lake_actions(spark, "t_lake").count() == 5
    assert catalog.compact_lake(spark, "t_lake", fanout=2) == 2
    assert len(lake.folders(spark, f"{tmp_path}/lake")) == 1
    assert catalog.lake_actions(spark, "t_lake").count() == 5 == spark.table("t_lake").count()
    spark.sql("DROP VIEW t_lake")


def test_readers_of_a_lake_see_old_or_new(spark, tmp_path, monkeypatch):
    """A merge that fails half-way, or is overtaken by a replay, leaves the rows as they were."""
    path, action = str(tmp_path), spark.createDataFrame(ACTION, USER_ACTION)
    for batch in range(4):
        lake.append_batch(action, path, "q", batch)
    before, swap = lake.read_lake(spark, path), lake.swap
    assert before.count() == 4

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "swap", crash)
    with pytest.raises(RuntimeError):
        lake.compact_lake(spark, path, 2)
    assert lake.read_lake(spark, path).count() == 4 and len(lake.folders(spark, path)) == 4

    def overtaken(*given):
        lake.append_batch(action.union(action), path, "q", 3)
        return swap(*given)

    monkeypatch.setattr(lake, "swap", overtaken)
    assert lake.compact_lake(spark, path, 2) == 0
    assert lake.read_lake(spark, path).count() == 5
    monkeypatch.setattr(lake, "swap", swap)
    assert lake.compact_lake(spark, path, 2) == 1
    assert lake.read_lake(spark, path).count() == 5 and before.count() == 4  # who read before still can


def test_commits_do_not_overwrite_each_other(spark, tmp_path):
    path, done = str(tmp_path), []

    def late(now):
        if not done:
            done.append(snapshots.commit(spark, path, lambda parts: [*parts, snapshots.Part("data/first", {"a": [0, 0]})]))
        return [*now, snapshots.Part("data/second", {"b": [0, 0]})]

    assert snapshots.commit(spark, path, late)
    assert [p.path for p in newest_snapshot(spark, path).parts] == ["data/first", "data/second"]
    assert not snapshots.commit(spark, path, lambda now: None) and newest_snapshot(spark, path).number == 2


def test_old_snapshots_expire_with_their_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "KEPT_SECONDS", -60)
    path, action = str(tmp_path), spark.createDataFrame(ACTION, USER_ACTION)
    for batch in range(6):
        lake.append_batch(action, path, "q", batch)
        lake.compact_lake(spark, path, 2)
    assert lake.read_lake(spark, path).count() == 6
    named = {p.path for n in snapshots._times(spark, path) for p in snapshots._read(spark, path, n).parts}
    assert len(snapshots._times(spark, path)) == snapshots.KEPT
    assert {f"data/{p.name}" for p in (tmp_path / "data").iterdir()} == named


def test_levels_of_a_keyed_table(spark, tmp_path):
    """The live job's merges keep the newest rows, and only files whose keys meet are rewritten."""
    path = str(tmp_path)
    for batch in range(9):
        keys = [f"u{n:03}#s{(n + batch) % 3}" for n in range(batch * 10, batch * 10 + 40)]
        files.upsert(recommendations(spark, keys, f"n{batch}"), path, "q", batch, version=batch)
        files.compact_levels(spark, path, batches=3, level_rows=60, file_rows=25)
    want = {}
    for batch in range(9):
        want |= {f"u{n:03}#s{(n + batch) % 3}": f"n{batch}" for n in range(batch * 10, batch * 10 + 40)}
    got = files.read_keyed(spark, path)
    assert {r.row_key: r.song_name for r in got.collect()} == want
    assert {p.level for p in newest_snapshot(spark, path).parts} >= {2}
    own = files.read_keyed(spark, path, prefix="u041#")
    assert {r.row_key: r.song_name for r in own.collect()} == {k: v for k, v in want.items() if k.startswith("u041#")}


def test_a_user_is_in_few_files_after_a_thousand_batches():
    """The plan of merges alone, on parts without rows behind them: batches of a thousand rows, one file each."""
    parts, most, rewritten = [], 0, 0
    for batch in range(1000):
        parts.append(snapshots.Part(f"b{batch}", {"q": [batch, batch]}, 0, 1000, "u0000", "u9999", batch))
        while found := files.next_merge(parts, batches=8, level_rows=20_000):
            old, level = found
            rows = sum(p.rows for p in old)
            rewritten += rows
            count = max(1, rows // 1000)
            edges = [f"u{round(i * 10_000 / count):04}" for i in range(count)] + ["u9999"]
            new = [
                snapshots.Part(f"m{batch}-{level}-{i}", snapshots.merged_covers(old), level, rows // count, edges[i], f"u{round((i + 1) * 10_000 / count) - 1:04}", batch)
                for i in range(count)
            ]
            parts = [p for p in parts if p not in old] + new
        most = max(most, len(files.files_of(parts, "u4242#")) if batch > 50 else 0)
    assert most <= 8 + 4 and {p.level for p in parts} >= {1, 2, 3}
    assert rewritten <= 1_000_000 * 16


def test_live_job_with_an_interval(spark, catalogue, tmp_path):
    """The running trigger: files that come while the job runs are batches of their own, and it merges by itself."""
    tables, source = LiveTables(*[str(tmp_path / n) for n in ("lake", "serving", "rejects")]), str(tmp_path / "in")
    records_in = views.records(spark, FOLDER).filter("event_id < 120").select("event_id", "value")
    records_in.filter("event_id < 60").select("value").coalesce(1).write.text(source)
    query = start(file_actions(spark, source), catalogue, tables, str(tmp_path / "checkpoint"), interval_seconds=1)
    try:
        waited = time.time() + 120
        while not newest_snapshot(spark, tables.lake).parts and time.time() < waited and query.isActive:
            time.sleep(0.5)
        records_in.filter("event_id >= 60").select("value").coalesce(1).write.mode("append").text(source)
        while len(newest_snapshot(spark, tables.lake).parts) < 2 and time.time() < waited and query.isActive:
            time.sleep(0.5)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    expected = accepted_actions(decode_actions(records_in.select("value")))
    assert rows(lake.read_lake(spark, tables.lake).fillna("-")) == rows(expected.fillna("-"))
    assert {max(p.covers.values())[0] for p in newest_snapshot(spark, tables.lake).parts} == {0, 1}


def test_join_of_buckets_needs_no_shuffle(spark, tmp_path):
    left = spark.range(3000).select((F.col("id") % 700).cast("string").alias("song_id"), F.col("id").alias("n"))
    right = spark.range(700).select(F.col("id").cast("string").alias("song_id"), (F.col("id") % 3).alias("part"), F.col("id").alias("m"))
    catalog.partitioned_bucketed(left, "t_left", f"{tmp_path}/left", [], "song_id", 5)
    catalog.partitioned_bucketed(right, "t_right", f"{tmp_path}/right", ["part"], "song_id", 5)
    joined = catalog.bucket_join(spark, "t_left", "t_right", "song_id")
    assert rows(joined.select("n", "m")) == [(n, n % 700) for n in range(3000)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    # A third of all rows on one song: shuffled, so that the key can be split.
    hot = left.union(left.limit(1).crossJoin(spark.range(1500).select(F.col("id").alias("k"))).select("song_id", "k"))
    catalog.partitioned_bucketed(hot, "t_left", f"{tmp_path}/left", [], "song_id", 5)
    split = catalog.bucket_join(spark, "t_left", "t_right", "song_id", most_uneven=1.5)
    assert split.count() == 4500 and "Exchange" in split._jdf.queryExecution().executedPlan().toString()
    catalog.partitioned_bucketed(right, "t_right", f"{tmp_path}/right", ["part"], "song_id", 6)
    with pytest.raises(ValueError, match="same number of buckets"):
        catalog.bucket_join(spark, "t_left", "t_right", "song_id")
    for name in ("t_left", "t_right"):
        spark.sql(f"DROP TABLE {name}")
