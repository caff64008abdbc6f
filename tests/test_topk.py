"""Both top-k plans against brute force."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from encore.operators import kernels, topk
from encore.operators.chunks import FACTS, Directory, facts_of
from encore.operators.topk import index_items, top_k
from encore.storage import materialize


def vectors(rng, key, rows, dims, copies=0, zeros=0, low=-1.0):
    data = rng.uniform(low, 1.0, (rows, dims))
    data[:copies] = data[0]
    data[rows - zeros:] = 0.0
    frame = pd.DataFrame(data, columns=[f"f{i}" for i in range(dims)])
    frame.insert(0, key, [f"{key[0]}{i}" for i in range(rows)])
    return frame


def brute_force(users, items, k, metric="cosine", exclude=(), positive_only=False):
    features = list(items.columns[1:])
    u, x = users[features].to_numpy(float), items[features].to_numpy(float)
    if metric == "cosine":
        u = np.divide(u, np.linalg.norm(u, axis=1, keepdims=True), where=u.any(axis=1, keepdims=True), out=np.zeros_like(u))
        x = np.divide(x, np.linalg.norm(x, axis=1, keepdims=True), where=x.any(axis=1, keepdims=True), out=np.zeros_like(x))
    rows = []
    excluded = set(exclude)
    for name, scores in zip(users.iloc[:, 0], u @ x.T):
        pairs = [(-round(s, 9), i) for i, s in zip(items.iloc[:, 0], scores)
                 if (name, i) not in excluded and (s > 0 or not positive_only)]
        rows += [(name, i, rank + 1) for rank, (_, i) in enumerate(sorted(pairs)[:k])]
    return sorted(rows)


def found(result):
    return sorted((r.user_id, r.song_id, r.rank) for r in result.collect())


PLANS = {"broadcast": {}, "clustered": {"broadcast_rows": 0, "chunk_rows": 16}}


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("positive_only", [True, False])
def test_equals_brute_force(spark, plan, metric, positive_only):
    rng = np.random.default_rng(7)
    # A third of the songs are copies of one vector, and a third of the users are alike.
    songs = vectors(rng, "song_id", 240, 4, copies=80, zeros=7)
    users = vectors(rng, "user_id", 60, 4, copies=20, zeros=3)
    index = index_items(spark.createDataFrame(songs), "song_id", list(songs.columns[1:]), metric=metric, **PLANS[plan])
    assert (index.directory is None) == (plan == "broadcast")
    result = top_k(spark.createDataFrame(users), index, k=5, positive_only=positive_only)
    assert found(result) == brute_force(users, songs, 5, metric, positive_only=positive_only)


@pytest.mark.parametrize("plan", PLANS)
def test_exclusion_reaches_past_the_excluded(spark, plan):
    rng = np.random.default_rng(8)
    songs = vectors(rng, "song_id", 150, 3, copies=50, low=0.1)
    users = vectors(rng, "user_id", 20, 3, low=0.1)
    # One user has seen two thirds of the songs, one all of them, others a few.
    seen = [("u0", s) for s in songs.song_id[:100]] + [("u1", s) for s in songs.song_id]
    seen += [(f"u{i}", s) for i in range(2, 10) for s in songs.song_id[i * 5:i * 5 + 4]]
    index = index_items(spark.createDataFrame(songs), "song_id", ["f0", "f1", "f2"], **PLANS[plan])
    exclude = spark.createDataFrame(seen + seen[:30], "user_id string, song_id string")
    result = found(top_k(spark.createDataFrame(users), index, k=4, exclude=exclude))
    assert result == brute_force(users, songs, 4, exclude=seen)
    assert not {r[0] for r in result} & {"u1"}


def test_hot_chunk_is_split_into_groups(spark, monkeypatch):
    monkeypatch.setattr(topk, "CROWD", 2)
    rng = np.random.default_rng(9)
    songs, users = vectors(rng, "song_id", 64, 2), vectors(rng, "user_id", 90, 2, copies=80)
    index = index_items(spark.createDataFrame(songs), "song_id", ["f0", "f1"], broadcast_rows=0, chunk_rows=8)
    assert found(top_k(spark.createDataFrame(users), index, k=3)) == brute_force(users, songs, 3)


def test_fewer_items_than_asked_for(spark):
    rng = np.random.default_rng(10)
    songs, users = vectors(rng, "song_id", 3, 2), vectors(rng, "user_id", 4, 2)
    for options in PLANS.values():
        index = index_items(spark.createDataFrame(songs), "song_id", ["f0", "f1"], **options)
        assert found(top_k(spark.createDataFrame(users), index, k=10)) == brute_force(users, songs, 10)


def test_no_items(spark):
    songs = spark.createDataFrame([], "song_id string, f0 double")
    users = spark.createDataFrame([("u", 1.0)], "user_id string, f0 double")
    assert top_k(users, index_items(songs, "song_id", ["f0"]), k=2).count() == 0


def test_chunks_hold_equal_numbers_of_rows(spark):
    rng = np.random.default_rng(11)
    songs = vectors(rng, "song_id", 1000, 3, copies=400)
    index = index_items(spark.createDataFrame(songs), "song_id", ["f0", "f1", "f2"], broadcast_rows=0, chunk_rows=32)
    assert index.directory.rows.max() == 32 and index.directory.rows.sum() == 1000
    members = index.chunks.members.groupBy("target").count().toPandas()
    assert sorted(members["count"]) == sorted(index.directory.rows)


def test_two_levels_of_directory(spark):
    """A directory of a few entries: nodes over chunks, and no group of more rows than a chunk has."""
    rng = np.random.default_rng(13)
    songs, users = vectors(rng, "song_id", 600, 3, copies=200), vectors(rng, "user_id", 40, 3)
    for metric in ("cosine", "dot"):
        index = index_items(spark.createDataFrame(songs), "song_id", ["f0", "f1", "f2"], metric=metric, broadcast_rows=0, chunk_rows=8, directory_entries=16)
        chunks = index.chunks.children.count()
        assert len(index.directory.rows) < chunks / 4 and index.directory.rows.sum() == 600
        assert index.chunks.children.agg({"rows": "max"}).first()[0] == 8
        assert found(top_k(spark.createDataFrame(users), index, k=5)) == brute_force(users, songs, 5, metric)
        seen = [(f"u{i}", s) for i in range(9) for s in songs.song_id[i::2]]
        exclude = spark.createDataFrame(seen, "user_id string, song_id string")
        assert found(top_k(spark.createDataFrame(users), index, k=5, exclude=exclude)) == brute_force(users, songs, 5, metric, exclude=seen)


def test_more_open_chunks_than_travel(spark, monkeypatch):
    monkeypatch.setattr(topk, "MOST_OPEN", 3)
    rng = np.random.default_rng(14)
    songs, users = vectors(rng, "song_id", 300, 8), vectors(rng, "user_id", 20, 8)
    index = index_items(spark.createDataFrame(songs), "song_id", [f"f{i}" for i in range(8)], broadcast_rows=0, chunk_rows=16)
    assert found(top_k(spark.createDataFrame(users), index, k=6)) == brute_force(users, songs, 6)


class Visits:
    """Collects what each round asks for and gets."""

    def __init__(self, monkeypatch):
        self.asked, self.got = [], []
        plain = topk.visited

        def spy(asked, *rest):
            self.asked.append(asked.select("user", "target").toPandas())
            hits = plain(asked, *rest)
            self.got.append(hits.selectExpr("user", "size(best) AS hits").toPandas())
            return hits

        monkeypatch.setattr(topk, "visited", spy)


def test_bounds_leave_few_chunks_at_rank_ten(spark, monkeypatch):
    """100,000 vectors of non-negative factors: at most 30 % of the chunks are visited, none twice, and finished users rest."""
    rng = np.random.default_rng(15)
    names = [f"f{i}" for i in range(10)]
    songs = pd.DataFrame(np.abs(rng.normal(size=(100_000, 10))), columns=names).assign(song_id=np.arange(100_000))
    users = pd.DataFrame(np.abs(rng.normal(size=(60, 10))), columns=names).assign(user_id=np.arange(60))
    index = index_items(spark.createDataFrame(songs), "song_id", names, metric="dot", broadcast_rows=0)
    assert index.directory.rows.max() <= topk.CROWD and index.chunks.children is None
    visits = Visits(monkeypatch)
    result = found(top_k(spark.createDataFrame(users), index, k=10))
    scores = users[names].to_numpy() @ songs[names].to_numpy().T
    best = np.argsort(-scores, axis=1, kind="stable")[:, :10]
    assert result == sorted((u, int(s), r + 1) for u in range(60) for r, s in enumerate(best[u]))
    asked = pd.concat(visits.asked)
    assert not asked.duplicated().any()
    assert len(asked) / 60 <= 0.3 * len(index.directory.rows)
    for before, after in zip(visits.asked, visits.asked[1:]):
        assert set(after.user) <= set(before.user)


def test_heavy_user_gets_k_rows_from_each_chunk(spark, monkeypatch):
    """A user who has seen a quarter of all songs, the best ones: masked in the chunk, not fetched and dropped."""
    rng = np.random.default_rng(16)
    names = ["f0", "f1", "f2"]
    songs, users = vectors(rng, "song_id", 20_000, 3), vectors(rng, "user_id", 6, 3)
    u, x = users[names].to_numpy()[0], songs[names].to_numpy()
    nearest = np.argsort(-(x @ u) / np.linalg.norm(x, axis=1))[:5000]
    seen = [("u0", songs.song_id[i]) for i in nearest] + [("u1", "s5"), ("u2", "unknown")]
    exclude = spark.createDataFrame(seen, "user_id string, song_id string")
    want = brute_force(users, songs, 10, exclude=seen)
    for options in ({}, {"broadcast_rows": 0}):
        index = index_items(spark.createDataFrame(songs), "song_id", names, **options)
        visits = Visits(monkeypatch)
        assert found(top_k(spark.createDataFrame(users), index, k=10, exclude=exclude)) == want
        assert all(got.hits.max() <= 10 for got in visits.got if len(got))


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_feature(spark, bad):
    songs = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, bad)], "song_id string, f0 double, f1 double")
    with pytest.raises(PySparkException, match="null or NaN in feature column f1"):
        index_items(songs, "song_id", ["f0", "f1"])
    users = spark.createDataFrame([("u", 1.0, 0.0)], "user_id string, f0 double, f1 double")
    index = index_items(songs, "song_id", ["f0", "f1"], on_missing="zero")
    assert found(top_k(users, index, k=1)) == [("u", "b", 1)]


def test_plan_pairs_nothing_across(spark):
    rng = np.random.default_rng(12)
    songs, users = vectors(rng, "song_id", 200, 3), vectors(rng, "user_id", 30, 3)
    for options in PLANS.values():
        index = index_items(spark.createDataFrame(songs), "song_id", ["f0", "f1", "f2"], **options)
        result = top_k(spark.createDataFrame(users), index, k=3)
        plan = result._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_users_travel_once_per_run_and_carry_no_open_lists(spark, monkeypatch):
    """On vectors whose bounds close little: a user is sent once for all chunks of a run, in few rounds."""
    rng = np.random.default_rng(17)
    names = [f"f{i}" for i in range(12)]
    songs, users = vectors(rng, "song_id", 8_000, 12), vectors(rng, "user_id", 40, 12)
    index = index_items(spark.createDataFrame(songs), "song_id", names, broadcast_rows=0, chunk_rows=32)
    plain, sent, asked_for = topk.visited, [], []

    def spy(asked, *rest):
        sent.append(asked.rows.count())
        asked_for.append(asked.select("user", "target").count())
        return plain(asked, *rest)

    monkeypatch.setattr(topk, "visited", spy)
    assert found(top_k(spark.createDataFrame(users), index, k=5)) == brute_force(users, songs, 5)
    runs = len(set((index.directory.target >> index.chunks.run_bits).tolist()))
    assert len(sent) <= 3 and max(sent) <= 40 * runs
    assert sum(asked_for) > 4 * sum(sent)


def test_common_bounds_hold_for_every_user_and_tell_directions_apart():
    rng = np.random.default_rng(21)

    def around(rows, spread):
        found = np.concatenate([np.full((rows, 1), 50.0), rng.normal(0, spread, (rows, 5))], axis=1)
        return found / np.linalg.norm(found, axis=1, keepdims=True)

    # Songs of about one direction in small chunks, users in a narrow part of it.
    facts = [facts_of(c + rng.normal(0, 1e-4, (16, 6))) for c in around(800, 2.0)]
    columns = {n: np.array([f[n] for f in facts]) for n in FACTS if n != "first_key"}
    known = Directory(target=np.arange(800), first_key=pa.array(["s"] * 800), **columns)
    users = around(64, 0.3)
    common, each = known.common_bounds(users), known.bounds(users)
    assert (common >= each.max(axis=0) - 1e-12).all()
    # As by single users but for the angle between them: by distance alone nearly all entries would stay.
    floor = np.sort(each, axis=1)[:, -10].min()
    assert (common >= floor).sum() < 250
    assert (each.max(axis=0) + np.linalg.norm(users - users.mean(axis=0), axis=1).max() >= floor).sum() > 700


def test_first_rounds_choose_among_bounded_entries(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHOICE", (3, 5))
    rng = np.random.default_rng(22)
    songs, users = vectors(rng, "song_id", 400, 3, copies=90), vectors(rng, "user_id", 40, 3)
    index = index_items(spark.createDataFrame(songs), "song_id", ["f0", "f1", "f2"], broadcast_rows=0, chunk_rows=4)
    data = users[["f0", "f1", "f2"]].to_numpy()
    for turn, most in enumerate((3, 5)):
        entries, beyond = topk._candidates(index.directory, data, np.full(40, -np.inf), turn)
        assert len(entries) == most and np.isfinite(beyond)
    # What is left out is looked at in the last rounds.
    assert found(top_k(spark.createDataFrame(users), index, k=7)) == brute_force(users, songs, 7)


def test_search_sends_no_members_or_masks_through_the_driver(spark, monkeypatch):
    plans, visited, materialize = [], topk.visited, topk.materialize

    def told(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    monkeypatch.setattr(topk, "visited", lambda *args: told(visited(*args)))
    monkeypatch.setattr(topk, "materialize", lambda df, purpose, *rest: materialize(told(df) if purpose == "masks" else df, purpose, *rest))
    rng = np.random.default_rng(23)
    songs, users = vectors(rng, "song_id", 60, 2), vectors(rng, "user_id", 10, 2)
    index = index_items(spark.createDataFrame(songs), "song_id", ["f0", "f1"], broadcast_rows=0, chunk_rows=8)
    seen = [("u1", "s3"), ("u2", "s4")]
    result = top_k(spark.createDataFrame(users), index, k=2, exclude=spark.createDataFrame(seen, "user_id string, song_id string"))
    assert found(result) == brute_force(users, songs, 2, exclude=seen)
    assert len(plans) > 1 and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("hidden", [False, True])
def test_a_block_of_equal_scores_is_cut_before_it_is_sorted(monkeypatch, hidden):
    random = np.random.default_rng(5)
    items = np.round(random.normal(size=(300, 2))).repeat(2, axis=0)  # few values, so many equal scores
    users = np.vstack([np.round(random.normal(size=(40, 2))), np.zeros((1, 2))])
    pairs = np.nonzero(random.random((len(users), len(items))) < 0.3) if hidden else None
    floor = np.where(np.arange(len(users)) % 2 == 0, -np.inf, 0.0)
    most, sort = [], np.lexsort
    monkeypatch.setattr(kernels.np, "lexsort", lambda keys: most.append(len(keys[0])) or sort(keys))
    row, item, score, rank = (np.concatenate(x) for x in zip(*kernels.best_matches(users, items, 7, floor, False, pairs), strict=True))
    assert max(most) <= 7 * len(users)
    scores = users @ items.T
    if hidden:
        scores[pairs] = -np.inf
    want = []
    for u in range(len(users)):
        reach = np.flatnonzero(scores[u] >= max(floor[u], np.finfo(float).min))
        want += [(u, i, scores[u, i], n) for n, i in enumerate(reach[sort((reach, -np.round(scores[u, reach], 9)))][:7])]
    assert list(zip(row, item, rank, strict=True)) == [(u, i, n) for u, i, _, n in want]
    assert np.allclose(score, [s for _, _, s, _ in want])


def test_lists_of_seen_items_go_on_over_batches():
    random = np.random.default_rng(2)
    rows = sorted((f"u{random.integers(6)}", int(random.integers(3)), n) for n in range(200))
    table = pa.table({"user": [r[0] for r in rows], "run": [r[1] for r in rows], "item": [r[2] for r in rows]})
    want = {}
    for user, run, item in rows:
        want.setdefault((user, run), []).append(item)
    for size in (1, 7, 1000):
        found = [r for b in topk._lists(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert {(r["user"], r["run"]): r["mask"] for r in found} == want and len(found) == len(want)
    assert not list(topk._lists(iter([])))


@pytest.mark.parametrize("kind", ["string", "long", "double"])
def test_masks_of_keys_of_any_kind(spark, kind):
    items = spark.range(64).select("id", F.cos("id").alias("p"), F.sin("id").alias("q"))
    index = index_items(items, "id", ["p", "q"], broadcast_rows=0, chunk_rows=4)
    users = spark.range(5).select(F.col("id").cast(kind).alias("user_id"), F.cos("id").alias("p"), F.sin("id").alias("q"))
    # Repeated pairs, unknown items, and nulls on both sides change nothing.
    seen = spark.range(5).join(spark.range(40).withColumnRenamed("id", "n")).select(F.col("id").cast(kind).alias("user_id"), ((F.col("id") + F.col("n")) % 20).alias("id"))
    odd = spark.createDataFrame([(None, 1), ("1", None), ("1", 1000)], "user_id string, id long").select(F.col("user_id").cast(kind), "id")
    found = top_k(users, index, k=64, exclude=seen.unionByName(odd))
    assert {(float(r["user_id"]), r["id"]) for r in found.collect()} == {(float(u), i) for u in range(5) for i in range(20, 64)}


def test_masks_are_cut_from_sorted_rows(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(topk, "materialize", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or materialize(df, *a))
    items = spark.range(64).select("id", F.cos("id").alias("p"), F.sin("id").alias("q"))
    index = index_items(items, "id", ["p", "q"], broadcast_rows=0, chunk_rows=4)
    users = items.select(F.col("id").cast("string").alias("user_id"), "p", "q")
    top_k(users, index, k=2, exclude=users.select("user_id", F.col("user_id").cast("long").alias("id")))
    masks = [p for p in plans if "AS run" in p and "item" in p and "MapInArrow" in p and "collect_set" not in p]
    assert masks and not any("collect_set" in p for p in plans)
