"""SimHash groups, similar documents, components, nearest neighbours."""

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from encore.llm import components as components_module
from encore.llm import simhash
from encore.llm.components import components
from encore.llm.neighbours import PLANS, codes_of, hadamard, nearest_neighbours
from encore.llm.simhash import fingerprint_of, fingerprints, keep_representatives, linked_pairs, near_duplicates, segments
from encore.storage import materialize


def plain_fingerprint(text: str, words: int) -> int:
    parts = text.split()
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or ([" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fingerprint():
    for text in ["", "a", "a b c", "a b c d", "x y z x y z x y z w", " ".join(map(str, range(700)))]:
        assert fingerprint_of(text.encode(), 4) == plain_fingerprint(text, 4)


def test_segments_leave_one_with_one_differing_bit():
    assert sum(w for _, w in segments(4)) == 64
    assert 4 // len(segments(4)) <= 1


def test_linked_pairs_are_all_pairs(spark):
    random.seed(3)
    values = [random.getrandbits(64) for _ in range(150)]
    for value in list(values):
        for bits in (1, 3, 4, 5, 8):
            other = value
            for bit in random.sample(range(64), bits):
                other ^= 1 << bit
            values.append(other)
    values += [0, 1, 2**64 - 1, 2**63]
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    found = linked_pairs(spark.createDataFrame([(v,) for v in signed], "fingerprint long")).collect()
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if bin((a ^ b) & (2**64 - 1)).count("1") <= 4}
    assert sorted(map(tuple, found)) == sorted(want)


def test_no_table_of_near_duplicates_passes_the_driver(spark, monkeypatch):
    # A few kilobytes of fingerprints: the engine takes all of these for small tables.
    plans = []

    def noted(df, *args):
        stored = materialize(df, *args)
        plans.append(plan_of(df))
        return stored

    monkeypatch.setattr(simhash, "materialize", noted)
    monkeypatch.setattr(components_module, "materialize", noted)
    docs = spark.createDataFrame([(i, f"{i % 300} {i // 300} same words in all of the texts") for i in range(600)], "doc_id long, text string")
    plans += [plan_of(near_duplicates(docs)), plan_of(keep_representatives(docs))]
    assert any("Generate" in p for p in plans) and any("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "Broadcast" in p]


def test_dedup_stage_of_the_pipeline_broadcasts_nothing(spark):
    docs = spark.createDataFrame([(i, f"{i % 300} {i // 300} same words in all of the texts", "a") for i in range(600)], "doc_id long, text string, source string")
    assert "Broadcast" not in plan_of(linked_pairs(fingerprints(docs)))
    assert "Broadcast" not in plan_of(corpus_pipeline.near_duplicates(spark, docs, ""))


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (11, 10), (5, 5), (None, 7), *[(100 + i, 101 + i) for i in range(40)], *[(200, 201 + i) for i in range(30)]]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {i: found[i] for i in (1, 2, 3, 4, 10, 11)} == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10}
    assert {found[100 + i] for i in range(41)} == {100} and {found[200 + i] for i in range(31)} == {200}
    assert 5 not in found and 7 not in found
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_near_duplicates_edges(edges, nothing):
    rows = near_duplicates(edges).collect()
    assert len(rows) == edges.count()
    by_key = {r["doc_id"]: r for r in rows}
    assert by_key[2]["fingerprint"] == by_key[3]["fingerprint"] == by_key[4]["fingerprint"] == 0
    assert by_key[4]["component_id"] == 2 and by_key[1]["component_id"] == 1
    assert near_duplicates(nothing).count() == 0


def changed(base: list[str], places) -> str:
    return " ".join(f"x{random.getrandbits(40)}" if i in places else w for i, w in enumerate(base))


def plain_components(texts: list[str]) -> list[int]:
    """Smallest number reachable over fingerprints that differ in 4 bits or fewer."""
    prints = [plain_fingerprint(t, 4) for t in texts]
    group = list(range(len(texts)))
    while True:
        now = [min(group[j] for j in range(len(texts)) if bin(prints[i] ^ prints[j]).count("1") <= 4) for i in range(len(texts))]
        if now == group:
            return group
        group = now


def test_representatives_equal_brute_force(spark):
    random.seed(9)
    bases = [[f"v{random.randrange(3000)}" for _ in range(600)] for _ in range(40)]
    texts = [t for base in bases for t in (" ".join(base), changed(base, {random.randrange(600)}), changed(base, set(random.sample(range(600), 3))), " ".join(base))]
    texts += ["", "one two", " \t"]
    random.shuffle(texts)
    want = plain_components(texts)
    assert 40 < len(set(want)) < 140
    docs = spark.createDataFrame([(i, t, i * 10) for i, t in enumerate(texts)], "doc_id long, text string, told int")
    groups = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert [groups[i] for i in range(len(texts))] == want
    kept = keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"], r["told"]) for r in kept.collect()) == sorted((i, texts[i], i * 10) for i in set(want))


def test_representatives_edges(edges, nothing):
    kept = keep_representatives(edges)
    assert kept.columns == edges.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 1), (False, 2), (False, 5), (False, 6), (False, 8), (True, None)]
    assert keep_representatives(nothing).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)


def brute(ids, x, query, k):
    far = np.sqrt(((x - x[ids.index(query)]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, far)) if ids[i] != query][:k]
    return [(ids[i], far[i]) for i in order]


def test_recall_and_distances(spark):
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = list(range(3000))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    rows = nearest_neighbours(frame, F.col("vec_id") % 100 == 0, group_rows=200).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(found) == list(range(0, 3000, 100))
    hits = 0
    for query, ranks in found.items():
        want = brute(ids, x, query, 10)
        assert sorted(ranks) == list(range(1, 11))
        hits += len({v for v, _ in ranks.values()} & {v for v, _ in want})
        for vec, far in ranks.values():
            assert abs(far - np.sqrt(((x[vec] - x[query]) ** 2).sum())) < 1e-12
    assert hits >= 0.9 * 300


def test_neighbour_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (100, [5e-200, 5e-200]), (8, [1.0, 2.0, 3.0]), (9, []),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, id string, query int")
    found = nearest_neighbours(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in found] == [(0, 1, 100), (0, 2, 1), (0, 3, 2), (100, 1, 0), (100, 2, 1), (100, 3, 2)]
    assert nearest_neighbours(frame.filter("false"), F.col("vec_id") % 100 == 0).count() == 0
    assert nearest_neighbours(frame.filter("vec_id = 1"), F.lit(True)).count() == 0


def test_two_hashes_find_most_among_few_rows():
    """Vectors without structure, whose tenth neighbour lies at 1.1 and all others at 1.4."""
    chance = np.random.default_rng(8)
    x = chance.normal(size=(10000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    far = np.linalg.norm(x[:100, None] - x[None], axis=2)
    far[np.arange(100), np.arange(100)] = np.inf
    want = np.argsort(far, axis=1)[:, :10]
    tables, probes = PLANS[2]
    index, looks = codes_of(x, tables, 2, 1), codes_of(x[:100], tables, 2, probes)
    assert (looks[:, :, 0] == index[:100, :, 0]).all() and len(np.unique(looks[0, 0])) == probes
    seen = np.array([
        np.any([np.isin(index[:, t, 0], looks[q, t]) for t in range(tables)], axis=0) for q in range(100)
    ])
    assert seen.mean() < 0.16
    assert np.take_along_axis(seen, want, 1).mean() >= 0.9


def test_probes_are_the_nearest_codes():
    x = np.random.default_rng(9).normal(size=(20, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    every = codes_of(x, 3, 2, 1000)
    assert every.shape == (20, 3, 64) and (np.sort(every, axis=2) == np.arange(64)).all()
    assert (codes_of(x, 3, 2, 5) == every[:, :, :5]).all()


def test_neighbours_of_copies_and_crowds(spark):
    """Equal vectors, equal queries, a crowd of near copies and one of queries, in groups that are much smaller."""
    chance = np.random.default_rng(10)
    x = chance.normal(size=(900, 8))
    x[200:500] = x[0]
    x[500:800] = x[1] + chance.normal(size=(300, 8)) * 1e-6
    ids = [int(i) for i in chance.permutation(900)]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    rows = {}
    for r in nearest_neighbours(frame, F.col("vec_id") % 2 == 0, hashes=2, group_rows=40).collect():
        rows.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(rows) == [i for i in range(900) if i % 2 == 0]
    place = {i: n for n, i in enumerate(ids)}
    hits = 0
    for query, ranks in rows.items():
        far = np.sqrt(((x - x[place[query]]) ** 2).sum(axis=1))
        want = sorted((far[place[i]], i) for i in ids if i != query)[:10]
        got = [ranks[n + 1][::-1] for n in range(10)]
        hits += len({i for _, i in got} & {i for _, i in want})
        assert got == sorted(got)
        if 200 <= place[query] < 500:
            assert got == [(0.0, i) for i in sorted([ids[0], *ids[200:500]]) if i != query][:10]
    assert hits >= 0.9 * 10 * len(rows)


def test_neighbours_do_not_depend_on_the_number_of_rows(spark):
    """8,000 more rows, too far away to be anybody's neighbours, change nothing; nearly all neighbours are found."""
    rng = np.random.default_rng(23)
    near, far = rng.normal(size=(600, 16)), 1e4 * rng.normal(size=(8_000, 16))

    def told(vectors):
        frame = spark.createDataFrame(pa.table({"vec_id": np.arange(len(vectors)), "embedding": vectors.tolist()}))
        rows = nearest_neighbours(frame, (F.col("vec_id") % 20 == 0) & (F.col("vec_id") < 600)).collect()
        return sorted((r.query_id, r.rank, r.vec_id) for r in rows)

    few = told(near)
    assert few == told(np.concatenate([near, far]))
    gaps = np.linalg.norm(near[::20, None] - near[None], axis=2)
    want = {(20 * q, int(i)) for q, row in enumerate(gaps) for i in np.argsort(row, kind="stable")[1:11]}
    assert len(want & {(q, i) for q, _, i in few}) >= 0.9 * len(want)
