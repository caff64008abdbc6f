"""Centroid clustering and the Voronoi join against brute force in whole numbers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import centroids, voronoi
from encore.llm.centroids import centroid_clusters
from encore.llm.voronoi import top_products

SCHEMA = "vec_id long, embedding array<float>, cluster int, score double, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 5, 0.5, "x") for i, v in rows], SCHEMA)


def test_transform_is_exact():
    chance = np.random.default_rng(1)
    rows = chance.integers(-(1 << 20), 1 << 20, (50, 64))
    waves = centroids.transformed(rows)
    assert (centroids.restored(waves) == rows).all()
    assert ((waves**2).sum(axis=1) == 64 * (rows**2).sum(axis=1)).all()
    assert (waves[:, 0] == rows.sum(axis=1)).all()


@pytest.mark.parametrize("largest", [10, 1000, 1 << 24])
def test_progressive_search_is_exact(largest):
    chance = np.random.default_rng(2)
    rows, centres = chance.integers(-largest, largest, (300, 64)), chance.integers(-largest, largest, (8, 64))
    centres[5] = centres[2]  # ties go to the smaller number
    rows[:20] = centres[chance.integers(0, 8, 20)]
    far = ((rows[:, None].astype(object) - centres[None].astype(object)) ** 2).sum(axis=2)
    best, distance, _ = centroids.nearest(centroids.transformed(rows), centroids.transformed(centres))
    assert (best == far.argmin(axis=1)).all()
    assert (distance // 64 == far.min(axis=1)).all()


def test_search_drops_far_centres_early():
    chance = np.random.default_rng(3)
    centres = chance.normal(0, 1000, (8, 64)).astype(np.int64)
    rows = centres[chance.integers(0, 8, 500)] + chance.integers(-20, 20, (500, 64))
    _, _, finished = centroids.nearest(centroids.transformed(rows), centroids.transformed(centres))
    assert finished == 500  # of 4,000 pairs


def plain_clusters(rows, clusters=8, rounds=10):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    starts = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in starts[:clusters]]

    def closest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        placed = [(closest(v)[1], v) for _, v in kept]
        for n in range(len(centres)):
            if mine := [v for c, v in placed if c == n]:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    final = [(i, *closest(v)[::-1]) for i, v in kept]
    held = {n: sum(d for _, c, d in final if c == n) for n in range(len(centres))}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, held[c], sum(held.values()), shas[c]) for i, c, d in final), key=repr)


def clustered(spark, rows, **options):
    return sorted((tuple(r) for r in centroid_clusters(frame(spark, rows), **options).collect()), key=repr)


def odd_vectors():
    chance = np.random.default_rng(4)
    rows = [(int(i), chance.normal(0, 0.1, 64)) for i in chance.permutation(120)]
    common = chance.normal(0, 0.1, 64)
    rows += [(200 + n, common) for n in range(60)] + [(200, common), (None, rows[0][1]), (None, common)]
    return rows + [
        (300, None), (301, []), (302, common[:63]), (303, [None, *common[1:]]), (304, [float("nan"), *common[1:]]),
        (305, [float("inf"), *common[1:]]), (306, np.zeros(64)),
    ]


def test_clusters_equal_plain_python(spark):
    rows = odd_vectors()
    assert clustered(spark, rows) == plain_clusters(rows)


def test_fewer_vectors_than_clusters(spark):
    rows = odd_vectors()[:3]
    assert clustered(spark, rows) == plain_clusters(rows)
    assert clustered(spark, []) == [] and clustered(spark, [(1, None)]) == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="or more"):
        clustered(spark, [(1, [3e38] * 64)])


def plain_products(rows, k=10):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, q in {(i, tuple(v)) for i, v in kept if i is not None and i % 100 == 0}:
        scored = [(-sum(a * b for a, b in zip(q, v, strict=False)), j is None, j or 0) for j, v in kept if j != i]
        out += [(i, n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(spark, rows, **options):
    return sorted((tuple(r) for r in top_products(frame(spark, rows), F.col("vec_id") % 100 == 0, **options).collect()), key=repr)


def test_products_equal_brute_force(spark, monkeypatch):
    rows = odd_vectors() + [(400, odd_vectors()[0][1]), (500, [0.5, -2.0]), (600, np.zeros(64)), (0, odd_vectors()[1][1] * 3)]
    want = plain_products(rows)
    assert found(spark, rows) == want
    monkeypatch.setattr(voronoi, "PART_ROWS", (8, 8))
    assert found(spark, rows, groups=3) == want
    monkeypatch.setattr(voronoi, "GROUP", 2)
    assert found(spark, rows, groups=2) == want


def test_products_without_queries_or_candidates(spark):
    assert found(spark, []) == [] and found(spark, [(1, [1.0])]) == []
    assert found(spark, [(100, [1.0])]) == [] and found(spark, [(100, [])]) == []
    assert found(spark, [(100, [1.0]), (7, [2.0])]) == [(100, 1, 7, 2 * 1024 * 1024)]


def test_wide_numbers_stay_exact():
    queries = np.array([[(1 << 30) + 1, 3], [-5, 7]])
    rows = np.array([[1 << 30, 1], [(1 << 29) + 3, -1]])
    assert voronoi._products(queries, rows).tolist() == [[sum(int(a) * int(b) for a, b in zip(q, r, strict=True)) for r in rows] for q in queries]


def test_only_needed_rows_are_copied(spark, monkeypatch):
    """Tight groups far apart: a query group asks for the rows of few cells."""
    chance = np.random.default_rng(6)
    places = np.eye(16)[:, :16] * 1.0
    rows = [(i, places[i % 16] + chance.normal(0, 0.01, 16)) for i in range(1600)]
    df = frame(spark, [(i * 25, v) for i, v in rows])
    asks = F.col("vec_id") % 100 == 0
    needed, plain = [], voronoi._needed

    def spy(reach, cells, k):
        needed.append((plain(reach, cells, k), reach["group"].nunique(), cells))
        return needed[0][0]

    monkeypatch.setattr(voronoi, "_needed", spy)
    got = sorted((tuple(r) for r in top_products(df, asks, groups=40).collect()), key=repr)
    assert got == plain_products([(i * 25, v) for i, v in rows])
    pairs, groups, cells = needed[0]
    held = cells.groupby("cell")["rows"].max()
    assert sum(held[c] for c, _, _ in pairs) < 0.25 * groups * held.sum()
