"""Exact k-means on integer vectors of 64 components with progressive Walsh-Hadamard search.

The Walsh-Hadamard transform H keeps distances up to the factor 64 and is exact on integers, so vectors are stored
transformed and everything happens there: squared differences of coefficients are summed coarse to fine, and a centroid
whose sum so far is already above the whole distance of another is strictly worse and drops out. Those left finish all 64
coefficients. H is linear, so the sums of a cluster's transformed vectors give its mean after one inverse transform.

A round is one pass over the stored vectors. Tasks return at most one row of sums per cluster, and the driver holds the
centroids (k x 64 numbers) and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.integers import integers, matrix, usable
from encore.storage import materialize

DIMS = 64
SCALE = 1024
ROUNDS = 10
CLUSTERS = 8
# Coefficients summed before each elimination.
EDGES = (0, 1, 2, 4, 8, 16, 32, 64)
LEADER_AFTER = 8
# Components below this leave room for 64 squared differences of coefficients in 64 bits.
SMALL = 1 << 21


def _butterfly(values: np.ndarray) -> np.ndarray:
    """Hadamard transform of each row, natural order; its own inverse up to the factor 64."""
    half = 1
    while half < DIMS:
        pairs = values.reshape(len(values), -1, 2, half)
        values = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(values), DIMS)
        half *= 2
    return values


def _sequency() -> np.ndarray:
    """Natural positions by number of sign changes: slow waves first."""
    rows = _butterfly(np.eye(DIMS, dtype=np.int64))
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


COARSE_FIRST = _sequency()


def transformed(values: np.ndarray) -> np.ndarray:
    """Coefficients of each row, coarse first; exact."""
    return _butterfly(values)[:, COARSE_FIRST]


def restored(coefficients: np.ndarray) -> np.ndarray:
    """The rows whose coefficients these are; exact."""
    natural = np.empty_like(coefficients)
    natural[:, COARSE_FIRST] = coefficients
    return _butterfly(natural) // DIMS


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centre, 64 times the squared distance, pairs that finished) for transformed rows.

    Ties go to the smaller number: only strictly worse centres are dropped, and one that ties finishes all coefficients.
    """
    if max(np.abs(rows).max(initial=0), np.abs(centres).max(initial=0)) >= SMALL * DIMS:
        rows, centres = rows.astype(object), centres.astype(object)
    sums = np.zeros((len(rows), len(centres)), rows.dtype)
    alive = np.ones(sums.shape, bool)
    for low, high in zip(EDGES, EDGES[1:], strict=False):
        row, centre = np.nonzero(alive)
        gap = rows[row, low:high] - centres[centre, low:high]
        sums[row, centre] += (gap * gap).sum(axis=1)
        if high == LEADER_AFTER:
            lead = centres[sums.argmin(axis=1)]
            bound = ((rows - lead) ** 2).sum(axis=1)
        if high >= LEADER_AFTER:
            alive &= sums <= bound[:, None]
    sums[~alive] = np.iinfo(np.int64).max
    best = sums.argmin(axis=1)
    return best, sums[np.arange(len(rows)), best], int(alive.sum())


def _moving(centres: np.ndarray):
    """Per task and cluster: rows and sums of coefficients."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centres), np.int64), np.zeros((len(centres), DIMS), np.int64)
        for batch in batches:
            rows = matrix(batch.column("wave"), DIMS)
            best, _, _ = nearest(rows, centres)
            for cluster in np.unique(best):
                mine = rows[best == cluster]
                count[cluster] += len(mine)
                total[cluster] += mine.sum(axis=0)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(held, pa.int32()), "rows": pa.array(count[held]), "total": pa.array(list(total[held]), pa.list_(pa.int64())),
        })

    return run


def _placing(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, far, _ = nearest(matrix(batch.column("wave"), DIMS), centres)
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "cluster": pa.array(best, pa.int32()), "distance": pa.array((far // DIMS).tolist(), pa.int64()),
            })

    return run


def _waves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = transformed(matrix(batch.column("whole"), DIMS))
        yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "wave": pa.array(list(found), pa.list_(pa.int64()))})


def centroid_clusters(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3,
) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector.

    A vector is used if it has exactly 64 components, none null or non-finite; each becomes `floor(1024 * x)`. Centroids
    start as the `clusters` vectors with the smallest SHA-256 of `<seed>:<key>`. A round moves every centroid that holds
    vectors to the floor of their mean; empty ones stay. Everything is exact: distances and sums are whole numbers.

    Edge cases: fewer vectors than clusters give as many clusters. Repeated rows count and are returned each. Rows with a
    null key take part; as starts they come last. Equal hashes start in the order of their components. No usable vector
    gives an empty result. Components of 2^31 or more after scaling, and distances or sums beyond a long, are errors, never
    wrong numbers. Other columns are ignored.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    whole = named.filter((F.size("vector") == DIMS) & usable("vector")).select("key", integers("vector", SCALE).alias("whole"))
    kind = named.schema["key"].dataType.simpleString()
    stored = materialize(whole.mapInArrow(_waves, f"key {kind}, wave array<bigint>"), "waves")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    first = whole.orderBy(hashed.asc_nulls_last(), "whole").limit(clusters).collect()
    if not first:
        empty = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], f"`{key}` {kind}, {empty}")
    centres = np.array([r["whole"] for r in first], np.int64)
    for _ in range(rounds):
        moving = stored.mapInArrow(_moving(transformed(centres)), "cluster int, rows bigint, total array<bigint>")
        parts = moving.select("cluster", "rows", F.posexplode("total").alias("at", "part"))
        sums = parts.groupBy("cluster", "at").agg(F.sum("rows").alias("rows"), F.sum("part").alias("total")).orderBy("cluster", "at").collect()
        moved = centres.copy()
        for first in range(0, len(sums), DIMS):
            total = np.array([[r["total"] for r in sums[first : first + DIMS]]], object)
            moved[sums[first]["cluster"]] = restored(total)[0] // sums[first]["rows"]
        if (moved == centres).all():
            break  # all further rounds would repeat this one
        centres = moved
    placed = materialize(stored.mapInArrow(_placing(transformed(centres)), f"key {kind}, cluster int, distance bigint"), "placed")
    held = {r["cluster"]: r["inertia"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    facts = [
        (int(c), held[c], sum(held.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for c in sorted(held)
    ]
    told = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(told), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
