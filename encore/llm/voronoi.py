"""Exact top-k by integer inner product as a Voronoi join.

Queries and data are grouped by their nearest pivot. Summaries bound every inner product between a query group i and a row
x of data cell j with pivot p: the queries' products with p lie in [low_ij, high_ij], and x lies `far` from p, so a
product is at most high_ij + longest_i * far and at least low_ij - longest_i * far. The k + 1 rows closest to each pivot
thus give a floor that the k-th best product of every query of the group reaches, and a row goes to a query group only if
its upper bound reaches that floor. Inside a group the products are exact integers.

Query groups are split above GROUP queries and their data into parts of bounded size, so no task gets an unbounded group,
however many rows share a vector or a pivot.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.integers import integers, matrix, usable
from encore.storage import materialize

SCALE = 1024
GROUP = 1 << 13  # queries of a group
PART_ROWS = (1 << 11, 1 << 16)  # rows of a part, least and most
PIVOTS = 256
SAMPLE = 4
ENTRIES = 1 << 18  # pairs of query group and data cell that tasks get to know
SCORES = 1 << 20  # products held at a time
SLACK = 1e-9


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, distance to it) of every row."""
    squares = (pivots * pivots).sum(axis=1)
    cell = np.empty(len(rows), np.int64)
    step = max(1, SCORES // len(pivots))
    for at in range(0, len(rows), step):
        cell[at : at + step] = (2 * (rows[at : at + step] @ pivots.T) - squares).argmax(axis=1)
    return cell, np.sqrt(((rows - pivots[cell]) ** 2).sum(axis=1))


def _celled(pivots: np.ndarray, width: int, keep: list[str]):
    """Adds `cell` and `far`, the distance to the cell's pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = _nearest(matrix(batch.column("x"), width).astype(np.float64), pivots)
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in keep} | {"cell": pa.array(cell, pa.int32()), "far": pa.array(far)})

    return run


def _reach(pivots: np.ndarray, width: int):
    """Per batch, query group and data pivot: least and largest product, and the longest query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, group = matrix(batch.column("x"), width).astype(np.float64), batch.column("group").to_numpy()
            for number in np.unique(group):
                mine = rows[group == number]
                products = mine @ pivots.T
                size = len(pivots)
                yield pa.RecordBatch.from_pydict({
                    "group": pa.array(np.full(size, number), pa.int32()), "cell": pa.array(np.arange(size), pa.int32()),
                    "low": pa.array(products.min(axis=0)), "high": pa.array(products.max(axis=0)),
                    "longest": pa.array(np.full(size, np.sqrt((mine * mine).sum(axis=1).max()))),
                })

    return run


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as int64: in floating point while all sums stay below 2^53, else in whole numbers."""
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(rows).max(initial=0)) * rows.shape[1]
    if largest < 1 << 53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if largest < 1 << 63:
        return queries @ rows.T
    return (queries.astype(object) @ rows.T.astype(object)).astype(np.int64)


def _solve(width: int, k: int):
    """The k best rows of one part for every query of a group."""

    def run(_, asked: pa.Table, part: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and part.num_rows:
            part = part.take(pc.sort_indices(part, [("id", "ascending")], null_placement="at_end"))
            queries, rows = matrix(asked.column("x"), width), matrix(part.column("x"), width)
            known = part.num_rows - part.column("id").null_count
            ids, own = part.column("id").slice(0, known).to_numpy(), asked.column("id").to_numpy()
            step = max(1, SCORES // len(rows))
            for at in range(0, len(queries), step):
                scores = _products(queries[at : at + step], rows)
                # A query never finds rows of its own id.
                first, last = (np.searchsorted(ids, own[at : at + step], side) for side in ("left", "right"))
                for row in np.flatnonzero(last > first):
                    scores[row, first[row] : last[row]] = np.iinfo(np.int64).min
                most = min(k, len(rows))
                cut = np.partition(scores, len(rows) - most, axis=1)[:, len(rows) - most]
                row, col = np.nonzero((scores >= cut[:, None]) & (scores > np.iinfo(np.int64).min))
                order = np.lexsort((col, -scores[row, col], row))
                row, col = row[order], col[order]
                best = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, col = row[best], col[best]
                out.append(pa.table({
                    "q": asked.column("q").take(pa.array(row + at)), "query_id": asked.column("id").take(pa.array(row + at)),
                    "found": part.column("id").take(pa.array(col)), "score": pa.array(scores[row, col]),
                }))
        schema = pa.schema([("q", pa.int64()), ("query_id", asked.schema.field("id").type), ("found", part.schema.field("id").type), ("score", pa.int64())])
        return pa.concat_tables([t.cast(schema) for t in out]) if out else schema.empty_table()

    return run


def _spread_out(rows: DataFrame, count: int) -> np.ndarray:
    """Up to `count` different vectors: of SAMPLE times as many, chosen by the hash of their key, each the one farthest from those before."""
    drawn = rows.orderBy(F.xxhash64("id"), "x").limit(SAMPLE * count).select("x").collect()
    drawn = np.unique(np.array([r["x"] for r in drawn], np.float64), axis=0)
    chosen, far = [0], ((drawn - drawn[0]) ** 2).sum(axis=1)
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((drawn - drawn[chosen[-1]]) ** 2).sum(axis=1))
    return drawn[chosen]


def _needed(reach, cells, k: int) -> list[tuple[int, int, float]]:
    """(cell, group, least distance from the pivot) of the rows that can reach the floor of a query group.

    `reach` has the products of groups with pivots, `cells` the closest rows of every cell with their keys.
    """
    closest = cells.sort_values("far")
    furthest = cells.groupby("cell")["furthest"].max()
    out = []
    for group, facts in reach.groupby("group"):
        facts = facts.set_index("cell")
        longest = facts["longest"].iloc[0]
        sure = facts["low"].reindex(closest["cell"]).to_numpy() - longest * closest["far"].to_numpy()
        # k + 1 different keys, one of which may be the query itself.
        by_key = sorted(_best_of_key(closest["id"], sure).values(), reverse=True)
        floor = by_key[k] if len(by_key) > k else -np.inf
        for cell, far in furthest.items():
            high = facts["high"][cell]
            slack = SLACK * (1 + abs(high) + longest * far)
            least = (floor - high - slack) / longest if longest > 0 else (-np.inf if high + slack >= floor else np.inf)
            if far * (1 + SLACK) >= least:
                out.append((int(cell), int(group), float(least)))
    return out


def _best_of_key(keys, values) -> dict:
    """The largest value per key."""
    best: dict = {}
    for key, value in zip(keys, values, strict=True):
        name = None if key != key else key
        best[name] = max(best.get(name, -np.inf), value)
    return best


def top_products(
    vectors: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = SCALE,
    groups: int | None = None,
) -> DataFrame:
    """(query_id, rank, key, score): the `k` rows of the largest integer inner product for every row that `asks`.

    Components become `floor(scale * x)`. Candidates of a query are all rows of other keys; equal scores rank by key.
    `groups` sets the number of query pivots (by default it grows as the square root of the queries).

    Edge cases: vectors that are null or hold null or non-finite components take no part. Shorter vectors count as filled
    up with zeros. Repeated rows are candidates each; a query row that occurs twice is asked once, and two vectors of one
    key are two queries of that id. A row with a null key is a candidate that ranks last among equals, never a query. No
    queries or no candidates give no rows. Components of 2^31 or more after scaling are an error. Other columns are ignored.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = named.filter(usable("vector")).select("id", (F.col("asks") & F.col("id").isNotNull()).alias("asks"), integers("vector", scale).alias("x"))
    rows = materialize(rows, "integers")
    count, asked, width, narrow = rows.agg(F.count("*"), F.count_if("asks"), F.max(F.size("x")), F.min(F.size("x"))).first()
    kind = named.schema["id"].dataType.simpleString()
    if not asked or not width:
        return spark.createDataFrame([], f"query_id {kind}, rank int, `{key}` {kind}, score bigint")
    if narrow < width:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))))
    groups = groups or max(1, isqrt(asked) // 8)
    data_pivots = _spread_out(rows, max(1, min(PIVOTS, isqrt(count) // 2, ENTRIES // (groups + asked // GROUP))))
    query_pivots = _spread_out(rows.filter("asks"), groups)

    data = rows.select("id", "x").mapInArrow(_celled(data_pivots, width, ["id", "x"]), f"id {kind}, x array<bigint>, cell int, far double")
    data = materialize(data, "cells")
    queries = rows.filter("asks").select("id", "x").distinct().select("id", "x", F.monotonically_increasing_id().alias("q"))
    queries = materialize(queries.mapInArrow(_celled(query_pivots, width, ["q", "id", "x"]), f"q bigint, id {kind}, x array<bigint>, cell int, far double"), "queries")
    sizes = queries.groupBy("cell").count().orderBy("cell").collect()  # at most one row per query pivot
    first, blocks, number = {}, {}, 0
    for cell, size in sizes:
        first[cell], blocks[cell] = number, -(-size // GROUP)
        number += blocks[cell]
    numbered = spark.createDataFrame([(c, first[c], blocks[c]) for c in first], "cell int, first int, blocks int")
    queries = queries.join(F.broadcast(numbered), "cell").select("q", "id", "x", (F.col("first") + F.pmod("q", "blocks")).cast("int").alias("group"))

    schema = "group int, cell int, low double, high double, longest double"
    reach = queries.select("x", "group").mapInArrow(_reach(data_pivots, width), schema)
    reach = reach.groupBy("group", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("longest").alias("longest"))
    reach = reach.withColumn("longest", F.max("longest").over(Window.partitionBy("group"))).toPandas()
    closest = Window.partitionBy("cell").orderBy("far", "id")
    cells = data.select("cell", "far", "id").withColumn("place", F.row_number().over(closest)).filter(F.col("place") <= k + 1)
    sums = data.groupBy("cell").agg(F.count("*").alias("rows"), F.max("far").alias("furthest"))
    cells = cells.join(F.broadcast(sums), "cell").toPandas()
    needed = _needed(reach, cells, k)

    held = cells.groupby("cell")["rows"].max().to_dict()
    part = min(max(count // 64, PART_ROWS[0]), PART_ROWS[1])
    load: dict[int, int] = {}
    for cell, group, _ in needed:
        load[group] = load.get(group, 0) + held[cell]
    parts = {g: -(-n // part) for g, n in load.items()}
    wanted = spark.createDataFrame([(c, g, least, parts[g]) for c, g, least in needed], "cell int, group int, least double, parts int")
    copied = data.withColumn("at", F.monotonically_increasing_id()).join(
        F.broadcast(wanted.withColumnRenamed("cell", "c")), (F.col("cell") == F.col("c")) & (F.col("far") * (1 + SLACK) >= F.col("least"))
    ).select("group", F.pmod("at", "parts").cast("int").alias("part"), "id", "x")
    split = spark.createDataFrame(list(parts.items()), "g int, parts int")
    spread = queries.join(F.broadcast(split), F.col("group") == F.col("g")).select(
        "group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "q", "id", "x"
    )
    solved = (
        spread.groupBy("group", "part").cogroup(copied.groupBy("group", "part"))
        .applyInArrow(_solve(width, k), f"q bigint, query_id {kind}, found {kind}, score bigint")
    )
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.col("found").asc_nulls_last())
    ranked = solved.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("found").alias(key), "score")
