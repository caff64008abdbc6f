"""A catalogue of vectors cut into chunks of neighbours, and the directory that tells which chunks can hold a good item.

A tree of splits along the widest direction, learned from a bounded sample, gives every item a cell. Items are sorted by
cell over the whole table and cut into chunks of at most a fixed number of rows, however large the catalogue is. Each
chunk has a few facts from which an upper bound of a product with any of its items follows. The directory that all tasks
know is bounded in bytes: a catalogue with more chunks gets a second level, whose nodes stand for a few neighbouring
chunks each, with the facts of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.kernels import vector_rows
from encore.storage import materialize

CHUNK_ROWS = 1 << 8
DIRECTORY_BYTES = 8 << 20
SAMPLE_ROWS, SAMPLE_BYTES = 1 << 16, 8 << 20
# Sample rows that a cell needs, so that its share of the catalogue is known well enough.
CELL_SAMPLE = 16
FILE_ROWS = 1 << 16
# Items of the consecutive chunks of a run, and how many chunks one may have.
RUN_ITEMS, MOST_RUN_BITS = 1 << 16, 14
# Partition number and number within: consecutive chunks of a file have consecutive numbers.
NUMBER_BITS = 32
# More than the error of an angle that comes from a cosine in double precision.
ANGLE_SLACK = 4e-8
SLACK = 1e-12
FACTS = ["rows", "first_key", "centre", "radius", "low", "high", "axis", "spread", "longest", "shortest"]


def facts_schema(key: str) -> str:
    lists = {"centre", "low", "high", "axis"}
    types = {"rows": "bigint", "first_key": key} | {n: "array<double>" if n in lists else "double" for n in FACTS[2:]}
    return ", ".join(f"{n} {types[n]}" for n in FACTS)


@dataclass(frozen=True)
class Directory:
    """Facts per chunk or node: mean, ball and box around it, cone around its mean direction, lengths, smallest key."""

    target: np.ndarray
    rows: np.ndarray
    first_key: pa.Array
    centre: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    axis: np.ndarray
    spread: np.ndarray
    longest: np.ndarray
    shortest: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> "Directory":
        columns = {n: table.column(n).combine_chunks() for n in FACTS}
        lists = {n: vector_rows(columns[n]) for n in ("centre", "low", "high", "axis")}
        plain = {n: columns[n].to_numpy(zero_copy_only=False) for n in ("rows", "radius", "spread", "longest", "shortest")}
        return cls(target=table.column("target").to_numpy(), first_key=columns["first_key"], **lists, **plain)

    def subset(self, entries: np.ndarray) -> "Directory":
        """Some of the entries."""
        kept = {f.name: getattr(self, f.name) for f in fields(self)}
        return Directory(**{n: v.take(pa.array(entries)) if isinstance(v, pa.Array) else v[entries] for n, v in kept.items()})

    def bounds(self, users: np.ndarray) -> np.ndarray:
        """Upper bound of the product of every user with any item of every entry (users x entries).

        The least of three: the best corner of the box, the ball around the mean, and the cone around the mean direction
        with the longest item. The box is good in few dimensions, the ball for items near each other, and the cone for
        items of one direction and different lengths.
        """
        length = np.sqrt(np.square(users).sum(axis=1))[:, None]
        corner = np.maximum(users, 0.0) @ self.high.T + np.minimum(users, 0.0) @ self.low.T
        ball = users @ self.centre.T + length * self.radius
        closest = self._closest(users / np.where(length > 0, length, 1.0))
        cone = length * np.where(closest >= 0, self.longest * closest, self.shortest * closest)
        return np.minimum(np.minimum(corner, ball), cone) + SLACK * (1.0 + length * self.longest)

    def common_bounds(self, users: np.ndarray) -> np.ndarray:
        """Upper bound of the product of any of these users with any item of every entry.

        The lesser of two: the bound of the mean user and the distance of the furthest from it, and the cones widened by the
        angle of the furthest, which is far better for items of about one direction.
        """
        centre, lengths = users.mean(axis=0), np.sqrt(np.square(users).sum(axis=1))
        radius = np.sqrt(np.square(users - centre).sum(axis=1).max()) * (1 + SLACK)
        found = self.bounds(centre[None])[0] + radius * self.longest
        length = np.sqrt((centre * centre).sum())
        if not (lengths.min() > 0 and length > 0):
            return found
        reach = np.arccos(np.clip(users @ centre / (lengths * length), -1.0, 1.0)).max() + ANGLE_SLACK
        closest = self._closest(centre[None] / length, reach)[0]
        cone = np.where(closest >= 0, lengths.max() * self.longest * closest, lengths.min() * self.shortest * closest)
        return np.minimum(found, cone + SLACK * (1.0 + lengths.max() * self.longest))

    def _closest(self, directions: np.ndarray, reach: float = 0.0) -> np.ndarray:
        """The cosine of the angle between every direction and the nearest edge of every cone, these widened by `reach`; 1 within
        it. By the cosines and sines of both angles, which is much cheaper than the angles."""
        edge = np.minimum(self.spread + reach + ANGLE_SLACK, np.pi)
        cosine = np.clip(directions @ self.axis.T, -1.0, 1.0)
        beyond = cosine * np.cos(edge) + np.sqrt((1.0 - cosine) * (1.0 + cosine)) * np.sin(edge)
        return np.where(cosine >= np.cos(edge), 1.0, beyond)


def _unit_mean(directions: np.ndarray, weights: np.ndarray) -> np.ndarray:
    mean = (directions * weights[:, None]).sum(axis=0)
    length = np.sqrt((mean * mean).sum())
    return mean / length if length > 1e-9 * max(weights.sum(), 1e-300) else np.zeros_like(mean)


def _angles(axis: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(directions @ axis, -1.0, 1.0)) if axis.any() else np.full(len(directions), np.pi)


def facts_of(items: np.ndarray) -> dict:
    """The facts of some items but for their keys."""
    lengths = np.sqrt(np.square(items).sum(axis=1))
    directions = items[lengths > 0] / lengths[lengths > 0][:, None]
    axis = _unit_mean(directions, np.ones(len(directions)))
    centre = items.mean(axis=0)
    return {
        "rows": len(items), "centre": centre, "radius": np.sqrt(np.square(items - centre).sum(axis=1).max()) * (1 + SLACK),
        "low": items.min(axis=0), "high": items.max(axis=0), "axis": axis, "spread": _angles(axis, directions).max(initial=0.0),
        "longest": lengths.max(), "shortest": lengths.min(),
    }


def merged_facts(known: Directory) -> dict:
    """The facts of all entries together."""
    centre = (known.centre * known.rows[:, None]).sum(axis=0) / known.rows.sum()
    axis = _unit_mean(known.axis, known.rows)
    return {
        "rows": int(known.rows.sum()), "centre": centre,
        "radius": (np.sqrt(np.square(known.centre - centre).sum(axis=1)) + known.radius).max() * (1 + SLACK),
        "low": known.low.min(axis=0), "high": known.high.max(axis=0), "axis": axis,
        "spread": min((_angles(axis, known.axis) + known.spread).max() + ANGLE_SLACK, np.pi),
        "longest": known.longest.max(), "shortest": known.shortest.min(),
    }


@dataclass(frozen=True)
class Splits:
    """A balanced tree: row n of `directions` and `cuts` splits into rows 2n+1 and 2n+2; `along` orders each leaf."""

    directions: np.ndarray
    cuts: np.ndarray
    along: np.ndarray
    depth: int

    def places(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, position along the leaf's widest direction); a row's result does not depend on the rows around it."""
        node = np.zeros(len(items), np.int64)
        for _ in range(self.depth):
            # No matrix product: its sums depend on the block, and copies of one vector must stay together.
            node = 2 * node + 1 + ((items * self.directions[node]).sum(axis=1) > self.cuts[node])
        leaf = node - len(self.cuts)
        return leaf, (items * self.along[leaf]).sum(axis=1)


def _widest(items: np.ndarray) -> np.ndarray:
    """About the direction of the largest variance, by a few steps of power iteration."""
    gaps = items - items.mean(axis=0)
    found = np.sqrt(np.square(gaps).sum(axis=0)) + 1e-12
    for _ in range(8):
        step = gaps.T @ (gaps @ found)
        length = np.sqrt((step * step).sum())
        if length == 0:
            break
        found = step / length
    return found / np.sqrt((found * found).sum())


def split_sample(sample: np.ndarray, depth: int) -> Splits:
    """Median splits of the sample, `depth` levels."""
    inner, width = (1 << depth) - 1, sample.shape[1]
    directions, cuts, along = np.zeros((inner, width)), np.zeros(inner), np.zeros((1 << depth, width))

    def split(node: int, rows: np.ndarray) -> None:
        direction = _widest(sample[rows]) if len(rows) else np.ones(width)
        if node >= inner:
            along[node - inner] = direction
            return
        place = (sample[rows] * direction).sum(axis=1)
        directions[node], cuts[node] = direction, np.median(place) if len(rows) else 0.0
        split(2 * node + 1, rows[place <= cuts[node]])
        split(2 * node + 2, rows[place > cuts[node]])

    split(0, np.arange(len(sample)))
    return Splits(directions, cuts, along, depth)


def sample_rows(vectors: DataFrame, rows: int, width: int) -> pa.Table:
    """(item, v): a sample of bounded size, the same for the same keys, however they are spread."""
    most = min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // (8 * width)))
    share = min(1.0, most / max(rows, 1))
    chosen = vectors if share == 1.0 else vectors.filter(F.pmod(F.xxhash64("item"), F.lit(1 << 40)) < int(share * (1 << 40)))
    return chosen.select("item", "v").limit(2 * most).toArrow()


def _locating(splits: Splits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, along = splits.places(vector_rows(batch.column("v")))
            yield pa.RecordBatch.from_pydict({"item": batch.column("item"), "v": batch.column("v"), "cell": pa.array(leaf, pa.int32()), "along": pa.array(along)})

    return run


def _cutting(chunk_rows: int):
    """Sorted rows to chunks: a new one at a new cell or after `chunk_rows` rows. Its first row carries its facts."""

    def chunk(number: int, rows: pa.Table) -> pa.RecordBatch:
        facts = facts_of(vector_rows(rows.column("v"))) | {"first_key": pc.min(rows.column("item")).as_py()}
        columns = {"target": pa.array(np.full(rows.num_rows, number)), "item": rows.column("item").combine_chunks(), "v": rows.column("v").combine_chunks()}
        for name in FACTS:
            kind = columns["item"].type if name == "first_key" else pa.int64() if name == "rows" else pa.list_(pa.float64()) if np.ndim(facts[name]) else pa.float64()
            columns[name] = pa.array([facts[name]] + [None] * (rows.num_rows - 1), kind)
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, kept = TaskContext.get().partitionId() << NUMBER_BITS, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            cells = rows.column("cell").to_numpy()
            # The last chunk may go on in the next batch.
            starts, begin = [0], 0
            for edge in [*(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]:
                starts += range(begin + chunk_rows, edge, chunk_rows)
                if edge < len(cells):
                    starts.append(edge)
                begin = edge
            for a, b in zip(starts, starts[1:], strict=False):
                yield chunk(number, rows.slice(a, b - a))
                number += 1
            kept = rows.slice(starts[-1])
        if kept is not None and kept.num_rows:
            yield chunk(number, kept)

    return run


def _merging(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One row of facts for the chunks of a node."""
    known = Directory.of(rows)
    facts = merged_facts(known) | {"first_key": pc.min(rows.column("first_key")).as_py()}
    columns = {"target": pa.array([key[0].as_py()], pa.int64())}
    for name in FACTS:
        columns[name] = pa.array([facts[name]], rows.schema.field(name).type)
    return pa.table(columns)


@dataclass(frozen=True)
class Chunks:
    """A stored catalogue: `members` (target, item, v) by chunk, and `children` (node, facts of its chunks) if the directory is of
    nodes. An entry of the directory is a chunk, or a node of 2**levels neighbouring ones; a run is 2**run_bits entries."""

    members: DataFrame
    children: DataFrame | None
    directory: Directory
    levels: int
    run_bits: int

    def entry_of(self, chunk: Column) -> Column:
        return F.shiftright(chunk, self.levels)

    def run(self, entry: Column) -> Column:
        return F.shiftright(entry, self.run_bits)

    def place(self, entry: Column) -> Column:
        return entry.bitwiseAND((1 << self.run_bits) - 1).cast("int")

    def run_of(self, chunk: Column) -> Column:
        return self.run(self.entry_of(chunk))

    def entry_at(self, run: Column, place: Column) -> Column:
        return F.shiftleft(run, self.run_bits) + place


def sort_by_place(vectors: DataFrame, rows: int, width: int, chunk_rows: int, files: int) -> DataFrame:
    """`vectors` (item, v) with cell and place along it, in `files` partitions sorted by these: neighbours follow each other."""
    sample = vector_rows(sample_rows(vectors, rows, width).column("v"))
    cells = min(rows / chunk_rows, len(sample) / CELL_SAMPLE)
    splits = split_sample(sample, max(0, int(np.ceil(np.log2(max(cells, 1.0))))))
    order = ["cell", "along", "item"]
    key = vectors.schema["item"].dataType.simpleString()
    placed = vectors.mapInArrow(_locating(splits), f"item {key}, v array<double>, cell int, along double")
    # The key makes the sort key unique, so copies of one vector cannot pile up in a range.
    return placed.repartitionByRange(files, *order).sortWithinPartitions(*order)


def cut_into_chunks(
    vectors: DataFrame, rows: int, width: int, chunk_rows: int | None = None, directory_entries: int | None = None,
) -> Chunks:
    """`vectors` (item, v) sorted, cut and written; see the module."""
    spark, key = vectors.sparkSession, vectors.schema["item"].dataType.simpleString()
    chunk_rows = chunk_rows or CHUNK_ROWS
    files = max(1, min(rows // chunk_rows, max(partitions(spark), rows // FILE_ROWS)))
    placed = sort_by_place(vectors, rows, width, chunk_rows, files)
    stored = materialize(placed.mapInArrow(_cutting(chunk_rows), f"target bigint, item {key}, v array<double>, {facts_schema(key)}"), "chunks")
    entries = stored.filter("rows IS NOT NULL").select("target", *FACTS)
    most = directory_entries or max(1, DIRECTORY_BYTES // (32 * width + 64))
    levels = max(0, int(np.ceil(np.log2(max(1.0, 2 * rows / chunk_rows / most)))))
    children = None
    if levels:
        children = materialize(entries.select("*", F.shiftright("target", levels).alias("node")), "children")
        entries = children.groupBy("node").applyInArrow(_merging, f"target bigint, {facts_schema(key)}")
    directory = Directory.of(entries.toArrow().sort_by("target"))
    run_bits = min(MOST_RUN_BITS, max(0, int(np.log2(max(1, RUN_ITEMS // (chunk_rows << levels))))))
    # Joins with the members shuffle both sides: files of many alike vectors are small, so the engine would take a large table for
    # a small one and send all of it through the driver, once a round.
    return Chunks(stored.select("target", "item", "v").hint("merge"), children, directory, levels, run_bits)


def partitions(spark: SparkSession) -> int:
    """How many tasks a shuffle of this session has."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
