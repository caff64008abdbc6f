"""Mix sources to target weights by pivotal dependent rounding.

Each source has a target number of words; a document's copies must be whole but average target / source size. All
documents of a source get the whole part of that quotient. The fraction left over is a probability, and pairs of
documents play for it: mass moves, at random, from one side to the other until one side is whole. Leaves of about
`leaf_rows` documents (by hash, so a source with a third of all rows has many) play inside one task; each leaf leaves at
most one undecided document, mostly a short one, and the words of all others add up to what they should. The undecided
meet in groups of `fan_in` leaves, level by level, until one per source is left, which is drawn.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.words import SPARK_WORD
from encore.storage import materialize

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
LEAF_ROWS = 1024
FAN_IN = 256


def word_count(text="text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(SPARK_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source: str, size: str, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per source: its rows, size and target in words.

    Weights repeat over the sources by code point, null last. Targets are shares of all sizes by weight, but none is
    above `max_copies` times its source: target = min(max_copies * size, level * weight). The sources that stop are
    those with the smallest size per weight, so one pass over the sorted sources finds the level.
    """
    sources = sized.groupBy(source).agg(F.sum(size).alias("_source_size"), F.count("*").alias("_rows"))
    order = Window.orderBy(F.col(source).asc_nulls_last())
    number = (F.row_number().over(order) - 1) % len(weights) + 1
    sources = sources.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), number).cast("double"))
    cap = F.col("_source_size") * float(max_copies)
    sources = sources.withColumn("_need", cap / F.col("_weight"))
    everything = Window.partitionBy()
    first = Window.orderBy("_need", F.col(source).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    # The level if all sources before this one in order of need have stopped and this and the later ones have not.
    level = (F.sum("_source_size").over(everything) - F.coalesce(F.sum(cap).over(first), F.lit(0.0))) / (
        F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(first), F.lit(0.0))
    )
    sources = sources.withColumn("_level", level)
    holds = F.when(F.col("_level") <= F.col("_need"), F.col("_need"))
    sources = sources.withColumn("_level", F.min_by("_level", holds).over(everything))
    return sources.select(
        source, F.col("_source_size").alias("source_size"), "_rows",
        F.coalesce(F.least(cap, F.col("_level") * F.col("_weight")), F.lit(0.0)).alias("target"),
    )


def _play(chances: np.ndarray, sizes: np.ndarray, luck: np.ndarray) -> tuple[np.ndarray, int, float]:
    """Pivotal rounding, largest first: (0 or 1 per row, the undecided row or -1, its chance).

    Each document is paired with the pool of the smaller ones. Mass, counted in words, moves one way or the other, with
    odds that leave every chance as it was on average, until the document is at 0 or 1, or a part of the pool is (with
    equal chances, all of it at once); then on with the rest. So a large document is decided first and the smaller ones
    make up for it, and the words of the leaf stay the same throughout. `luck` holds two numbers per row.
    """
    p = np.where(sizes > 0, chances, 0.0)
    p[p < 1e-9], p[p > 1 - 1e-9] = 0.0, 1.0
    draw = 0
    for row in range(len(p)):
        while 0 < p[row] < 1:
            pool = row + 1 + np.flatnonzero((p[row + 1 :] > 0) & (p[row + 1 :] < 1))
            if not len(pool):
                left = float(p[row])
                p[row] = 0.0
                return p.astype(np.int64), row, left
            q = p[pool]
            way = q * (1 - q)
            words = float(way @ sizes[pool]) / sizes[row]
            up, down = min(1 / q.max(), p[row] / words), min(1 / (1 - q).max(), (1 - p[row]) / words)
            step = up if luck[draw % len(luck)] * (up + down) < down else -down
            draw += 1
            p[pool] = q + step * way
            p[row] -= step * words
            p[p < 1e-9], p[p > 1 - 1e-9] = 0.0, 1.0
    return p.astype(np.int64), -1, 0.0


def _round_group(seed: int, level: int):
    def play(table: pa.Table) -> pa.Table:
        order = table.sort_by([("_size", "descending"), ("_key", "ascending")])
        chances = order["_chance"].to_numpy()
        first = int(order["_key"][0].as_py()) & 0xFFFFFFFF
        luck = np.random.default_rng([seed, level, first, len(chances)]).random(2 * len(chances))
        won, holder, left = _play(chances, order["_size"].to_numpy().astype(float), luck)
        chance = np.full(len(won), -1.0)
        if holder >= 0:
            chance[holder] = left
        names = order.column_names
        order = order.set_column(names.index("_chance"), "_chance", pa.array(chance))
        copies = order["_copies"].to_numpy() + won
        return order.set_column(names.index("_copies"), "_copies", pa.array(copies, pa.int64()))

    return play


def _tagged(docs: DataFrame, kept: list[str], source: str, size: str | None, key: str) -> DataFrame:
    """(row, source, size, key, id), written once: ids of rows that are read again stay the same."""
    sized = F.col(size).cast("long") if size else word_count()
    rows = docs.select(F.struct(*kept).alias("row"), F.col(source).alias("source"), sized.alias("size"), F.col(key).alias("key"))
    return materialize(rows.withColumn("id", F.monotonically_increasing_id()), "mix-rows")


def _copies(rows: DataFrame, weights, max_copies: int, seed: int, leaf_rows: int, fan_in: int) -> DataFrame:
    """(id, source_size, target, copies) of rows (id, source, size, key): only numbers pass through the leaves."""
    targets = materialize(source_targets(rows, "source", "size", weights, max_copies).withColumnRenamed("source", "s"), "targets")
    # Rows that key and size do not tell apart would all meet in one leaf: their ids spread them.
    twins = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in ("source", "key", "size")]).agg(F.count("*").alias("_n")).filter("_n > 1")
    same = [rows[c].eqNullSafe(twins[f"_{c}"]) for c in ("source", "key", "size")]
    rows = rows.join(twins, same[0] & same[1] & same[2], "left").select("id", "source", "size", "key", F.when(F.col("_n") > 1, F.col("id")).otherwise(0).alias("twin"))
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("s")))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(share + 1e-12), F.lit(max_copies))
    hashed = F.when(F.col("twin") == 0, F.xxhash64(F.lit(seed), "key", "size")).otherwise(F.xxhash64(F.lit(seed), "key", "size", "twin"))
    rows = joined.select(
        "id", F.col("source").alias("_source"), F.col("size").alias("_size"), "source_size", "target", whole.cast("long").alias("_copies"),
        F.greatest(share - whole, F.lit(0.0)).alias("_chance"), hashed.alias("_key"),
        F.pmod(hashed, F.greatest(F.ceil(F.col("_rows") / leaf_rows), F.lit(1))).alias("_leaf"),
    )
    rows = materialize(rows.groupBy("_source", "_leaf").applyInArrow(_round_group(seed, 0), rows.schema), "mix-0")
    decided = [rows.filter("_chance < 0")]
    most = targets.agg(F.max("_rows")).first()[0] or 0
    leaves, level = math.ceil(most / leaf_rows), 0
    left = rows.filter("_chance >= 0")
    while leaves > 1:
        leaves, level = math.ceil(leaves / fan_in), level + 1
        left = left.withColumn("_leaf", F.floor(F.col("_leaf") / fan_in))
        played = materialize(left.groupBy("_source", "_leaf").applyInArrow(_round_group(seed, level), left.schema), f"mix-{level}")
        decided.append(played.filter("_chance < 0"))
        left = played.filter("_chance >= 0")
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_key")), F.lit(1 << 30)) / float(1 << 30)
    decided.append(left.withColumn("_copies", F.col("_copies") + (draw < F.col("_chance")).cast("long")))
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select("id", "source_size", "target", F.col("_copies").alias("copies"))


def mix_sources(
    docs: DataFrame, source: str = "source", size: str | None = None, key: str = "doc_id", weights=WEIGHTS,
    max_copies: int = MAX_COPIES, seed: int = 7, leaf_rows: int = LEAF_ROWS, fan_in: int = FAN_IN,
) -> DataFrame:
    """`docs` with columns size, source_size, target and copies (0 to `max_copies`); earlier columns of those names go.

    Edge cases: a null source is a source, the last one. Null and empty texts have size 0; a source of size 0 has
    target 0 and its documents no copies. An empty table gives an empty result. Repeated rows are documents of their
    own, each with its own copies. The same rows and seed give the same copies, but for rows of one key and size, whose
    place in the input decides; `key` orders documents of one size.
    """
    own = ["size", "source_size", "target", "copies"]
    rows = _tagged(docs, [c for c in docs.columns if c not in own], source, size, key)
    told = _copies(rows.select("id", "source", "size", "key"), weights, max_copies, seed, leaf_rows, fan_in)
    return rows.join(told.hint("merge"), "id").select("row.*", "size", "source_size", "target", "copies")


def mixed_copies(docs: DataFrame, source: str = "source", key: str = "doc_id", weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 7) -> DataFrame:
    """Every row of `docs` as often as `mix_sources` takes it: all its columns as they were, whatever their names."""
    rows = _tagged(docs, docs.columns, source, None, key)
    told = _copies(rows.select("id", "source", "size", "key"), weights, max_copies, seed, LEAF_ROWS, FAN_IN)
    # One plan at every size: small tables show what large ones will shuffle.
    taken = rows.select("id", "row").join(told.filter("copies > 0").select("id", "copies").hint("merge"), "id")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
