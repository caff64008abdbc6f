"""Near duplicates by 64-bit SimHash and deletion-variant signatures.

A fingerprint has bit i if over half of the hashes of a document's shingles have it. Two fingerprints link at `distance`
or fewer differing bits. Cut into `distance // 2 + 1` segments, one segment differs by at most one bit (five differing
bits would be needed for two in each of three), so every fingerprint is indexed under each segment with each of its bits
blanked in turn, and an equality join finds all pairs. A pair meets in several variants; it is kept in the first of
them only, and the exact distance is checked in the join itself. Equal fingerprints are one row before all this, so a
group of thousands of copies costs one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.components import components
from encore.llm.words import slices, texts_of
from encore.storage import materialize

BITS = 64
DISTANCE = 4
WORDS = 4


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of a text already lower-cased, repeats included; a shorter text is one shingle."""
    parts = text.split()
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    if len(parts) < words:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(parts) - words + 1]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[s:e], seed) for s, e in zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; 0 for none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65280):
        bits = np.unpackbits(hashes[at : at + 65280].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        counts += bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def fingerprint_of(text: bytes, words: int) -> int:
    """Fingerprint of a text already lower-cased; 0 if it holds no word."""
    return majority(shingle_hashes(text, words))


def _fingerprint_batches(words: int, column: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, column):
                # bytes.split() takes exactly the six white characters of the word rule.
                lowered = pc.cast(pc.ascii_lower(texts_of(batch.column(column))), pa.large_binary())
                prints = np.array([fingerprint_of(t.as_py(), words) for t in lowered], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in keep} | {"fingerprint": pa.array(prints)})

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, fingerprint as a long)."""
    docs = docs.select(key, F.col(text).alias("_text"))
    return docs.mapInArrow(_fingerprint_batches(words, "_text", [key]), f"`{key}` {docs.schema[key].dataType.simpleString()}, fingerprint long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment: as few as leave one with at most one differing bit."""
    count = distance // 2 + 1
    edges = [round(i * BITS / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _part(value: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(value, first).bitwiseAND(F.lit((1 << width) - 1))


def _variants(value: Column, cuts: list[tuple[int, int]]) -> Column:
    """Array of (variant, rest): each segment with each of its bits blanked."""
    found = []
    for number, (first, width) in enumerate(cuts):
        part = _part(value, first, width)
        for bit in range(width):
            blank = part.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << bit)))
            found.append(F.struct(F.lit(number * BITS + bit).alias("variant"), blank.alias("rest")))
    return F.array(*found)


def linked_pairs(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b, once each: all pairs of distinct values of column `fingerprint` within `distance` bits."""
    cuts = segments(distance)
    # Spread first: a few megabytes of fingerprints lie in few files, and each becomes as many rows as it has bits.
    spread = prints.select("fingerprint").distinct().repartition("fingerprint")
    index = spread.select("fingerprint", F.inline(_variants(F.col("fingerprint"), cuts)))
    left = index.select(F.col("fingerprint").alias("a"), "variant", "rest")
    right = index.select(F.col("fingerprint").alias("b"), F.col("variant").alias("v"), F.col("rest").alias("r"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    # The first variant in which the pair meets: of the first segment with at most one differing bit, the variant that
    # blanks this bit, or bit 0 if there is none.
    meets = F.lit(None).cast("int")
    for number, (first, width) in reversed(list(enumerate(cuts))):
        part = _part(apart, first, width)
        lowest = F.bit_count(part.bitwiseAND(-part) - 1)
        meets = F.when(part == 0, number * BITS).when(part.bitwiseAND(part - 1) == 0, number * BITS + lowest).otherwise(meets)
    close = (F.col("a") < F.col("b")) & (F.bit_count(apart) <= distance) & (F.col("variant") == meets)
    # Joined by a shuffle at every size: the engine sizes the index by the fingerprints below it, 64 times too low, and would
    # send all of it through the driver.
    return left.join(right.hint("merge"), (F.col("variant") == F.col("v")) & (F.col("rest") == F.col("r")) & close).select("a", "b")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE
) -> DataFrame:
    """(key, fingerprint long, component_id): component_id is the smallest key reachable over links.

    Edge cases: null, empty and blank texts have fingerprint 0 and are linked like any other. A text of fewer words
    than a shingle is one shingle. A null key gets its own row and the component of its fingerprint; it is never a
    component_id unless all keys are null. Repeated rows stay. An empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, key, text, words), "fingerprints")
    classes = materialize(prints.groupBy("fingerprint").agg(F.min(key).alias("_least")), "classes")
    pairs = materialize(linked_pairs(classes, distance), "links")
    groups = components(pairs, "a", "b")
    # These tables grow with the documents, and small files may hold a large table: none is sent through the driver.
    named = classes.join(groups.hint("merge"), classes["fingerprint"] == groups["id"], "left").select(
        F.col("fingerprint").alias("_f"), "_least", F.coalesce("component", "fingerprint").alias("_group")
    )
    least = named.groupBy("_group").agg(F.min("_least").alias("component_id")).withColumnRenamed("_group", "_g")
    labels = materialize(named.join(least.hint("merge"), named["_group"] == least["_g"]).select("_f", "component_id"), "labels")
    return prints.join(labels.hint("merge"), prints["fingerprint"] == labels["_f"]).select(key, "fingerprint", "component_id")


def keep_representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """Rows of `docs`, one per group of `near_duplicates`: the one of the smallest key, of repeated rows any one.

    Edge cases: null, empty and blank texts are one group. A null key sorts after all others, and rows of one key with
    different texts are told apart by the text's hash, the smaller one first. All columns come back as they were, whatever
    their names. An empty table gives an empty result.
    """
    kind = docs.schema[key].dataType
    # No null inside: a join by equality must find every row.
    told = {"none": F.col(key).isNull(), "key": F.coalesce(F.col(key), F.lit("0").cast(kind)), "hash": F.coalesce(F.xxhash64(F.col(text)), F.lit(0))}
    rows = docs.select(F.struct(*docs.columns).alias("row"), *[c.alias(n) for n, c in told.items()], F.col(text).alias("text"))
    groups = near_duplicates(rows.select(F.struct(*told).alias("told"), "text"), "told", "text", words, distance)
    chosen = materialize(groups.select("component_id.*").distinct(), "chosen")
    # Repeated rows become one where they lie, so a row that a third of the table repeats stays small in the join. Whole rows
    # move once: the join finds them where the grouping has put them.
    single = rows.groupBy(*told).agg(F.first("row").alias("row"))
    return single.join(chosen.hint("merge"), list(told), "left_semi").select("row.*")
