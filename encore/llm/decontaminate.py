"""Benchmark decontamination by spaced-seed hashing.

A seed mask of eight words looks at six of them and ignores two, so a passage with a word changed here and there still
has windows whose hashes agree with the benchmark's. The two masks together find every stretch of 13 words with any two
substitutions. Items shorter than 13 words have masks of their own length, which together ignore any words that a match
may miss. Windows of the documents that can match any benchmark window (a bit table of fixed size says so, without
false negatives) are kept with the words around them, and join the benchmark's windows by hash. Around each hit the
words are compared at that offset: the document is contaminated by an item if some stretch of `STRETCH` words (or the
whole item, if shorter) agrees in at least `SHARE` of its places.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.words import buffer_of, slices, split_words, texts_of
from encore.storage import materialize

MASKS = ("11101011", "11001111")
STRETCH = 13
# Masks of short items look at so many words, or at all but the missed ones.
SHORT_WEIGHT = 6
SHARE = 0.8
LEAST_WORDS = 5
TABLE_BITS = 26
CHUNK_BITS = 15
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(31))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def powers(count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(max(1, count), ODD, np.uint64), dtype=np.uint64)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    raw, edges = buffer_of(words)
    lengths = np.diff(edges)
    if not len(lengths):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        place = np.arange(len(raw)) - np.repeat(edges[:-1], lengths)
        terms = (raw.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max(initial=1)))[place]
        total = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        return mixed(total[edges[1:]] - total[edges[:-1]])


def hashed_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(edges of each text, hash of each lower-cased word)."""
    edges, codes, words = split_words(pc.ascii_lower(texts))
    return edges, word_hashes(words)[codes]


def seeds(tokens: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The hash of every window of the tokens under a mask."""
    count = len(tokens) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    weights = powers(len(mask))
    total = np.full(count, np.uint64(salt), np.uint64)
    with np.errstate(over="ignore"):
        for at, used in enumerate(mask):
            if used == "1":
                total += tokens[at : at + count] * weights[at]
    return mixed(total)


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    limit = np.uint64((1 << TABLE_BITS) - 1)
    return (hashes & limit).astype(np.int64), ((hashes >> np.uint64(32)) & limit).astype(np.int64)


def needed(words: int) -> int:
    """How many of `words` words in a row have to agree."""
    return int(np.ceil(SHARE * words - 1e-9))


def short_masks(length: int) -> list[str]:
    """Masks of a whole item: it is cut into parts, and each mask ignores as many parts as a match may miss words, so
    wherever those lie one mask ignores them all. The fewest parts that leave enough words to look at."""
    missed = length - needed(length)
    for count in range(missed + 1, length + 1):
        parts = np.array_split(np.arange(length), count)
        if length - sum(sorted(map(len, parts))[count - missed :]) >= min(SHORT_WEIGHT, length - missed):
            break
    masks = []
    for ignored in itertools.combinations(parts, missed):
        dark = set(itertools.chain.from_iterable(ignored))
        masks.append("".join("0" if at in dark else "1" for at in range(length)))
    return masks


def _masks_of(length: int) -> list[tuple[str, int]]:
    if length >= STRETCH:
        return [(m, i + 1) for i, m in enumerate(MASKS)]
    return [(m, 100 * length + i) for i, m in enumerate(short_masks(length))] if length >= LEAST_WORDS else []


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        edges, tokens = hashed_tokens(texts_of(batch.column("text")))
        for row in range(batch.num_rows):
            mine = tokens[edges[row] : edges[row + 1]]
            for mask, salt in _masks_of(len(mine)):
                found = seeds(mine, mask, salt)
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array([batch.column("item")[row].as_py()] * len(found), pa.int64()),
                    "hash": pa.array(found.view(np.int64)), "at": pa.array(np.arange(len(found), dtype=np.int32)),
                    "words": pa.array(np.full(len(found), len(mine), np.int32)),
                })


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the bit table that a task's windows set."""
    table = np.zeros(1 << TABLE_BITS, bool)
    for batch in batches:
        for slots in _slots(batch.column("hash").to_numpy().view(np.uint64)):
            table[slots] = True
    parts = table.reshape(-1, 1 << CHUNK_BITS)
    used = np.flatnonzero(parts.any(axis=1))
    for at in range(0, len(used), 64):
        rows = used[at : at + 64]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(rows.astype(np.int32)),
            "bits": pa.array([np.packbits(parts[r]).tobytes() for r in rows], pa.binary()),
        })


def _either(group: pa.Table) -> pa.Table:
    bits = np.zeros((1 << CHUNK_BITS) // 8, np.uint8)
    for value in group["bits"]:
        bits |= np.frombuffer(value.as_py(), np.uint8)
    return pa.table({"part": pa.array([group["part"][0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})


def _regions(table, masks: list[tuple[str, int]], key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(table.value, np.uint8)).view(bool)
        for whole in batches:
            for batch in slices(whole, "_text"):
                edges, tokens = hashed_tokens(texts_of(batch.column("_text")))
                marked = np.zeros(len(tokens), bool)
                hits = []
                for mask, salt in masks:
                    hashes = seeds(tokens, mask, salt)
                    first, second = _slots(hashes)
                    at = np.flatnonzero(bits[first])
                    at = at[bits[second[at]]]
                    row = np.searchsorted(edges, at, "right") - 1
                    inside = at + len(mask) <= edges[row + 1]
                    at, row = at[inside], row[inside]
                    marked[at] = True
                    hits.append((at, row, hashes[at]))
                at, row, hashes = (np.concatenate(x) for x in zip(*hits, strict=True))
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, row, hashes = at[order], row[order], hashes[order]
                # Windows of one document that are near each other share a region.
                fresh = np.r_[True, (np.diff(at) > 2 * STRETCH) | (np.diff(row) > 0)]
                starts = np.flatnonzero(fresh)
                ends = np.r_[starts[1:], len(at)]
                low = np.maximum(edges[row[starts]], at[starts] - STRETCH)
                high = np.minimum(edges[row[starts] + 1], at[ends - 1] + 2 * STRETCH)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([batch.column("_key")[int(r)].as_py() for r in row[starts]], key_type),
                    "start": pa.array(low - edges[row[starts]]),
                    "tokens": pa.array([tokens[a:b].tobytes() for a, b in zip(low, high, strict=True)], pa.binary()),
                    "hashes": pa.array([hashes[a:b].view(np.int64) for a, b in zip(starts, ends, strict=True)], pa.list_(pa.int64())),
                    "places": pa.array([(at[a:b] - c).astype(np.int32) for a, b, c in zip(starts, ends, low, strict=True)], pa.list_(pa.int32())),
                })

    return run


def _tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        edges, tokens = hashed_tokens(texts_of(batch.column("text")))
        yield pa.RecordBatch.from_pydict({
            "item": batch.column("item"), "item_id": batch.column("item_id"),
            "item_tokens": pa.array([tokens[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
        })


def best_stretch(document: np.ndarray, item: np.ndarray, offset: int) -> tuple[int, int, int]:
    """(agreeing words of the best stretch, its words, agreeing words in all) with item[0] at document[offset]."""
    low, high = max(0, -offset), min(len(item), len(document) - offset)
    need = min(STRETCH, len(item))
    if high - low < need:
        return 0, need, 0
    same = (item[low:high] == document[low + offset : high + offset]).astype(np.int64)
    sums = np.cumsum(np.r_[0, same])
    return int((sums[need:] - sums[:-need]).max()), need, int(sums[-1])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, documents, items = (batch.column(n).to_pylist() for n in ("offset", "tokens", "item_tokens"))
        kept, agree = [], []
        for row, (offset, document, item) in enumerate(zip(offsets, documents, items, strict=True)):
            most, need, every = best_stretch(np.frombuffer(document, np.uint64), np.frombuffer(item, np.uint64), offset)
            if most >= needed(need):
                kept.append(row)
                agree.append(every)
        rows = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_pydict({
            "key": batch.column("key").take(rows), "item_id": batch.column("item_id").take(rows),
            "at": pc.add(batch.column("start").take(rows), batch.column("offset").take(rows).cast(pa.int64())),
            "words_equal": pa.array(agree, pa.int64()),
        })


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(key, item_id, at, words_equal): document and item, the word of the document at which the item's first word
    would lie, and how many words of the item agree around there. One row per document key and item, the best place.

    Edge cases: null and empty texts hold nothing and match nothing. Items of fewer than `LEAST_WORDS` words are too
    short to tell and are never reported. Repeated documents give one row; a null key is a key. Other columns of either
    table do not matter. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    items = materialize(items.withColumn("item", F.xxhash64("item_id", "text")), "items")
    windows = materialize(items.select("item", "text").mapInArrow(_item_windows, "item long, hash long, at int, words int"), "windows")
    parts = windows.mapInArrow(_bits, "part int, bits binary").groupBy("part").applyInArrow(_either, "part int, bits binary").collect()
    table = np.zeros((1 << TABLE_BITS - CHUNK_BITS, (1 << CHUNK_BITS) // 8), np.uint8)
    for part in parts:
        table[part["part"]] = np.frombuffer(part["bits"], np.uint8)
    short = [r["words"] for r in windows.filter(F.col("words") < STRETCH).select("words").distinct().collect()]
    masks = _masks_of(STRETCH) + [m for words in sorted(short) for m in _masks_of(words)]
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = narrow.schema["_key"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    shared = spark.sparkContext.broadcast(table.tobytes())
    found = narrow.mapInArrow(
        _regions(shared, masks, to_arrow_type(narrow.schema["_key"].dataType)),
        f"key {kind}, start long, tokens binary, hashes array<long>, places array<int>",
    )
    found = materialize(found.withColumn("region", F.xxhash64("key", "start", "tokens")), "regions")
    hits = found.select("region", F.explode(F.arrays_zip("hashes", "places")).alias("w"))
    hits = hits.select("region", F.col("w.hashes").alias("hash"), F.col("w.places").alias("place")).distinct()
    tried = hits.join(windows, "hash").select("region", "item", (F.col("place") - F.col("at")).alias("offset")).distinct()
    once = found.select("key", "start", "tokens", "region").dropDuplicates(["region"])
    codes = items.mapInArrow(_tokens_of, f"item long, item_id {items.schema['item_id'].dataType.simpleString()}, item_tokens binary")
    rows = tried.join(once, "region").join(codes, "item").select("key", "item_id", "start", "offset", "tokens", "item_tokens")
    checked = rows.mapInArrow(_verify, f"key {kind}, item_id {items.schema['item_id'].dataType.simpleString()}, at long, words_equal long")
    best = checked.groupBy("key", "item_id").agg(F.max(F.struct("words_equal", -F.col("at"))).alias("b"))
    return best.select(F.col("key").alias(key), F.col("item_id").alias(item), (-F.col("b.col2")).alias("at"), "b.words_equal")


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """Rows of `docs` whose key is not among the contaminated ones."""
    bad = materialize(contaminated(docs, benchmark, key, text, item).select(F.col(key).alias("bad")).distinct(), "contaminated")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return rows.join(bad, F.col(f"row.{key}").eqNullSafe(F.col("bad")), "left_anti").select("row.*")
