"""Token files: documents as ids of a public tokenizer, range coded, in ascending order of their key.

Documents are range-partitioned and sorted by key. Each task tokenizes its documents and packs whole documents into
blocks of about `BLOCK_IDS` ids, which `rangecoder` encodes; a block stands alone. A token file is a Parquet file with a
row per block: part, block, ids, keys and lengths of its documents, and the coded bytes. Spark commits the files, so a
task that is lost and run again leaves no trace. Where a document starts in the whole stream follows from the sizes of
parts and blocks, which are a few numbers each.

Words repeat, so each distinct word of a batch is tokenized once; frequent ones stay known to the Python worker. White
space always ends a word for this tokenizer, and marks after a word are a word of their own, so ids do not change.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm import rangecoder
from encore.llm.words import buffer_of, slices, split_words, texts_of
from encore.storage import scratch_path

BLOCK_IDS = 1 << 21
END_ID = 2
KNOWN_WORDS = 1_000_000
MARK = "\x01"
# ASCII marks but for the apostrophe, which may begin a contraction.
IS_MARK = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8))
BLOCKS = "part int, block int, n_ids long, keys array<{key}>, lengths array<long>, data binary"

_tokenizers: dict = {}
# Words whose ids are known, all their ids in a row, and how many each has.
_known: dict[str, tuple[pa.Array, np.ndarray, np.ndarray]] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


class _Letters(dict):
    """The byte-level spelling of each letter, as the library gives it."""

    def __missing__(self, code: int) -> str:
        from tokenizers import pre_tokenizers

        self[code] = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
        return self[code]


_letters = _Letters()


def _is_simple(word: str) -> bool:
    """Small Latin letters that normalization leaves alone."""
    return word.islower() and (word.isascii() or (max(word) < "\u0250" and word.lower() == word and unicodedata.is_normalized("NFC", word)))


def _ids_of_words(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids as unsigned 16-bit numbers, where those of each word begin there, how many it has) of distinct words."""
    known = _known.get(path) or (pa.array([], pa.large_string()), np.zeros(0, np.uint16), np.zeros(0, np.int64))
    place = pc.index_in(words, value_set=known[0])
    new = pc.is_null(place)
    missing = words.filter(new)
    fresh = _fresh_ids(missing.to_pylist(), path)
    pool = np.append(known[1], np.frombuffer(b"".join(fresh), np.uint16))
    length = np.append(known[2], np.fromiter(map(len, fresh), np.int64, len(fresh)) // 2)
    start = np.cumsum(length) - length
    at = pc.fill_null(place, 0).to_numpy().astype(np.int64)
    at[new.to_numpy(zero_copy_only=False)] = np.arange(len(known[0]), len(length))
    kept = min(len(length), KNOWN_WORDS)
    if kept > len(known[0]):
        both = pa.concat_arrays([known[0], missing.slice(0, kept - len(known[0]))])
        _known[path] = both, pool[: int(length[:kept].sum())], length[:kept]
    return pool, start[at], length[at]


def _fresh_ids(missing: list[str], path: str) -> list[bytes]:
    """Ids of each of these distinct words as unsigned 16-bit numbers. Many words are one call with a mark between them."""
    tokenizer = _tokenizer(path)
    merged, fresh = tokenizer.model.tokenize, {}
    plain = []
    for word in missing:
        if word.isalpha() and _is_simple(word):
            # A run of small letters is one word to the tokenizer as it is: only its merges are left to do.
            found = merged(word if word.isascii() else word.translate(_letters))
            fresh[word] = array("H", [t.id for t in found]).tobytes()
        elif MARK not in word:
            plain.append(word)
    mark = np.array(tokenizer.encode(MARK, add_special_tokens=False).ids)
    for at in range(0, len(plain), 20_000):
        part = plain[at : at + 20_000]
        ids = np.array(tokenizer.encode(f" {MARK} ".join(part), add_special_tokens=False).ids, np.int64)
        ends = np.flatnonzero(ids == mark[0]) if len(mark) == 1 else np.zeros(0, np.int64)
        if len(ends) != len(part) - 1:
            fresh.update((w, np.array(tokenizer.encode(w, add_special_tokens=False).ids, np.uint16).tobytes()) for w in part)
            continue
        small = ids.astype(np.uint16)
        starts = np.concatenate([[0], ends + 1])
        ends = np.concatenate([ends, [len(ids)]])
        fresh.update((w, small[a:b].tobytes()) for w, a, b in zip(part, starts.tolist(), ends.tolist(), strict=True))
    for word in missing if len(fresh) < len(missing) else []:
        if word not in fresh:
            fresh[word] = np.array(tokenizer.encode(word, add_special_tokens=False).ids, np.uint16).tobytes()
    return [fresh[word] for word in missing]


def _cores(words: pa.Array, special: list[str]) -> tuple[pa.Array, pa.Array]:
    """Each word as what is before its last marks, and these marks; letters A-Z of plain words lower-cased.

    Marks are cut off after plain and Latin letters and digits only: some other letters decompose, and what they decompose
    into would join the marks. Only words of plain letters are lower-cased here: elsewhere a small letter may combine with an accent that a
    capital does not combine with, and the tokenizer looks for such first. Words that hold the text of a `special` token
    in letters of any case stay as they are.
    """
    raw, edges = buffer_of(words)
    whole = pa.array(np.zeros(len(words), bool))
    for text in special:
        whole = pc.or_(whole, pc.match_substring(words, text, ignore_case=True))
    # Only words that end in a mark need a closer look.
    marked = pc.and_not(pa.array(IS_MARK[raw[edges[1:] - 1]]), whole) if len(words) else pa.array([], pa.bool_())
    parts = pc.extract_regex(words.filter(marked), r"^(?P<core>.*[A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])(?P<marks>[!-&(-/:-@\[-`{-~]+)$")
    core = pc.coalesce(pc.struct_field(parts, "core"), words.filter(marked))
    core = pc.replace_with_mask(words, marked, core)
    marks = pc.fill_null(pc.struct_field(parts, "marks"), "")
    marks = pc.replace_with_mask(pa.array([""] * len(words), pa.large_string()), marked, marks)
    return pc.if_else(pc.and_not(pc.string_is_ascii(core), whole), pc.ascii_lower(core), core), marks


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(edges of each text, ids) with the end id after each text."""
    edges, codes, words = split_words(texts)
    core, marks = _cores(words, [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()])
    # Known words are looked up once for both, as a look-up begins with hashing them all.
    coded = pa.concat_arrays([core, marks]).dictionary_encode()
    flat, starts, lengths = _ids_of_words(coded.dictionary, path)
    # Each distinct word is two ranges of these pieces; put together once, a text is one range per word and the end id.
    index = coded.indices.to_numpy(zero_copy_only=False).reshape(2, len(words)).T.reshape(-1)
    starts, lengths = starts.take(index), lengths.take(index)
    pool = np.append(_ranges(flat, starts, lengths), np.uint16(END_ID))
    length = np.append(lengths.reshape(-1, 2).sum(axis=1), 1)
    start = np.cumsum(length) - length
    last = edges[1:] + np.arange(len(edges) - 1)
    inside = np.ones(len(codes) + len(last), bool)
    inside[last] = False
    every = np.full(len(inside), len(words), np.int32)
    every[inside] = codes
    length = length.take(every)
    return np.concatenate([[0], np.cumsum(length)[last]]), _ranges(pool, start.take(every), length)


def _ranges(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The ranges of the pool one after the other."""
    if not length.all():
        start, length = start[length > 0], length[length > 0]
    ends = np.cumsum(length)
    if not len(ends):
        return pool[:0]
    # Places in the pool as sums of steps: one within a range, a jump where the next range begins.
    steps = np.ones(ends[-1], np.int32 if max(len(pool), ends[-1]) < 1 << 31 else np.int64)
    steps[0] = start[0]
    steps[ends[:-1]] = start[1:] - start[:-1] - length[:-1] + 1
    return pool.take(np.cumsum(steps, out=steps, dtype=steps.dtype))


def _encode(path: str, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        held, keys, lengths, total, kind = [], [], [], 0, pa.int64()

        def packed() -> pa.RecordBatch:
            ids = np.concatenate(held) if held else np.zeros(0, np.uint16)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "n_ids": pa.array([len(ids)], pa.int64()),
                "keys": pa.array([keys], pa.list_(kind)), "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "data": pa.array([rangecoder.encode(ids)], pa.binary()),
            })

        for whole in batches:
            kind = whole.schema.field(0).type
            for batch in slices(whole, "_text", 20 << 20):
                edges, ids = token_ids(texts_of(batch.column("_text")), path)
                at, names = 0, batch.column(0).to_pylist()
                while at < len(names):
                    # Documents up to and with the one that fills the block.
                    last = int(np.searchsorted(edges, edges[at] + block_ids - total))
                    last = min(max(last, at + 1), len(names))
                    held.append(ids[edges[at] : edges[last]])
                    keys += names[at:last]
                    lengths += np.diff(edges[at : last + 1]).tolist()
                    total += int(edges[last] - edges[at])
                    at = last
                    if total >= block_ids:
                        yield packed()
                        held, keys, lengths, total, block = [], [], [], 0, block + 1
        if keys:
            yield packed()

    return run


def write_token_files(
    docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, block_ids: int = BLOCK_IDS
) -> None:
    """Write `docs` as token files below `folder`, in ascending order of key, then text; nulls come first."""
    narrow = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ordered = narrow.repartitionByRange("_key").sortWithinPartitions("_key", "_text")
    schema = BLOCKS.format(key=narrow.schema["_key"].dataType.simpleString())
    ordered.mapInArrow(_encode(tokenizer or tokenizer_path(), block_ids), schema).write.parquet(folder)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids = rangecoder.decode(batch.column("data")[row].as_py()).astype("<u4")
            lengths = batch.column("lengths")[row].values.to_numpy()
            if int(lengths.sum()) != len(ids):
                raise ValueError("a block's lengths do not match its ids")
            ends = np.cumsum(lengths)
            raw, starts = memoryview(ids).cast("B"), ends - lengths
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("keys")[row].values, "part": pa.array([batch.column("part")[row].as_py()] * len(ends), pa.int32()),
                "block": pa.array([batch.column("block")[row].as_py()] * len(ends), pa.int32()), "inner": pa.array(starts),
                "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
            })


def token_index(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) per document, all from decoded ids; start counts the ids of earlier documents.

    A block whose checksum is wrong fails the read.
    """
    blocks = spark.read.parquet(folder)
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    decoded = blocks.mapInArrow(_decode, f"key {kind}, part int, block int, inner long, n_tokens long, ids_crc32 long")
    sizes = blocks.select("part", "block", "n_ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = parts.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("block_start")).join(parts, "part")
    joined = decoded.join(starts, ["part", "block"])
    return joined.select(
        F.col("key").alias(key), (F.col("part_start") + F.col("block_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_table(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """`docs` written as token files in the shared folder and read back by `token_index`.

    Edge cases: null and empty texts are the end id alone. Repeated rows are documents of their own, next to each other.
    A null key comes first. A text of any length lies in one block. Other columns of docs are left out. An empty table
    gives an empty result.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, folder, key, text, tokenizer)
    return token_index(docs.sparkSession, folder, key)
