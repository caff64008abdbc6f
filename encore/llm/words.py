"""Words of texts, by Arrow batch: the helper that most operators of this folder share.

A word is `[^\\x20\\x09-\\x0D]+`. A null text holds no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPARK_WORD = r"[^\x20\x09-\x0D]+"


def texts_of(column: pa.Array) -> pa.Array:
    """The column as large strings, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(pc.cast(column, pa.large_string()), "")
    # A compact copy: string kernels misread a cast slice, whose first offset is not 0.
    return filled.take(pa.array(np.arange(len(filled))))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose texts hold about `limit` bytes; a longer single text is a range of its own."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    edges = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip(np.r_[0, edges], np.r_[edges, batch.num_rows], strict=True):
        yield batch.slice(int(start), int(end - start))
        pa.default_memory_pool().release_unused()


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first word of each text and the end, code of each word, distinct words by code)."""
    lists = pc.ascii_split_whitespace(texts)
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    real = pc.not_equal(flat, "")
    if not pc.all(real, min_count=0).as_py():
        kept = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
        flat, offsets = flat.filter(real), kept[offsets]
    coded = flat.dictionary_encode()
    return offsets.astype(np.int64), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def buffer_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all words one after the other, and where each begins (with the end)."""
    words = pc.cast(words, pa.large_binary()) if not pa.types.is_large_binary(words.type) else words
    if len(words) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def segment_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of values between consecutive edges; empty ranges give 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[edges[1:]] - total[edges[:-1]]
