"""Language-model scores by online logistic context mixing.

A token is coded as its bytes and an end mark, a byte as eight binary decisions. For each bit several predictors give log
odds: one that knows the whole token so far, and those that know its last one to four bytes, each from how often the bit
was 0 and 1 in its context in the training tokens. The short contexts are hashed into tables of fixed size. A mixer adds
the log odds under weights that a gate picks (how often the token so far was seen, and whether it was always followed
alike), and an adaptive table refines the result. The mixer learns online, token by token in random order, each token's
own count taken out of what predicts it; the tasks' mixers are averaged by what they saw. Bits add up to tokens, tokens
to texts; a text of n bytes costs -score / log10(2) bits.

These contexts end at the token's start. So each distinct token is costed once, however often it occurs, and the work on
the model follows the vocabulary, which grows with the corpus but slower. Tokens are sorted in ranges: in a sorted list
all tokens that begin alike are neighbours, so the counts of the whole-token predictor are sums over runs. Runs that
cross ranges lie on the path of a range's first or last token; these few counts are added up over all ranges.

Across tokens, one more bit comes first: is the token the one that most often followed the same three tokens elsewhere in
training? Every token of every training text is counted after the three before it (16 bits of its hash: one token in 65,536
passes for another, and a hit is charged for that), and every token of every text is predicted so. A text never predicts
itself: its own occurrence is taken out, and what was next best may then come first. How sure the bit is comes from mixing
how often the prediction occurred, and against how many others, with how many in a row were right and whether the last was.
Only after a miss are the token's own bits told.

The next bit, after a miss there, is in the context of the token before: did any training text have this pair of tokens?
If so, the token is told by how often it followed; if not, as a whole token (a new one: the chance of a new one, then its
bits). How sure this bit is comes from mixing how often the token before occurred with whether the last two places were
such pairs, gated by the former, and is refined by what happened. All pairs of all training texts are counted; one
occurrence, its own, is taken out for a training text. Pairs go by 48 bits of a hash.

A text's score is the weighted sum over five models of what each gives the whole text: the continuation, then the bits; the
continuation, then the pair, then whole tokens; the same, where a new token is as likely as training's tokens that it has
once; the pair, then whole tokens; and whole tokens alone, which weigh a quarter, the others 3 in 16 each. So a text never
costs more than log10(16 / 3) above the best of them, and a text of known tokens no more than log10(4) above its base score.

Texts stay where they are: a block of documents keeps its tokens as numbers into its own list of distinct tokens, and
only these lists and the sorted hashes of its pairs, packed as differences, are shuffled. The counts of pairs come back in
the order of the hashes, without them. The lists are cut into parts by a hash and travel as lists, not token by token; what
comes back is in the order of the list, without the tokens.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.decontaminate import mixed, word_hashes
from encore.llm.quality import held_out
from encore.llm.scratch import freed
from encore.llm.words import buffer_of, segment_sums, slices, split_words, texts_of
from encore.storage import delete_folder, materialize, scratch_path, scratch_scope

FOLDS = 10
END = "\n"  # no word holds it
BLOCK_BYTES = 16 << 20  # two tasks with a block of twice this left an executor of 3 GB no room
PASSES = 3  # parts in which blocks get their costs, one after the other, so that the disk holds the shuffles of one
RANGE_TOKENS = 40_000
TABLE_BITS = 18
ORDERS = 4
TABLE_TASKS = 8
DEEPEST = 64  # bytes of a token that the whole-token predictor looks at
CHUNK = 8192
GATES = 32
INPUTS = ORDERS + 3
STEPS = 24
SMALL = 0.02
LIMIT = 1e-7
RUN = 16  # lengths of runs of right predictions that are told apart
CELLS = 4 * 4 * RUN * 3
SLICE_TOKENS = 1 << 17  # tokens of a block that are looked at together
SLICE_TEXTS = 2048
PAIR_BITS = 48
CONTEXT_BITS, NEXT_BITS = 47, 16  # of a token after the three before it
GRAM_BITS = CONTEXT_BITS + NEXT_BITS
PAIR_PARTS = 5  # at least 2**PAIR_PARTS parts of the pairs, and of the tokens after three others
PART_TOKENS = 1 << 21  # tokens whose pairs a part holds, at most
PART_WORDS = 1 << 20  # distinct tokens of blocks that a part holds, about
LEVELS = 40
FOLLOWS = LEVELS * 4  # cells of the bit that tells a known pair: after a continuation has missed, and again without any
ALL_CELLS = CELLS + 2 * FOLLOWS
TABLE_ROWS = 1 << 18  # tokens that one task counts contexts of
LN10 = float(np.log(10))
WEIGHTS = (3 / 16, 3 / 16, 3 / 16, 3 / 16, 1 / 4)  # of the models of a text
BLOCK_COLUMNS = ["block", "tokens", "distinct", "trained", "counts", "keys", "held", "lengths", "codes"]
FIRST_WEIGHTS = np.array([0.8, 0.0, 0.0, 0.05, 0.15, 0.0, 0.0], np.float64)


def log_odds(zeros, ones):
    """Single precision: its logarithm is several times faster, and scores do not hang on the last digits."""
    return np.log((ones + np.float32(SMALL)) / (zeros + np.float32(SMALL)), dtype=np.float32)


def given_back(run: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The function on two groups, after which a worker returns the memory it no longer needs: else it keeps that while idle."""

    def then_free(group: pa.Table, other: pa.Table) -> pa.Table:
        result = run(group, other)
        with contextlib.suppress(AttributeError, OSError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)
        return result

    return then_free


# -- blocks of documents ---------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its distinct tokens with their number in training texts, and its documents as token numbers."""
    number = TaskContext.get().partitionId() << 32
    for whole in batches:
        for batch in slices(whole, "text", BLOCK_BYTES):
            texts = pc.ascii_lower(texts_of(batch.column("text")))
            edges, codes, words = split_words(texts)
            # Bytes 9 to 13 never occur in words: 0, the mark of a token's end, becomes 9.
            words = pc.replace_substring(words, "\x00", "\t")
            lengths = np.diff(edges) + 1
            codes = np.insert(codes, edges[1:], len(words)).astype(np.int32)
            held = batch.column("held").to_numpy(zero_copy_only=False)
            train = np.repeat(~held, lengths)
            counts = np.bincount(codes[train], minlength=len(words) + 1)
            tokens = pa.concat_arrays([words.cast(pa.string()), pa.array([END], pa.string())])
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([number], pa.int64()), "tokens": one_list(tokens), "distinct": pa.array([len(tokens)], pa.int64()),
                "trained": pa.array([int(train.sum())], pa.int64()),
                "counts": pa.array([counts], pa.list_(pa.int64())), "keys": pa.array([batch.column("key").to_pylist()], pa.list_(batch.schema.field("key").type)),
                "held": pa.array([held], pa.list_(pa.bool_())), "lengths": pa.array([lengths], pa.list_(pa.int64())),
                "codes": pa.array([zstandard.compress(codes.tobytes(), 1)], pa.binary()),
            }).select(BLOCK_COLUMNS)
            number += 1


def one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def dealt(words: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the words, part by part and in order within, and where each of the 2**bits parts begins, with the end)."""
    part = word_hashes(words.cast(pa.large_string())) >> np.uint64(64 - bits)
    order = np.argsort(part.astype(np.uint16 if bits <= 16 else np.uint64), kind="stable")
    return order, np.searchsorted(part[order], np.arange((1 << bits) + 1, dtype=np.uint64))


def _words(bits: int):
    """A block's distinct tokens in 2**bits parts, and how often its training texts have each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words, counts = batch.column("tokens")[row].values, batch.column("counts")[row].values
                order, edges = dealt(words, bits)
                parts = np.flatnonzero(np.diff(edges))
                words, counts = words.take(pa.array(order)), counts.take(pa.array(order))
                offsets = pa.array(np.r_[edges[parts], len(order)], pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([batch.column("block")[row].as_py()] * len(parts), pa.int64()), "part": pa.array(parts, pa.int32()),
                    "words": pa.ListArray.from_arrays(offsets, words), "counts": pa.ListArray.from_arrays(offsets, counts),
                })

    return run


def _number_words(group: pa.Table) -> pa.Table:
    """A part's distinct tokens with their number in training texts, in a row without a block, and those of each block as
    numbers into them."""
    lists = group["words"].combine_chunks()
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    # Sums of whole numbers are exact in double precision up to 2**53.
    counts = np.bincount(codes, group["counts"].combine_chunks().flatten().to_numpy(), len(coded.dictionary)).astype(np.int64)
    edges = np.cumsum(np.r_[0, lists.value_lengths().to_numpy()])
    packed = [zstandard.compress(codes[a:b].astype(np.int32).tobytes(), 1) for a, b in zip(edges, edges[1:], strict=False)]
    rows = len(packed)
    ends = pa.array([0, *[len(counts)] * (rows + 1)], pa.int32())
    return pa.table({
        "part": pa.array([group["part"][0].as_py()] * (rows + 1), pa.int32()), "block": pa.array([None, *group["block"].to_pylist()], pa.int64()),
        "words": pa.ListArray.from_arrays(ends, coded.dictionary), "counts": pa.ListArray.from_arrays(ends, pa.array(counts)),
        "codes": pa.array([None, *packed], pa.binary()),
    })


def _price_words(group: pa.Table, scored: pa.Table) -> pa.Table:
    """Per block its tokens' numbers in training texts and their costs, in the order of its tokens of the part."""
    place = scored["place"].to_numpy()
    told = np.empty((2, len(place)), np.uint64)
    told[0, place] = scored["count"].to_numpy().astype(np.uint64)
    told[1, place] = scored["cost"].to_numpy().view(np.uint64)
    codes = [np.frombuffer(zstandard.decompress(v.as_py()), np.int32) for v in group["codes"]]
    return pa.table({
        "block": group["block"], "part": group["part"],
        "totals": pa.array([packed_planes(told[:, c].ravel(), 8) for c in codes], pa.binary()),
    })


def grams_of(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """GRAM_BITS bits that name each token after the three before it in its text: CONTEXT_BITS of these, or of where the text
    begins, then NEXT_BITS of its own, never 0. `hashes` of all tokens of texts that begin at `edges`."""
    starts, lengths = edges[:-1], np.diff(edges)
    context = np.zeros(len(hashes), np.uint64)
    with np.errstate(over="ignore"):
        for back, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9)):
            before = np.r_[np.zeros(back, np.uint64), hashes][: len(hashes)]
            for inside in range(back):
                before[starts[lengths > inside] + inside] = back
            before *= np.uint64(factor)
            context += before
        context = mixed(context) >> np.uint64(64 - CONTEXT_BITS)
    return (context << np.uint64(NEXT_BITS)) | np.maximum(hashes >> np.uint64(64 - NEXT_BITS), np.uint64(1))


def continued(followers: np.ndarray, grams: np.ndarray, train: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell or -1, hit) per token, from the (total, best, second) of its context as `_sum_grams` gives them; a training text's
    own occurrence is taken out."""
    total, best, second = followers
    bits = np.uint64(NEXT_BITS)
    own, token = train.astype(np.uint64), grams & np.uint64((1 << NEXT_BITS) - 1)
    total = total - np.minimum(own, total)
    same = (best & np.uint64((1 << NEXT_BITS) - 1)) == token
    best = np.maximum(best - ((own & same & (best > 0)) << bits), second)
    count = (best >> bits).astype(np.int64)
    active = count > 0
    hit = active & (best & np.uint64((1 << NEXT_BITS) - 1) == token)
    position, begin = np.arange(len(grams)), np.repeat(edges[:-1], np.diff(edges))
    before = np.r_[0, active[:-1].astype(np.int64) + hit[:-1]][: len(grams)]
    before[position == begin] = 0
    missed = np.r_[-1, np.maximum.accumulate(np.where(hit, -1, position))[:-1]][: len(grams)]
    run = np.minimum(position - 1 - np.maximum(missed, begin - 1), RUN - 1)
    sure = np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64), 3)
    share = count / np.maximum(total, 1)
    kind = sure * 4 + (share >= 0.999) + (share >= 0.5) + (share >= 0.15)
    return np.where(active, (kind * RUN + run) * 3 + before, -1), hit


def text_slices(edges: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of a block's texts that hold about SLICE_TOKENS tokens; a longer single text is a range of its own."""
    begin = 0
    while begin < len(edges) - 1:
        end = int(np.searchsorted(edges, edges[begin] + SLICE_TOKENS, "right")) - 1
        end = max(begin + 1, min(end, begin + SLICE_TEXTS))
        yield begin, end
        begin = end


def pair_names(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """PAIR_BITS bits that name each token and the one before it in its text; `hashes` of all tokens, none before the first."""
    before = np.r_[np.zeros(1, np.uint64), hashes[:-1]][: len(hashes)]
    before[edges[:-1]] = 0
    with np.errstate(over="ignore"):
        return mixed(mixed(before) * np.uint64(0x9E3779B97F4A7C15) + hashes) >> np.uint64(64 - PAIR_BITS)


def packed_planes(values: np.ndarray, width: int) -> bytes:
    """The numbers as their first bytes, then their second bytes, and so on, compressed."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    return zstandard.compress(np.ascontiguousarray(raw.T).tobytes(), 1)


def unpacked_planes(packed: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(width, -1)
    values = np.zeros((raw.shape[1], 8), np.uint8)
    values[:, :width] = raw.T
    return values.view("<u8")[:, 0]


def _pairs(bits: int):
    """A block's distinct pairs of tokens in 2**bits parts: names in order, as differences, and how often training has each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                names, edges, held = _names_of(batch, row)
                train = np.repeat(~held, np.diff(edges)).astype(np.uint64)
                # The lowest bit tells which are of training texts.
                every = np.sort((names << np.uint64(1)) | train)
                first = np.flatnonzero(np.r_[True, every[1:] >> np.uint64(1) != every[:-1] >> np.uint64(1)])
                seen = np.add.reduceat(every & np.uint64(1), first)
                every = every[first] >> np.uint64(1)
                bounds = np.searchsorted(every, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(PAIR_BITS - bits))
                bounds = np.r_[0, bounds, len(every)]
                parts = np.flatnonzero(np.diff(bounds))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([batch.column("block")[row].as_py()] * len(parts), pa.int64()), "part": pa.array(parts, pa.int32()),
                    "names": pa.array([packed_planes(np.diff(every[bounds[p] : bounds[p + 1]], prepend=np.uint64(0)), PAIR_BITS // 8) for p in parts], pa.binary()),
                    "seen": pa.array([packed_planes(seen[bounds[p] : bounds[p + 1]], 8) for p in parts], pa.binary()),
                })

    return run


def _hashes_of(block, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the tokens, edges of the texts, which are held out) of a row of blocks."""
    codes = np.frombuffer(zstandard.decompress(block["codes"][row].as_py()), np.int32)
    edges = np.concatenate([[0], np.cumsum(block["lengths"][row].values.to_numpy())])
    hashes = word_hashes(block["tokens"][row].values.cast(pa.large_string()))[codes]
    return hashes, edges, block["held"][row].values.to_numpy(zero_copy_only=False)


def _names_of(block, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names of the pairs, edges of the texts, which are held out) of a row of blocks."""
    hashes, edges, held = _hashes_of(block, row)
    return pair_names(hashes, edges), edges, held


def _sum_pairs(group: pa.Table) -> pa.Table:
    """How often all training texts have the pairs of each block, in the order of their names."""
    names = [np.cumsum(unpacked_planes(v.as_py(), PAIR_BITS // 8), dtype=np.uint64) for v in group["names"]]
    seen = [unpacked_planes(v.as_py(), 8) for v in group["seen"]]
    every, which = np.unique(np.concatenate(names), return_inverse=True)
    total = np.bincount(which, np.concatenate(seen), len(every)).astype(np.int64)
    edges = np.cumsum([0, *map(len, names)])
    return pa.table({
        "block": group["block"], "part": group["part"],
        "totals": pa.array([packed_planes(total[which[a:b]], 8) for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
    })


def _grams(bits: int):
    """A block's distinct tokens after three others in 2**bits parts by those three: names in order, as differences, and twice
    how often training has each, plus one if a held-out text has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                hashes, edges, held = _hashes_of(batch, row)
                every = grams_of(hashes, edges) << np.uint64(1)
                every |= np.repeat(~held, np.diff(edges))
                every.sort()
                names = every >> np.uint64(1)
                first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
                seen = np.add.reduceat(every & np.uint64(1), first)
                asked = np.diff(first, append=len(every)).astype(np.uint64) > seen
                names, seen = names[first], (seen << np.uint64(1)) | asked
                bounds = np.searchsorted(names, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(GRAM_BITS - bits))
                bounds = np.r_[0, bounds, len(names)]
                parts = np.flatnonzero(np.diff(bounds))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([batch.column("block")[row].as_py()] * len(parts), pa.int64()), "part": pa.array(parts, pa.int32()),
                    "names": pa.array([packed_planes(np.diff(names[bounds[p] : bounds[p + 1]], prepend=np.uint64(0)), 8) for p in parts], pa.binary()),
                    "seen": pa.array([packed_planes(seen[bounds[p] : bounds[p + 1]], 8) for p in parts], pa.binary()),
                })

    return run


def _sum_grams(group: pa.Table) -> pa.Table:
    """For the contexts of each block, in order: how often all training texts have one, and its most frequent next tokens, the
    best and the second, as count and NEXT_BITS of the token in one number (equal counts: the greater). All are 0 where training
    has a context once, in this very block, and no held-out text of the block asks for it."""
    bits, one = np.uint64(NEXT_BITS), np.uint64(1)
    names = [np.cumsum(unpacked_planes(v.as_py(), 8), dtype=np.uint64) for v in group["names"]]
    seen = [unpacked_planes(v.as_py(), 8) for v in group["seen"]]
    every = np.concatenate(names)
    every.sort()
    every = every[np.r_[True, every[1:] != every[:-1]]]
    counts = np.zeros(len(every), np.uint64)
    places = []
    for told in seen:
        places.append(np.searchsorted(every, names.pop(0)).astype(np.int32))
        counts[places[-1]] += told >> one  # a block has a name once
    fresh = np.r_[True, every[1:] >> bits != every[:-1] >> bits]
    first, which = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    ranked = np.where(counts > 0, (counts << bits) | (every & np.uint64((1 << NEXT_BITS) - 1)), np.uint64(0))
    total, best = np.add.reduceat(counts, first), np.maximum.reduceat(ranked, first)
    ranked[ranked == best[which]] = 0
    second = np.maximum.reduceat(ranked, first)
    packed = []
    for place, told in zip(places, seen, strict=True):
        mine = which[place]
        start = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        at = mine[start]
        useful = (total[at] > 1) | (np.add.reduceat(told >> one, start) == 0) | (np.bitwise_or.reduceat(told & one, start) > 0)
        packed.append(packed_planes(np.concatenate([np.where(useful, values[at], 0) for values in (total, best, second)]), 8))
    return pa.table({"block": group["block"], "part": group["part"], "totals": pa.array(packed, pa.binary())})


def ordered_names(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the names in order, the names in order). Numbers sort several times faster than their places, so a place goes
    along in the lowest bits of a number; where a name's own lowest bits had to give way for it, the few names that differ only
    in these are sorted again."""
    bits = len(names).bit_length()
    lost = max(0, int(names.max(initial=0)).bit_length() + bits - 64)
    if bits > 32 or lost > 24:
        order = np.argsort(names)
        return order, names[order]
    keyed = ((names >> np.uint64(lost)) << np.uint64(bits)) | np.arange(len(names), dtype=np.uint64)
    keyed.sort()
    order = (keyed & np.uint64((1 << bits) - 1)).astype(np.int32 if bits < 32 else np.int64)
    keyed >>= np.uint64(bits)
    if not lost:
        return order, keyed
    ordered = names[order]
    for top in np.unique(keyed[1:][(keyed[1:] == keyed[:-1]) & (ordered[1:] != ordered[:-1])]):
        a, b = np.searchsorted(keyed, np.array([top, top + np.uint64(1)]))
        again = np.argsort(ordered[a:b], kind="stable")
        order[a:b], ordered[a:b] = order[a:b][again], ordered[a:b][again]
    return order, ordered


def in_order(names: np.ndarray) -> np.ndarray:
    """The place of each name among the distinct ones in order."""
    order, ordered = ordered_names(names)
    place = np.empty(len(names), np.int32)
    place[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]][: len(names)], dtype=np.int32)
    return place


def followed(pairs: np.ndarray, after: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell or -1, hit, log10 share of the pair) per token, from how often its pair and the token before it occur
    elsewhere in training."""
    hit = (pairs > 0) & (after > 0)
    begin = np.repeat(edges[:-1], np.diff(edges))
    inside = np.arange(len(pairs)) - begin
    past = np.zeros(len(pairs), np.int64)
    for back in (1, 2):
        past[back:] += np.where(inside[back:] >= back, hit[:-back], False) * (3 - back)
    level = np.minimum(np.log2(np.maximum(after, 1)).astype(np.int64), LEVELS - 1)
    share = np.log10(np.where(hit, pairs, 1) / np.where(hit, after, 1))
    return np.where(after > 0, level * 4 + past, -1), hit, share


def fit_repeats(tries: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Chance of a continuation's hit per cell: gated by what happened just before."""
    cells = np.arange(CELLS)
    return fit_chances(tries, hits, cells // (3 * RUN), cells % (3 * RUN), cells % 3)


def fit_follows(tries: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Chance of a known pair per cell: gated by how often the token before occurs."""
    cells = np.arange(FOLLOWS)
    return fit_chances(tries, hits, cells // 4, cells % 4, cells // 16)


def fit_chances(tries: np.ndarray, hits: np.ndarray, kind: np.ndarray, way: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Chance of a hit per cell: two predictors mixed under gated weights, then refined."""
    size = len(tries)
    x = np.empty((size, 3))
    for column, group in ((0, kind), (1, way)):
        right, all_ = np.bincount(group, hits, size), np.bincount(group, tries, size)
        x[:, column] = np.log((right + 0.4) / (all_ - right + 0.4))[group]
    x[:, 2] = 0.3
    gates = int(before.max()) + 1
    weights = np.tile([0.5, 0.5, 0.0], (gates, 1))
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip((x * weights[before]).sum(axis=1), -20, 20)))
        for gate in range(gates):
            mine = before == gate
            bend = (x[mine] ** 2 * (tries * np.maximum(p * (1 - p), 1e-4))[mine, None]).sum(axis=0) + 1.0
            weights[gate] += 0.3 * (x[mine] * (hits - tries * p)[mine, None]).sum(axis=0) / bend
    p = 1 / (1 + np.exp(-np.clip((x * weights[before]).sum(axis=1), -20, 20)))
    return np.clip((p + (hits + 2 * p) / (tries + 2)) / 2, 1e-4, 1 - 1e-4)


# -- bits of tokens --------------------------------------------------------------------------------


@dataclass
class Tokens:
    """Sorted distinct tokens as symbols: their bytes, then 0."""

    symbols: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(tokens: pa.Array, counts: np.ndarray) -> Tokens:
        raw, edges = buffer_of(tokens)
        lengths = np.diff(edges)
        symbols = np.insert(raw, edges[1:], 0)
        starts = edges[:-1] + np.arange(len(lengths))
        return Tokens(symbols, starts, lengths + 1, counts)


def node_counts(tokens: Tokens) -> np.ndarray:
    """(symbols, 8, 2): how often each bit was 0 and 1 after what the token has shown so far, within these tokens.

    Symbols beyond the deepest looked at have 0 and 0.
    """
    out = np.zeros((8, len(tokens.symbols), 2), np.int64)
    live = np.arange(len(tokens.starts))
    fresh = np.arange(len(live)) == 0
    alone = np.full(len(live), DEEPEST)  # depth from which on no other token is alike
    for depth in range(min(DEEPEST, int(tokens.lengths.max(initial=0)))):
        if not len(live):
            break
        at = tokens.starts[live] + depth
        symbol, count = tokens.symbols[at].astype(np.int64), tokens.counts[live]
        run = np.cumsum(fresh) << 8
        for bit in range(8):
            first = np.flatnonzero(fresh)
            ones = np.where((symbol >> (7 - bit)) & 1, count, 0)
            total, one = np.add.reduceat(count, first), np.add.reduceat(ones, first)
            mine = np.cumsum(fresh) - 1
            out[bit, at, 0], out[bit, at, 1] = (total - one)[mine], one[mine]
            node = run | (symbol >> (7 - bit))
            fresh = np.concatenate([[True], node[1:] != node[:-1]])
        # Runs of tokens equal so far. One that is a run of its own goes on alone, or has ended.
        single = fresh & np.r_[fresh[1:], True]
        alone[live[single]] = depth + 1
        live, fresh = live[~single], fresh[~single]
    rest = np.flatnonzero(alone < np.minimum(tokens.lengths, DEEPEST))
    lengths = np.minimum(tokens.lengths[rest], DEEPEST) - alone[rest]
    at = np.repeat(tokens.starts[rest] + alone[rest] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    symbol, count = tokens.symbols[at], np.repeat(tokens.counts[rest], lengths)
    for bit in range(8):
        out[bit, at, (symbol >> (7 - bit)) & 1] = count
    return out.transpose(1, 0, 2)


def _paths(tokens: Tokens) -> Iterator[tuple[bytes, int, int]]:
    """(name, zeros, ones) of all nodes on the way of the first and the last token; equal names are equal nodes."""
    for row in {0, len(tokens.starts) - 1}:
        start = tokens.starts[row]
        raw = tokens.symbols[start : start + tokens.lengths[row]]
        same = np.arange(len(tokens.starts))
        for depth in range(min(DEEPEST, len(raw))):
            symbol, count = tokens.symbols[tokens.starts[same] + depth], tokens.counts[same]
            for bit in range(8):
                alike = (symbol >> (8 - bit)) == (int(raw[depth]) >> (8 - bit)) if bit else np.ones(len(symbol), bool)
                ones = int(count[alike & ((symbol >> (7 - bit)) & 1 == 1)].sum())
                yield raw[:depth].tobytes() + bytes([1, bit, int(raw[depth]) >> (8 - bit)]), int(count[alike].sum()) - ones, ones
            same = same[symbol == raw[depth]]


def _edge_nodes(group: pa.Table) -> pa.Table:
    rows = {name: counts for name, *counts in _paths(_sorted(group))}
    return pa.table({
        "part": pa.array([group["part"][0].as_py()] * len(rows), pa.int32()), "node": pa.array(list(rows), pa.binary()),
        "zeros": pa.array([r[0] for r in rows.values()], pa.int64()), "ones": pa.array([r[1] for r in rows.values()], pa.int64()),
    })


def _order(group: pa.Table) -> pa.Array:
    return pc.sort_indices(group["token"].combine_chunks().cast(pa.large_binary()))


def _sorted(group: pa.Table) -> Tokens:
    order = _order(group)
    return Tokens.of(group["token"].combine_chunks().take(order).cast(pa.large_string()), group["count"].combine_chunks().take(order).to_numpy())


def _full_counts(tokens: Tokens, edges: pa.Table) -> np.ndarray:
    """Node counts over all ranges: runs on the way of the first or last token may go on in other ranges."""
    counts = node_counts(tokens)
    whole = dict(zip(edges["node"].to_pylist(), zip(edges["zeros"].to_pylist(), edges["ones"].to_pylist(), strict=True), strict=True))
    for row in {0, len(tokens.starts) - 1}:
        # All tokens of this range that share the node have it at the same depth; find them by the run they form.
        start = tokens.starts[row]
        raw = tokens.symbols[start : start + tokens.lengths[row]]
        same = np.arange(len(tokens.starts))
        for depth in range(min(DEEPEST, len(raw))):
            same = same[tokens.lengths[same] > depth]
            at = tokens.starts[same] + depth
            for bit in range(8):
                alike = at[(tokens.symbols[at] >> (8 - bit)) == (int(raw[depth]) >> (8 - bit))] if bit else at
                name = raw[:depth].tobytes() + bytes([1, bit, int(raw[depth]) >> (8 - bit)])
                if name in whole:
                    counts[alike, bit] = whole[name]
            same = same[tokens.symbols[at] == raw[depth]]
    return by_bit(counts)


def by_bit(counts: np.ndarray) -> np.ndarray:
    """(8, symbols, 2), single precision: as the mixer reads them."""
    return np.ascontiguousarray(counts.transpose(1, 0, 2), np.float32)


def contexts(tokens: Tokens) -> np.ndarray:
    """(ORDERS, symbols): hash of the 1 to ORDERS symbols before each, within the token; 0 stands for its start."""
    place = np.arange(len(tokens.symbols)) - np.repeat(tokens.starts, tokens.lengths)
    out = np.empty((ORDERS, len(place)), np.uint64)
    padded = np.concatenate([np.zeros(ORDERS, np.uint64), tokens.symbols.astype(np.uint64) + np.uint64(1)])
    code = np.zeros(len(place), np.uint64)
    for order in range(ORDERS):
        before = padded[ORDERS - 1 - order : ORDERS - 1 - order + len(place)]
        code = (code << np.uint64(9)) | np.where(place > order, before, np.uint64(0))
        out[order] = mixed(code + np.uint64(order + 1))
    return out


def slots(context: np.ndarray, symbols: np.ndarray, bit: int) -> np.ndarray:
    partial = (np.uint64(1 << bit) | (symbols.astype(np.uint64) >> np.uint64(8 - bit)))
    with np.errstate(over="ignore"):
        return ((context ^ (partial * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _table_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts of the hashed contexts, in pieces."""
    table = np.zeros((ORDERS, 1 << TABLE_BITS, 2))
    any_rows = False
    for batch in batches:
        keep = np.flatnonzero(batch.column("count").to_numpy() > 0)
        for at in range(0, len(keep), 4 * CHUNK):
            rows = pa.array(keep[at : at + 4 * CHUNK])
            any_rows = True
            tokens = Tokens.of(batch.column("token").take(rows).cast(pa.large_string()), batch.column("count").take(rows).to_numpy())
            weight = np.repeat(tokens.counts, tokens.lengths).astype(float)
            found = contexts(tokens)
            for bit in range(8):
                one = (tokens.symbols >> (7 - bit)) & 1
                for order in range(ORDERS):
                    place = slots(found[order], tokens.symbols, bit) * 2 + one
                    table[order] += np.bincount(place, weight, 2 << TABLE_BITS).reshape(-1, 2)
    if any_rows:
        pieces = table.reshape(-1, 4096)
        for piece in np.flatnonzero(pieces.any(axis=1)):
            yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "counts": pa.array([pieces[piece]], pa.list_(pa.float64()))})


def _sum_pieces(group: pa.Table) -> pa.Table:
    total = np.zeros(4096)
    for row in group["counts"]:
        total += row.values.to_numpy()
    return pa.table({"piece": pa.array([group["piece"][0].as_py()], pa.int32()), "counts": pa.array([total], pa.list_(pa.float64()))})


# -- mixing ----------------------------------------------------------------------------------------


def gates_of(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    # The exponent of a float is its binary logarithm.
    level = np.minimum(((zeros + ones).astype(np.float32).view(np.int32) >> 23) - 126, GATES // 2 - 1)
    return np.maximum(level, 0).astype(np.int64) * 2 + ((zeros == 0) | (ones == 0))


def inputs_of(tokens: Tokens, counts: np.ndarray, table: np.ndarray, at: np.ndarray, found: np.ndarray, bit: int, own: bool | None):
    """(INPUTS, rows) log odds, gates and bits for the symbols `at`. With `own` the token itself is taken out of the
    counts in `table`; without, `table` holds the log odds."""
    return inputs_at(tokens.symbols[at], counts[bit].take(at, axis=0), table, found.take(at, axis=1), bit, own)


def inputs_at(symbols: np.ndarray, pair: np.ndarray, table: np.ndarray, found: np.ndarray, bit: int, own: bool | None):
    """As `inputs_of`, from the symbols, their counts at this bit and their contexts."""
    one = ((symbols >> (7 - bit)) & 1).astype(np.int64)
    x = np.empty((INPUTS, len(symbols)), np.float32)
    places = slots(found, symbols, bit)
    if own is not None:
        less1 = one.astype(np.float32)
        less0 = 1 - less1
        zeros, ones = np.maximum(pair[:, 0] - less0, 0), np.maximum(pair[:, 1] - less1, 0)
    else:
        zeros, ones = pair[:, 0], pair[:, 1]
    x[0] = log_odds(zeros, ones)
    for order in range(ORDERS):
        slot = places[order]
        if own is not None:
            pair = table[order].take(slot, axis=0)
            x[order + 1] = log_odds(np.maximum(pair[:, 0] - less0, 0), np.maximum(pair[:, 1] - less1, 0))
        else:
            x[order + 1] = table[order].take(slot)
    # A sure prediction counts for more or less by how long it has held.
    np.subtract(ones > 0, zeros > 0, out=x[ORDERS + 1], dtype=np.float32)
    x[ORDERS + 2] = 0.1
    return x, gates_of(zeros, ones), one


@dataclass
class Mixer:
    weights: np.ndarray
    told: np.ndarray  # (GATES, STEPS, 2): weight of bits 0 and 1 met at each mixed prediction

    def mix(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = np.zeros(x.shape[1], np.float32)
        for values, weights in zip(x, self.weights.T.astype(np.float32), strict=True):
            total += values * weights.take(gate)
        return 1 / (1 + np.exp(-np.clip(total, -16, 16)))

    @staticmethod
    def step(p: np.ndarray) -> np.ndarray:
        return np.clip(np.rint((np.log(p / (1 - p)) + np.float32(12)) * np.float32((STEPS - 1) / 24)), 0, STEPS - 1).astype(np.int64)

    def refine(self, p: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """The average of the mix and of what truly happened at such a prediction, which starts out as the mix itself."""
        cell = gate * STEPS + self.step(p)
        ones, both = self.told[:, :, 1].ravel().take(cell), self.told.sum(axis=2).ravel().take(cell)
        return np.clip((p + (ones + 2 * p) / (both + 2)) / 2, LIMIT, 1 - LIMIT)


def fit(tokens: Tokens, counts: np.ndarray, table: np.ndarray, seed: int) -> tuple[Mixer, np.ndarray]:
    """Learn online from these tokens, in random order; (mixer, weight of what each gate saw)."""
    mixer = Mixer(np.tile(FIRST_WEIGHTS, (GATES, 1)), np.zeros((GATES, STEPS, 2)))
    mass, curve = np.zeros(GATES), np.full((GATES, INPUTS), 1e-3)
    trained = np.flatnonzero(tokens.counts > 0)
    found = contexts(tokens)
    order = np.random.default_rng(seed).permutation(trained)
    for begin in range(0, len(order), CHUNK):
        rows = order[begin : begin + CHUNK]
        lengths = tokens.lengths[rows]
        at = np.repeat(tokens.starts[rows] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        weight = np.repeat(tokens.counts[rows], lengths).astype(float)
        symbols, near = tokens.symbols[at], found.take(at, axis=1)
        for bit in np.random.default_rng(seed + begin).permutation(8):
            x, gate, one = inputs_at(symbols, counts[bit].take(at, axis=0), table, near, int(bit), True)
            p = mixer.mix(x, gate)
            cell = (gate * STEPS + mixer.step(np.clip(p, LIMIT, 1 - LIMIT))) * 2 + one
            mixer.told += np.bincount(cell, weight, mixer.told.size).reshape(mixer.told.shape)
            error, bend = (one - p) * weight, np.maximum(p * (1 - p), 1e-4) * weight
            mass += np.bincount(gate, weight, GATES)
            for k in range(INPUTS):
                pull = error * x[k]
                curve[:, k] += np.bincount(gate, bend * x[k] * x[k], GATES)
                mixer.weights[:, k] += 0.5 * np.bincount(gate, pull, GATES) / (curve[:, k] + 1.0)
            np.clip(mixer.weights, -4, 4, out=mixer.weights)
    return mixer, mass


def token_scores(tokens: Tokens, counts: np.ndarray, table: np.ndarray, mixer: Mixer) -> np.ndarray:
    """log10 probability of each token."""
    found = contexts(tokens)
    table = log_odds(table[:, :, 0], table[:, :, 1])
    out = np.zeros(len(tokens.starts))
    for begin in range(0, len(out), CHUNK):
        first, last = tokens.starts[begin], tokens.starts[min(begin + CHUNK, len(out)) - 1] + tokens.lengths[min(begin + CHUNK, len(out)) - 1]
        total = np.zeros(last - first)
        for bit in range(8):
            x, gate, one = inputs_at(tokens.symbols[first:last], counts[bit, first:last], table, found[:, first:last], bit, None)
            p = mixer.refine(np.clip(mixer.mix(x, gate), LIMIT, 1 - LIMIT).astype(np.float64), gate)
            total += np.log(np.where(one == 1, p, 1 - p))
        edges = np.concatenate([tokens.starts[begin : begin + CHUNK], [last]]) - first
        out[begin : begin + CHUNK] = segment_sums(total, edges) / LN10
    return out


def _fit_range(shared):
    def run(group: pa.Table, edges: pa.Table) -> pa.Table:
        table = shared.value
        if not group.num_rows:
            return pa.table({"weights": pa.array([], pa.list_(pa.float64())), "told": pa.array([], pa.list_(pa.float64())), "mass": pa.array([], pa.list_(pa.float64()))})
        tokens = _sorted(group)
        mixer, mass = fit(tokens, _full_counts(tokens, edges), table, int(group["part"][0].as_py()))
        return pa.table({
            "weights": pa.array([(mixer.weights * mass[:, None]).ravel()], pa.list_(pa.float64())),
            "told": pa.array([mixer.told.ravel()], pa.list_(pa.float64())), "mass": pa.array([mass], pa.list_(pa.float64())),
        })

    return run


def _score_range(shared, mixer):
    def run(group: pa.Table, edges: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"home": pa.array([], pa.int32()), "place": pa.array([], pa.int32()), "count": pa.array([], pa.int64()), "cost": pa.array([], pa.float64())})
        tokens, order = _sorted(group), _order(group)
        costs = token_scores(tokens, _full_counts(tokens, edges), shared.value, mixer.value)
        return pa.table({"home": group["home"].take(order), "place": group["place"].take(order), "count": pa.array(tokens.counts), "cost": pa.array(costs)})

    return run


def _documents(total: int, distinct: int, single: int, kind: pa.DataType, word_bits: int):
    """Per document its counts, base score, cost of all tokens but the continued ones by their bits, and as followers or whole
    tokens, that of all as followers or whole tokens and as whole tokens, and tries and hits per cell."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        out = {n: [] for n in ("key", "held_out", "n_tokens", "n_known", "base_score", "cost", "rest", "fresh", "paired", "whole", "cells", "tries", "hits")}
        for row in range(block.num_rows):
            of_words, of_grams, of_pairs = (told.filter(pc.equal(told["kind"], kind)).sort_by("part")["totals"] for kind in range(3))
            words = block["tokens"][row].values
            order, _ = dealt(words, word_bits)
            priced = np.concatenate([unpacked_planes(v.as_py(), 8).reshape(2, -1) for v in of_words], axis=1)
            counts, costs = np.empty(len(order), np.int64), np.empty(len(order))
            counts[order], costs[order] = priced[0].astype(np.int64), priced[1].view(np.float64)
            base = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
            word = np.where(counts > 0, base, base + costs)
            # A new token is as likely as one that training has once.
            fresh = (single + 1) / (total + 2)
            plain = np.where(counts > 0, np.log10((1 - fresh) * np.maximum(counts, 1) / max(total, 1)), np.log10(fresh) + costs)
            codes = np.frombuffer(zstandard.decompress(block["codes"][row].as_py()), np.int32)
            lengths, held = block["lengths"][row].values.to_numpy(), block["held"][row].values
            edges = np.concatenate([[0], np.cumsum(lengths)])
            named = word_hashes(words.cast(pa.large_string()))
            grams, names = np.empty(len(codes), np.uint64), np.empty(len(codes), np.uint64)
            for a, b in text_slices(edges):
                hashes, ends = named[codes[edges[a] : edges[b]]], edges[a : b + 1] - edges[a]
                grams[edges[a] : edges[b]], names[edges[a] : edges[b]] = grams_of(hashes, ends), pair_names(hashes, ends)
            pair_at = in_order(names)
            del names
            context_at = in_order(grams >> np.uint64(NEXT_BITS))
            # The three numbers of a context lie side by side, so that a token finds them at one place.
            followers, at = np.empty((int(context_at.max()) + 1, 3), np.uint64), 0
            for part in of_grams:
                values = unpacked_planes(part.as_py(), 8).reshape(3, -1)
                followers[at : at + values.shape[1]] = values.T
                at += values.shape[1]
            totals = np.concatenate([unpacked_planes(v.as_py(), 8) for v in of_pairs]).astype(np.int64)
            for a, b in text_slices(edges):
                mine = codes[edges[a] : edges[b]]
                long, ends = lengths[a:b], edges[a : b + 1] - edges[a]
                train = np.repeat(~held.slice(a, b - a).to_numpy(zero_copy_only=False), long)
                cell, hit = continued(np.ascontiguousarray(followers.take(context_at[edges[a] : edges[b]], axis=0).T), grams[edges[a] : edges[b]], train, ends)
                own = train.astype(np.int64)
                before = np.r_[len(counts) - 1, mine[:-1]]
                before[ends[:-1]] = len(counts) - 1  # as often as texts end, texts begin
                pairs = totals[pair_at[edges[a] : edges[b]]]
                follow, known, share = followed(pairs - own, counts[before] - own, ends)
                # Cells of continuations, then those of pairs where no continuation has told the token, and of all pairs.
                first = np.repeat(np.arange(b - a), long) * ALL_CELLS
                tried, every = cell >= 0, follow >= 0
                asked = every & ~hit
                cells = np.concatenate([first[tried] + cell[tried], first[asked] + CELLS + follow[asked], first[every] + CELLS + FOLLOWS + follow[every]])
                tries = np.bincount(cells, minlength=(b - a) * ALL_CELLS)
                hits = np.bincount(cells[np.concatenate([hit[tried], known[asked], known[every]])], minlength=len(tries))
                used = np.flatnonzero(tries)
                offsets = np.searchsorted(used // ALL_CELLS, np.arange(b - a + 1)).astype(np.int32)
                out["key"].append(block["keys"][row].values.slice(a, b - a))
                out["held_out"].append(held.slice(a, b - a))
                out["n_tokens"].append(pa.array(long))
                out["n_known"].append(pa.array(segment_sums((counts[mine] > 0).astype(np.int64), ends)))
                out["base_score"].append(pa.array(np.add.reduceat(base[mine], ends[:-1])))
                out["cost"].append(pa.array(np.add.reduceat(np.where(hit, 0.0, costs[mine]), ends[:-1])))
                for name, costing in (("rest", word), ("fresh", plain)):
                    out[name].append(pa.array(np.add.reduceat(np.where(hit, 0.0, np.where(known, share, costing[mine])), ends[:-1])))
                out["paired"].append(pa.array(np.add.reduceat(np.where(known, share, word[mine]), ends[:-1])))
                out["whole"].append(pa.array(np.add.reduceat(word[mine], ends[:-1])))
                for name, values in (("cells", used % ALL_CELLS), ("tries", tries[used]), ("hits", hits[used])):
                    out[name].append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64))))
        whole, many = pa.int64(), pa.list_(pa.int64())
        types = {
            "key": kind, "held_out": pa.bool_(), "n_tokens": whole, "n_known": whole, "base_score": pa.float64(), "cost": pa.float64(),
            "rest": pa.float64(), "fresh": pa.float64(), "paired": pa.float64(), "whole": pa.float64(),
            "cells": many, "tries": many, "hits": many,
        }
        return pa.table({n: pa.chunked_array(v, types[n]) for n, v in out.items()})

    return run


def _write_costs(numbered: DataFrame, path: str) -> tuple[int, int, int]:
    """Learn from the training tokens, as `_number_words` gives them, and write (home, place, count, cost): a token's part there
    and its place in it; returns their number, that of distinct ones, and of those that occur once."""
    spark = numbered.sparkSession
    vocabulary = numbered.filter("block IS NULL").select(F.col("part").alias("home"), F.posexplode(F.arrays_zip("words", "counts")).alias("place", "t"))
    vocabulary = vocabulary.select("home", "place", F.col("t.words").alias("token"), F.col("t.counts").alias("count"))
    sizes = vocabulary.agg(F.count("*").alias("rows"), F.sum("count").alias("total"), F.count_if(F.col("count") > 0).alias("distinct"), F.count_if(F.col("count") == 1).alias("single")).first()
    total, distinct = sizes["total"] or 0, sizes["distinct"] or 0
    freed(spark)
    ranges = max(1, -(-sizes["rows"] // RANGE_TOKENS))
    vocabulary = materialize(
        vocabulary.repartitionByRange(ranges, "token").select("token", "count", "home", "place", F.spark_partition_id().alias("part")), "ranges"
    )
    known = vocabulary.select("token", "count", "part")
    nodes = materialize(known.groupBy("part").applyInArrow(_edge_nodes, "part int, node binary, zeros long, ones long"), "nodes")
    whole = nodes.groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    edges = materialize(nodes.select("part", "node").join(whole, "node").select("part", "node", "zeros", "ones"), "edges")
    pieces = known.coalesce(max(TABLE_TASKS, -(-sizes["rows"] // TABLE_ROWS))).mapInArrow(_table_parts, "piece int, counts array<double>")
    table = np.zeros((ORDERS * (2 << TABLE_BITS) // 4096, 4096), np.float32)
    for row in pieces.groupBy("piece").applyInArrow(_sum_pieces, "piece int, counts array<double>").toArrow().to_batches():
        for piece, values in zip(row["piece"].to_pylist(), row["counts"], strict=True):
            table[piece] = values.values.to_numpy()
    shared = spark.sparkContext.broadcast(table.reshape(ORDERS, -1, 2))
    fitted = known.groupBy("part").cogroup(edges.groupBy("part")).applyInArrow(
        given_back(_fit_range(shared)), "weights array<double>, told array<double>, mass array<double>"
    )
    sums = {}
    for column, size in (("weights", GATES * INPUTS), ("told", GATES * STEPS * 2), ("mass", GATES)):
        sums[column] = np.zeros(size)
    fitted = materialize(fitted, "fitted")
    freed(spark)
    for column in sums:
        added = fitted.select(F.posexplode(column).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
        sums[column][[r["i"] for r in added]] = [r["x"] for r in added]
    mass = sums["mass"][:, None]
    weights = np.where(mass > 0, sums["weights"].reshape(GATES, INPUTS) / np.maximum(mass, 1e-9), FIRST_WEIGHTS)
    mixer = spark.sparkContext.broadcast(Mixer(weights, sums["told"].reshape(GATES, STEPS, 2)))
    scored = vocabulary.groupBy("part").cogroup(edges.groupBy("part")).applyInArrow(given_back(_score_range(shared, mixer)), "home int, place int, count long, cost double")
    scored.write.parquet(path)
    return total, distinct, sizes["single"]


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per document.

    Learns from the documents whose crc32 of the key as text leaves a remainder by `folds`. Counts, tables and vocabulary
    cover all of them. base_score is the smoothed unigram score of the same tokens, score that of the mixed model, both
    log10. What reaches the driver is of fixed size: `ORDERS * 2**(TABLE_BITS + 1)` counts, and the mixer.

    Edge cases: null and empty texts are the end token alone. A null key is not held out. Repeated rows each get a row.
    With no training text every bit is even and base_score is 0. Other columns of docs do not matter. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(key).alias("key"), held_out(key, folds).alias("held"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = narrow.schema["key"].dataType
    name = kind.simpleString()
    schema = f"block long, tokens array<string>, distinct long, trained long, counts array<long>, keys array<{name}>, held array<boolean>, lengths array<long>, codes binary"
    blocks = materialize(narrow.mapInArrow(_blocks, schema), "blocks")
    sizes = blocks.agg(F.sum("distinct").alias("words"), F.sum("trained").alias("trained")).first()
    bits = max(PAIR_PARTS, ((sizes["trained"] or 0) // PART_TOKENS).bit_length())
    word_bits = max(PAIR_PARTS, ((sizes["words"] or 0) // PART_WORDS).bit_length())
    found = []
    # What takes most disk comes first, as long as nothing else is kept.
    for parts, sums in ((_grams, _sum_grams), (_pairs, _sum_pairs)):
        named = blocks.select("block", "tokens", "held", "lengths", "codes").mapInArrow(parts(bits), "block long, part int, names binary, seen binary")
        found.append(materialize(named.groupBy("part").applyInArrow(sums, "block long, part int, totals binary"), "totals"))
        freed(spark)
    costs, prices = scratch_path(spark, "costs"), scratch_path(spark, "prices")
    with scratch_scope(spark):
        dealt_words = blocks.select("block", "tokens", "counts").mapInArrow(_words(word_bits), "block long, part int, words array<string>, counts array<long>")
        numbered = dealt_words.groupBy("part").applyInArrow(_number_words, "part int, block long, words array<string>, counts array<long>, codes binary")
        numbered = materialize(numbered, "words")
        freed(spark)
        total, distinct, single = _write_costs(numbered, costs)
        freed(spark)
        scored = spark.read.schema("home int, place int, count long, cost double").parquet(costs)
        codes = numbered.filter("block IS NOT NULL").select("part", "block", "codes")
        codes.groupBy("part").cogroup(scored.groupBy("home")).applyInArrow(_price_words, "block long, part int, totals binary").write.parquet(prices)
    delete_folder(spark, costs)
    freed(spark)
    found.insert(0, spark.read.schema("block long, part int, totals binary").parquet(prices))
    from pyspark.sql.pandas.types import to_arrow_type

    result = (
        f"key {name}, held_out boolean, n_tokens long, n_known long, base_score double, cost double, rest double, fresh double, paired double, whole double, cells array<long>, "
        "tries array<long>, hits array<long>"
    )
    run, texts = _documents(total, distinct, single, to_arrow_type(kind), word_bits), None
    for turn in range(PASSES):
        mine = blocks.filter(F.pmod(F.xxhash64("block"), F.lit(PASSES)) == turn)
        told = None
        for number, totals in enumerate(found):
            rows = totals.filter(F.pmod(F.xxhash64("block"), F.lit(PASSES)) == turn)
            rows = rows.select(F.col("block").alias("at_block"), "part", "totals", F.lit(number).alias("kind"))
            told = rows if told is None else told.union(rows)
        whole = mine.select("block", "keys", "held", "lengths", "codes", "tokens")
        part = materialize(whole.groupBy("block").cogroup(told.groupBy("at_block")).applyInArrow(given_back(run), result), "texts")
        texts = part if texts is None else texts.union(part)
        del mine, rows, told, whole
        freed(spark)
    cells = texts.filter("NOT held_out").select(F.explode(F.arrays_zip("cells", "tries", "hits")).alias("c"))
    cells = cells.groupBy("c.cells").agg(F.sum("c.tries").alias("tries"), F.sum("c.hits").alias("hits")).collect()
    tries, hits = np.zeros(ALL_CELLS), np.zeros(ALL_CELLS)
    for row in cells:
        tries[row["cells"]], hits[row["cells"]] = row["tries"], row["hits"]
    after = CELLS + FOLLOWS
    chance, *known = fit_repeats(tries[:CELLS], hits[:CELLS]), fit_follows(tries[CELLS:after], hits[CELLS:after]), fit_follows(tries[after:], hits[after:])
    rights, wrongs = np.r_[chance * (1 - 2.0**-NEXT_BITS), *known], np.r_[1 - chance, *(1 - k for k in known)]
    gain, loss = (F.array(*[F.lit(float(v)) for v in np.log10(x)]) for x in (rights, wrongs))

    def told_by(low: int, high: int):
        cells = F.filter(F.arrays_zip("cells", "tries", "hits"), lambda c: (c["cells"] >= low) & (c["cells"] < high))
        bits = F.transform(cells, lambda c: (
            c["hits"] * F.get(gain, c["cells"].cast("int")) + (c["tries"] - c["hits"]) * F.get(loss, c["cells"].cast("int"))
        ))
        return F.aggregate(bits, F.lit(0.0), lambda s, x: s + x)

    told = texts.withColumns({"told": told_by(0, CELLS), "follow": told_by(CELLS, after), "alone": told_by(after, ALL_CELLS)})
    models = [F.col("cost") + F.col("told"), *(F.col(n) + F.col("told") + F.col("follow") for n in ("rest", "fresh")), F.col("paired") + F.col("alone"), F.col("whole")]
    best = F.greatest(*models)
    score = best + F.log10(sum((F.pow(F.lit(10.0), m - best) * w for m, w in zip(models, WEIGHTS, strict=True)), F.lit(0.0)))
    return told.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score",
        score.alias("score"),
    )
