"""Adaptive range coder for token ids, one independent block at a time, vectorised over lanes.

A block's ids lie in `lanes` runs of equal length that advance together: step t codes the t-th id of every run, each with
a range coder of its own, all under one shared model. Each id is told as one of four outcomes and, with it, at once,
inside one interval:

* it is what the order-2 context (the two ids before) predicts,
* an id that has followed the id before, by its order-1 frequency there,
* an id seen before in the block, by its order-0 frequency,
* a new id, all alike.

How far each order is trusted is learned. How often an order-2 prediction of this confidence held, and how often one held
after an order-1 context this well known, are mixed as log odds with weights learned while coding, and the result is refined
by what truly happened in that situation, which also divides the rest among the other outcomes. All of it is integer
arithmetic, so any machine decodes alike. Coder and decoder do the same updates after a step; frequencies are refreshed
at growing, then fixed, distances.

Block: `HEADER` (magic, version, ids, lanes, crc32 of the ids as little-endian unsigned 32-bit, the shortest lane's length
in 16-bit words, bytes a length), crc32 of all else, then what each lane is longer than that, then the words of all lanes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

HEADER = struct.Struct("<4sIQIIQI")
CHECK = struct.Struct("<I")
MAGIC = b"TIDB"
VERSION = 2
LANES = 8192
LEAST_STEPS = 256
MAX_ID = 65535
PAIR_BITS = 18
CLASS_BITS, ID_BITS = 12, 16
ONE = 1 << CLASS_BITS
REFRESH = 64
U = np.uint64
LOW32 = U(0xFFFFFFFF)
LOW20, LOW40 = (1 << 20) - 1, (1 << 40) - 1

# stretch: log odds in 1/256 of a probability in 1/4096; squash: its inverse over -2047..2047.
_P = (np.arange(ONE) + 0.5) / ONE
STRETCH = np.rint(np.log(_P / (1 - _P)) * 256).astype(np.int64)
SQUASH = np.clip(np.rint(ONE / (1 + np.exp(-(np.arange(4096) - 2048) / 256.0))), 1, ONE - 1).astype(np.int64)


# Confidence of an order-2 prediction after it missed (first row) or held; a miss at 0 puts the new id in its place.
SURE = 8
MOVES = np.array([[0, 0, 0, 1, 1, 2, 2, 3], [1, 2, 3, 4, 5, 6, 7, 7]]).ravel()
# How well an order-1 context is known: bits of the number of ids that have followed, by two.
LEVELS = 8
SITUATIONS = SURE * LEVELS
BEYOND = np.int64(1) << 40  # above every pair of ids


def _squash(x: np.ndarray) -> np.ndarray:
    return SQUASH[np.clip(x, -2047, 2047) + 2048]


class Model:
    """What the ids so far say about the next ones."""

    def __init__(self, lanes: int):
        self.second = np.zeros(1 << PAIR_BITS, np.int64)  # prediction << 3 | confidence, by the hash of two ids
        self.before, self.last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.pairs, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)  # id before << 16 | id, ascending
        self.steps, self.next_refresh = 0, 1
        self.outcomes: list[np.ndarray] = []
        self.rates = np.full((2, 8), ONE // 4, np.int64)  # how often order 2 held, by its confidence and by level
        self.weights = np.full((2, 2), 1 << 15, np.int64)  # by whether order 1 is well known; 1 << 16 is one
        self.happened = np.tile(np.array([4, 3, 6, 3], np.int64), (SITUATIONS, 1))  # outcomes by situation
        self._frequencies()
        self._followers()
        self._classes()

    def _frequencies(self) -> None:
        """Order-0 frequencies of seen ids, 1 or more each, `1 << ID_BITS` in all."""
        times = np.bincount(self.pairs & MAX_ID, self.counts, MAX_ID + 1).astype(np.int64)
        total, size = int(times.sum()), 1 << ID_BITS
        ids = np.flatnonzero(times)
        self.frequency = np.zeros(MAX_ID + 1, np.int64)
        if len(ids):
            share = np.maximum(1, times[ids] * (size - len(ids)) // total)
            share[np.argmax(share)] += size - int(share.sum())
            self.frequency[ids] = share
        # One number tells an id's outcome if not predicted, and begin and width of its part there: one look-up a step.
        seen = self.frequency > 0
        every = np.arange(MAX_ID + 1)
        begin = np.where(seen, np.cumsum(self.frequency) - self.frequency, every)
        self.plain = (np.where(seen, 2, 3) << 40) | (begin << 20) | np.where(seen, self.frequency, 1)
        # By place among the order-0 frequencies: the id, with the same begin and width.
        whole = (every << 40) | (begin << 20) | self.frequency
        self.by_slot = np.repeat(whole[ids], self.frequency[ids]) if len(ids) else np.zeros(size, np.int64)

    def _followers(self) -> None:
        """Order-1 frequencies: the ids that followed an id share `1 << ID_BITS`, 1 or more each."""
        before = self.pairs >> 16
        first = np.flatnonzero(np.r_[True, before[1:] != before[:-1]]) if len(before) else np.zeros(0, np.int64)
        many = np.diff(np.r_[first, len(before)])
        running = np.cumsum(self.counts) - self.counts
        total = np.diff(np.r_[running[first], int(self.counts.sum())])
        row = np.repeat(np.arange(len(first)), many)
        place = np.arange(len(before)) - first[row]
        begin = (running - running[first][row]) * ((1 << ID_BITS) - many[row]) // total[row] + place
        follow = (row << ID_BITS) + begin
        self.follow = np.r_[follow, len(first) << ID_BITS]  # where each pair's part begins, all contexts in a row
        # Of each pair, as above: its second id, begin and width.
        self.after = np.r_[((self.pairs & MAX_ID) << 40) | (begin << 20) | np.diff(self.follow), 0]
        self.keys = np.r_[self.pairs, BEYOND]
        self.row = np.zeros(MAX_ID + 1, np.int64)
        self.row[before[first]] = np.arange(len(first)) << ID_BITS
        self.level = np.zeros(MAX_ID + 1, np.int64)
        self.level[before[first]] = np.minimum(LEVELS - 1, (np.frexp(total.astype(np.float64))[1] + 1) >> 1)

    def _classes(self) -> None:
        """Frequencies of the four outcomes in each situation, `ONE` in all."""
        situation = np.arange(SITUATIONS)
        sure, level = situation >> 3, situation & 7
        odds = np.stack([STRETCH[self.rates[0][sure]], STRETCH[self.rates[1][level]]])
        weights = self.weights[:, level >> 2]
        mixed = _squash((odds * weights).sum(axis=0) >> 16)
        told = self.happened.sum(axis=1)
        refined = self.happened[:, 0] * ONE // told
        hit = np.clip((mixed + 3 * refined) >> 2, 1, ONE - 8)
        rest = ONE - hit
        others = np.maximum(1, self.happened[:, 1:] * (rest - 3)[:, None] // np.maximum(1, self.happened[:, 1:].sum(axis=1))[:, None])
        classes = np.concatenate([hit[:, None], others], axis=1)
        classes[:, 2] += ONE - classes.sum(axis=1)
        self.classes = classes
        self.class_start = np.cumsum(classes, axis=1) - classes
        self.span = (self.class_start.ravel() << ID_BITS + 20) | classes.ravel()
        self.odds, self.mixed = odds, mixed

    def situation(self) -> None:
        """Look the predictions up for the next step."""
        self.slot = (self.before * 0x9E3B + self.last) & ((1 << PAIR_BITS) - 1)
        entry = self.second.take(self.slot)
        self.guess, self.sure = entry >> 3, entry & 7
        self.where = (self.sure << 3) | self.level.take(self.last)

    def update(self, ids: np.ndarray, cell: np.ndarray, held: np.ndarray) -> None:
        """cell: situation and outcome. held: whether the order-2 prediction was right."""
        sure = MOVES.take(self.sure + (held << 3))
        self.second[self.slot] = (np.where(held | (self.sure > 0), self.guess, ids) << 3) | sure
        self.before, self.last = self.last, ids
        self.outcomes.append(cell)
        self.steps += 1

    def refresh(self, fresh: np.ndarray, many: np.ndarray) -> None:
        """Learn from the pairs of ids coded since the last time, ascending, and how often each came."""
        self.next_refresh = self.steps + min(self.steps, REFRESH)
        at = np.searchsorted(self.keys, fresh)
        known = self.keys[at] == fresh
        self.counts[at[known]] += many[known]
        self.pairs, self.counts = (np.insert(old, at[~known], new[~known]) for old, new in ((self.pairs, fresh), (self.counts, many)))
        self._frequencies()
        self._followers()
        counts = np.bincount(np.concatenate(self.outcomes), minlength=4 * SITUATIONS).reshape(SITUATIONS, 4)
        self.happened += counts
        large = self.happened.sum(axis=1) > 1 << 20
        self.happened[large] = (self.happened[large] >> 1) + 1
        situation = np.arange(SITUATIONS)
        total, hits = counts.sum(axis=1), counts[:, 0]
        for order, cause in ((0, situation >> 3), (1, situation & 7)):
            right = np.bincount(cause, hits, 8).astype(np.int64)
            tries = np.bincount(cause, total, 8).astype(np.int64)
            target = np.clip(right * ONE // np.maximum(1, tries), 1, ONE - 1)
            self.rates[order] += np.where(tries > 0, target - self.rates[order], 0) >> 2
        self.rates = np.clip(self.rates, 1, ONE - 1)
        # Weights move along the error of the mix times the log odds, averaged over what was coded.
        error = hits * ONE - total * self.mixed
        for known in (0, 1):
            part = ((situation & 7) >> 2) == known
            many = max(1, int(total[part].sum()))
            self.weights[:, known] += (self.odds[:, part] * error[part]).sum(axis=1) // many >> 2
        self.weights = np.clip(self.weights, -(1 << 18), 1 << 18)
        self._classes()
        self.outcomes = []


def _unsettled(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Lanes whose top 16 bits are settled, or whose width is too small to go on."""
    return np.flatnonzero((((low ^ (low + width)) >> U(48)) == 0) | (width < U(1 << 32)))


def _narrowed(low: np.ndarray, width: np.ndarray, todo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low and width of these lanes; a width too small across a border is cut at it, so that no carry can come."""
    some, span = low[todo], width[todo]
    across = ((some ^ (some + span)) >> U(48)) != 0
    if across.any():
        np.copyto(span, np.minimum(span, (~some + U(1)) & LOW32), where=across)
    return some, span


def _shifted(low: np.ndarray, width: np.ndarray, todo: np.ndarray, some: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Drop the top 16 bits of these lanes; those that are still not ready."""
    some, span = some << U(16), span << U(16)
    low[todo], width[todo] = some, span
    return todo[_unsettled(some, span)]


def _shape(count: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, count // LEAST_STEPS))
    return lanes, -(-count // lanes)


def _numbered(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of a grid, ascending, how often each occurs, and the number of each place's pair among them."""
    flat = pairs.ravel()
    # Pair and place in one number sort several times faster than by an index.
    bits = len(flat).bit_length()
    if bits <= 31:
        order = np.sort((flat << bits) | np.arange(len(flat)))
        ordered, order = order >> bits, order & ((1 << bits) - 1)
    else:
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
    fresh = np.r_[True, ordered[1:] != ordered[:-1]]
    numbers = np.empty(len(flat), np.int32)
    numbers[order] = np.cumsum(fresh, dtype=np.int32) - 1
    first = np.flatnonzero(fresh)
    return ordered[first], np.diff(np.r_[first, len(flat)]), numbers.reshape(pairs.shape)


def _distinct(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without the numbers."""
    ordered = np.sort(pairs, axis=None)
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    return ordered[first], np.diff(np.r_[first, len(ordered)])


def _at(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the ascending bounds each value has reached. Sorted values stay within the cache."""
    bits = len(values).bit_length()
    order = np.sort((values << bits) | np.arange(len(values)))
    out = np.empty(len(values), np.int64)
    out[order & ((1 << bits) - 1)] = bounds.searchsorted(order >> bits, "right") - 1
    return out


def encode(ids: np.ndarray) -> bytes:
    """One block; ids are integers from 0 to 65535. No ids give a block that holds none."""
    ids = np.asarray(ids, np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() > MAX_ID):
        raise ValueError("ids must lie between 0 and 65535")
    lanes, steps = _shape(len(ids))
    grid = np.pad(ids, (0, lanes * steps - len(ids))).reshape(lanes, steps).T.copy()
    room = 2 * steps + 8
    out = np.zeros(lanes * room, "<u2")
    base = np.arange(lanes) * room
    at = base.copy()
    low, width = np.zeros(lanes, U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, U)
    model = Model(lanes)
    while model.steps < steps:
        # All steps up to the next refresh meet the same frequencies.
        begin, end = model.steps, min(model.next_refresh, steps)
        pairs, many, numbers = _numbered((np.concatenate([model.last[None], grid[begin : end - 1]]) << 16) | grid[begin:end])
        known = model.keys.searchsorted(pairs)
        after = np.where(model.keys[known] == pairs, model.after[known] & LOW40 | (1 << 40), 0)
        for now, pair in zip(grid[begin:end], numbers, strict=True):
            model.situation()
            held = now == model.guess
            part, plain = after.take(pair), model.plain.take(now)
            np.copyto(part, plain, where=part == 0)
            np.copyto(part, 1 << ID_BITS, where=held)
            cell = (model.where << 2) | (part >> 40)
            span = model.span.take(cell)
            wide = span & LOW20
            unit = width >> U(CLASS_BITS + ID_BITS)
            low += unit * ((span >> 20) + wide * ((part >> 20) & LOW20)).view(U)
            width = unit * (wide * (part & LOW20)).view(U)
            todo = _unsettled(low, width)
            while len(todo):
                some, span = _narrowed(low, width, todo)
                place = at[todo]
                out[place] = (some >> U(48)).astype(np.uint16)
                at[todo] = place + 1
                todo = _shifted(low, width, todo, some, span)
            model.update(now, cell, held)
        if end < steps:
            model.refresh(pairs, many)
    # The fewest words that lie inside the interval whatever follows them.
    words = 3 - (width >= U(1 << 33)).astype(np.int64) - (width >= U(1 << 49))
    last = U(64) - U(16) * words.astype(U)
    value = ((low >> last) + U(1)) << last
    for word in range(3):
        more = words > word
        out[at[more]] = (value[more] >> U(48 - 16 * word)).astype(np.uint16)
        at += more
    lengths = at - base
    used = np.arange(room)[None, :] < lengths[:, None]
    least = int(lengths.min())
    size = next(n for n in (1, 2, 4, 8) if int(lengths.max()) - least < 1 << 8 * n)
    body = (lengths - least).astype(f"<u{size}").tobytes() + out.reshape(lanes, room)[used].tobytes()
    header = HEADER.pack(MAGIC, VERSION, len(ids), lanes, zlib.crc32(ids.astype("<u4").tobytes()), least, size)
    return header + CHECK.pack(zlib.crc32(body, zlib.crc32(header))) + body


def decode(block: bytes) -> np.ndarray:
    """The ids of a block. A damaged block raises ValueError."""
    start = HEADER.size + CHECK.size
    if len(block) < start:
        raise ValueError("a block is cut short")
    magic, version, count, lanes, ids_crc, least, size = HEADER.unpack_from(block)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of this format")
    if CHECK.unpack_from(block, HEADER.size)[0] != zlib.crc32(block[start:], zlib.crc32(block[: HEADER.size])):
        raise ValueError("a block's checksum is wrong")
    steps = -(-count // lanes)
    lengths = np.frombuffer(block, f"<u{size}", lanes, start).astype(np.int64) + least
    words = np.frombuffer(block, "<u2", offset=start + size * lanes).astype(U)
    words = np.concatenate([words, np.zeros(4, U)])
    at = np.cumsum(lengths) - lengths
    code = np.zeros(lanes, U)
    for _ in range(4):
        code = (code << U(16)) | words[at]
        at += 1
    low, width = np.zeros(lanes, U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, U)
    model = Model(lanes)
    grid, told = np.zeros((steps, lanes), np.int64), []
    for step in range(steps):
        model.situation()
        unit = width >> U(CLASS_BITS + ID_BITS)
        value = np.minimum((code - low) // unit, U((1 << CLASS_BITS + ID_BITS) - 1)).view(np.int64)
        starts, upper = model.class_start.take(model.where, axis=0), value >> ID_BITS
        outcome = (upper >= starts[:, 1]).astype(np.int64)
        outcome += upper >= starts[:, 2]
        outcome += upper >= starts[:, 3]
        cell = (model.where << 2) | outcome
        span = model.span.take(cell)
        wide, origin = span & LOW20, span >> 20
        slot = ((value - origin) / wide).astype(np.int64)
        place = slot & MAX_ID
        part = model.by_slot.take(place)
        held = outcome == 0
        some = np.flatnonzero(outcome == 1)
        part[some] = model.after.take(_at(model.follow, model.row.take(model.last.take(some)) + place.take(some)))
        np.copyto(part, (slot << 40) | (slot << 20) | 1, where=outcome == 3)
        np.copyto(part, (model.guess << 40) | (1 << ID_BITS), where=held)
        now = part >> 40
        low += unit * (origin + wide * ((part >> 20) & LOW20)).view(U)
        width = unit * (wide * (part & LOW20)).view(U)
        todo = _unsettled(low, width)
        while len(todo):
            some, span = _narrowed(low, width, todo)
            place = at[todo]
            code[todo] = (code[todo] << U(16)) | words[place]
            at[todo] = place + 1
            todo = _shifted(low, width, todo, some, span)
        told.append((model.last << 16) | now)
        model.update(now, cell, held)
        grid[step] = now
        if model.steps == model.next_refresh and model.steps < steps:
            model.refresh(*_distinct(np.concatenate(told)))
            told = []
    ids = grid.T.reshape(-1)[:count]
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("a block's ids do not match their checksum")
    return ids
